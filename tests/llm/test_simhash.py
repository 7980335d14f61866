import random

import numpy as np
import pytest
import xxhash

from ebbtide.llm import gray_index, queries, simhash
from ebbtide.llm.common import Scratch
from ebbtide.llm.components import connected_components

SF = "/root/testdata/sf0.001"
SPACE = " \t\n\x0b\f\r"


def plain_fingerprint(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in SPACE:
        lowered = lowered.replace(c, " ")
    words = [w for w in lowered.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows):
    """[(key, fp)] -> {fp: smallest key}"""
    prints = sorted({f for _, f in rows})
    parent = {f: f for f in prints}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for i, a in enumerate(prints):
        for b in prints[i + 1 :]:
            if (a ^ b).bit_count() <= 2:
                parent[root(a)] = root(b)
    first = {}
    for key, f in rows:
        if key is not None:
            first[root(f)] = min(key, first.get(root(f), key))
    return {f: first.get(root(f)) for f in prints}


def check(spark, rows, found):
    prints = [(k, plain_fingerprint(t)) for k, t in rows]
    components = plain_components(prints)
    want = sorted(((k, f"{f:016x}", components[f]) for k, f in prints), key=repr)
    got = sorted(((r.doc_id, f"{r.fp & (1 << 64) - 1:016x}", r.component_id) for r in found.collect()), key=repr)
    assert got == want


def test_awkward_rows(spark, docs, awkward):
    check(spark, awkward, simhash.near_duplicates(docs(awkward)))


def test_empty_table_and_clashing_columns(spark, docs):
    empty = docs([])
    assert simhash.near_duplicates(empty).collect() == []
    clash = docs([(1, "a b c"), (2, "a b c")]).selectExpr("*", "1 AS fp", "2 AS component_id", "3 AS key", "4 AS mask")
    assert [r.component_id for r in simhash.near_duplicates(clash).collect()] == [1, 1]


def test_whole_table(spark, texts):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op1_simhash(spark, SF).collect()}
    prints = [(k, plain_fingerprint(t)) for k, t in texts.items()]
    components = plain_components(prints)
    assert got == {k: (f"{f:016x}", components[f]) for k, f in prints}


@pytest.mark.parametrize("crowded", [20_000, 5])
def test_links_of_clusters(spark, monkeypatch, crowded):
    """Dense clusters, also when groups have to be divided down to the last level."""
    monkeypatch.setattr(simhash, "GROUP_ROWS", crowded)
    rnd = random.Random(3)
    codes = {rnd.getrandbits(64) for _ in range(200)}
    for center in [0, (1 << 64) - 1, *list(codes)[:4]]:
        for _ in range(60):
            code = center
            for _ in range(rnd.randint(0, 6)):
                code ^= 1 << rnd.randrange(64)
            codes.add(code)
    prints = spark.createDataFrame([(c - (1 << 64) if c >> 63 else c,) for c in codes], "fp long")
    tables = Scratch(spark, "test")
    labels = {r.node: r.label for r in connected_components(simhash.fingerprint_links(prints, tables), tables).collect()}
    got = {}
    for c in codes:
        signed = c - (1 << 64) if c >> 63 else c
        got.setdefault(labels.get(signed, signed), set()).add(c)
    want = {}
    numbered = [(i, c) for i, c in enumerate(sorted(codes))]
    by_code = plain_components(numbered)
    for _, c in numbered:
        want.setdefault(by_code[c], set()).add(c)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


@pytest.mark.parametrize("front", [1 << 20, 64])
def test_index_against_all_pairs(monkeypatch, front):
    monkeypatch.setattr(gray_index, "FRONT", front)
    rnd = np.random.default_rng(5)
    groups = np.sort(rnd.integers(0, 7, 400))
    codes = rnd.integers(0, 1 << 8, 400).astype(np.uint64) << np.uint64(30)
    pairs = {(g, int(c)) for g, c in zip(groups, codes)}
    groups = np.array([g for g, _ in sorted(pairs)])
    codes = np.array([c for _, c in sorted(pairs)], np.uint64)
    order = np.lexsort((gray_index.gray_rank(codes), groups))
    groups, codes = groups[order], codes[order]
    got = {(int(a), int(b)) for i, j in gray_index.near_pairs(codes, groups, 2) for a, b in zip(i, j)}
    n = len(codes)
    want = {(i, j) for i in range(n) for j in range(i + 1, n) if groups[i] == groups[j] and int(codes[i] ^ codes[j]).bit_count() <= 2}
    assert got == want


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    found = connected_components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "test")).collect()
    assert {r.node: r.label for r in found} == {**{i: 1 for i in range(1, 41)}, **{i: 100 for i in range(100, 140)}}
