import hashlib
import random
from collections import defaultdict

import pytest

from ebbtide.llm import queries, radix

SF = "/root/testdata/sf0.001"
SPACE = " \t\n\x0b\f\r"


def bare(text):
    return "".join(c for c in text or "" if c not in SPACE)


def plain(rows):
    """[(key, text)] -> sorted [(key, keep_id, size, sha)] and the number of rows kept per text"""
    groups = defaultdict(list)
    for k, t in rows:
        groups[bare(t)].append((-len(t or ""), k is None, k or 0))
    out = []
    for k, t in rows:
        body = bare(t)
        _, none, keep = min(groups[body])
        out.append((k, None if none else keep, len(groups[body]), hashlib.sha256(body.encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in df.collect()), key=repr)


def long_rows():
    rnd = random.Random(4)
    base = "".join(rnd.choice("abcé ") for _ in range(9000))
    cuts = [0, 1, 200, 255, 256, 257, 300, 1279, 1280, 1281, 1300, 5000, 8999]
    rows = [(i, base[:n]) for i, n in enumerate(cuts)] + [(100 + i, base[:n] + "x") for i, n in enumerate(cuts)]
    rows += [(200 + i, " ".join(base[:n])) for i, n in enumerate(cuts)]
    return rows + [(300 + i, base) for i in range(5)] + [(301, base)]


@pytest.mark.parametrize("first", [256, 4])
def test_against_plain_grouping(docs, awkward, monkeypatch, first):
    monkeypatch.setattr(radix, "FIRST_BYTES", first)
    rows = awkward + long_rows()
    found = radix.exact_groups(docs(rows))
    assert got(found) == plain(rows)
    kept = [r for r in found.collect() if r.kept]
    assert sorted(r.text_sha256 for r in kept) == sorted({hashlib.sha256(bare(t).encode()).hexdigest() for _, t in rows})
    assert all(r.doc_id == r.keep_id for r in kept)


def test_rows_that_stay(docs, awkward):
    rows = awkward + long_rows()
    frame = docs(rows).selectExpr("*", "1 AS __row", "2 AS __rest", "3 AS __n")
    kept = radix.exact_dedup(frame)
    assert kept.columns == frame.columns
    best = {}
    for k, t in rows:
        order = (-len(t or ""), k is None, k or 0)
        best[bare(t)] = min(best.get(bare(t), order), order)
    assert sorted((-len(r.text or ""), r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == sorted(best.values())


def test_empty_table(docs):
    assert radix.exact_groups(docs([])).collect() == [] and radix.exact_dedup(docs([])).collect() == []


def test_whole_table(spark, texts):
    assert got(queries.op9_exact_dedup(spark, SF)) == plain(list(texts.items()))
