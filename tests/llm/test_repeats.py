import hashlib
import random

import numpy as np
import pytest

from ebbtide.llm import queries, repeats

SF = "/root/testdata/sf0.001"


def plain(rows, length=50):
    """[(key, text)] -> sorted [(key, n_bytes, spans, kept)]"""
    data = [(k, (t or "").encode()) for k, t in rows]
    first = {}
    for k, b in data:
        order = (k is None, k or 0)
        for i in range(len(b) - length + 1):
            s = b[i : i + length]
            first[s] = min(order, first.get(s, order))
    out = []
    for k, b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if first[b[i : i + length]] < (k is None, k or 0):
                gone[i : i + length] = b"\1" * length
        spans, at = [], 0
        while at < len(b):
            if gone[at]:
                end = at
                while end < len(b) and gone[end]:
                    end += 1
                spans.append((at, end))
                at = end
            else:
                at += 1
        out.append((k, len(b), tuple(spans), bytes(x for x, g in zip(b, gone) if not g)))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.doc_id, r.n_bytes, tuple((s.start, s.end) for s in r.spans), bytes(r.kept)) for r in df.collect()), key=repr)


def cases():
    rnd = random.Random(2)
    letters = "abcdefgh äß🙂\n"
    passage = ["".join(rnd.choice(letters) for _ in range(n)) for n in (49, 50, 51, 90, 300)]
    rows = []
    for i in range(60):
        text = "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 120)))
        for _ in range(rnd.randint(0, 3)):
            text += rnd.choice(passage) + "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 30)))
        rows.append((i, text))
    rows += [(70, "x" * 500), (71, "x" * 49), (72, "x" * 50 + "y"), (73, "ab " * 100), (74, "ab " * 60 + "c"), (30, rows[5][1]), (None, rows[3][1]), (None, rows[3][1]), (5, rows[5][1])]
    return rows


@pytest.mark.parametrize("crowded", [20_000, 3])
@pytest.mark.parametrize("memory", [128 << 20, 200], ids=["memory", "disk"])
def test_cases(docs, awkward, crowded, memory):
    """Also with crowded grams, and with shards that outgrow memory."""
    rows = [*cases(), *[(k if k is None else 1000 + k, t) for k, t in awkward]]
    assert got(repeats.remove_repeats(docs(rows), crowded_from=crowded, shard_bytes=memory)) == plain(rows)


def test_sub_shards(monkeypatch):
    """Fragments of many grams, sorted a few grams at a time and read back from a file."""
    monkeypatch.setattr(repeats, "SORT_BYTES", 300)
    rnd = random.Random(9)
    grams = sorted(rnd.sample(range(1 << 32), 40) * 3)
    texts = {g: ["".join(rnd.choice("ab") for _ in range(rnd.randint(50, 60))).encode() for _ in range(2)] for g in set(grams)}
    entries = [(g, rnd.randint(1, 9), i, texts[g][rnd.randint(0, 1)]) for i, g in enumerate(grams)]
    found = {}
    for name, memory in (("memory", 1 << 20), ("disk", 100)):
        shard = repeats.Shard(50, memory)
        for chunk in (0, 1):
            own = [e for i, e in enumerate(entries) if i % 2 == chunk]
            cols = [np.array([e[0] for e in own], np.uint32), np.array([e[1] for e in own]), np.array([e[2] for e in own], np.uint64),
                    np.zeros(len(own), np.uint32), np.array([len(e[3]) - 49 for e in own], np.uint8)]
            shard.add(chunk, cols, b"".join(e[3] for e in own))
        runs = [r for part in shard.parts() for _, r in repeats.repeated_runs(part, 50)]
        found[name] = sorted((int(row), int(s) + j) for _, rows_, starts, spans in runs for row, s, n in zip(rows_, starts, spans) for j in range(int(n)))
    first = {}
    for _, key, _, t in entries:
        for i in range(len(t) - 49):
            first[t[i : i + 50]] = min(key, first.get(t[i : i + 50], key))
    want = sorted((i, j) for _, key, i, t in entries for j in range(len(t) - 49) if first[t[j : j + 50]] < key)
    assert found["memory"] == found["disk"] == want and want


def test_small_pieces(monkeypatch):
    """Texts longer than a piece: every string is in exactly one part."""
    monkeypatch.setattr(repeats, "PIECE_BYTES", 64)
    texts = [bytes(range(256)), b"short", b"z" * 113, b"q" * 50]
    seen = []
    for data, parts in repeats.pieces(texts, 50):
        gram, doc, start, at, strings = repeats.anchor_runs(data, parts, 50)
        for d, s, a, n in zip(doc.tolist(), start.tolist(), at.tolist(), strings.tolist()):
            for j in range(n):
                assert texts[d][s + j : s + j + 50] == data[a + j : a + j + 50]
                seen.append((d, s + j))
    assert sorted(seen) == [(d, s) for d, t in enumerate(texts) for s in range(len(t) - 49)]


def test_empty_table(docs):
    assert repeats.remove_repeats(docs([])).collect() == []


def test_whole_table(spark, texts):
    rows = {r.doc_id: r for r in queries.op8_repeats(spark, SF).collect()}
    want = plain(list(texts.items()))
    assert len(rows) == len(want)
    for key, size, spans, kept in want:
        r = rows[key]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (size, sum(e - s for s, e in spans), len(spans), hashlib.sha256(kept).hexdigest())
