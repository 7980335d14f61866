import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from ebbtide.llm import alignment, queries
from ebbtide.llm.vocabulary import byte_alphabet

A, B = public_tokenizers.path(queries.BYTE_FILE), public_tokenizers.path(queries.PIECE_FILE)


def plain(texts):
    """Rows (n_a, n_b, n_groups, n_links, n_best, count_sum, groups) by walking both token lists."""
    first, second = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    first.encode_special_tokens = True
    value = {c: b for b, c in enumerate(byte_alphabet())}

    def raw(piece):
        return bytes([int(piece[3:5], 16)]) if len(piece) == 6 and piece[:3] == "<0x" and piece[5] == ">" else piece.replace("▁", " ").encode()

    documents = []
    for text in texts:
        want, groups, links = f" {text}".encode(), [], []
        a = [(t, bytes(value[c] for c in first.id_to_token(t))) for t in first.encode(f" {text}", add_special_tokens=False).ids] if text else []
        b = [(t, raw(second.id_to_piece(t))) for t in second.encode(text)] if text else []
        if b"".join(x for _, x in a) != want or b"".join(x for _, x in b) != want:
            a = b = []
        i = k = ends_a = ends_b = 0
        own_a, own_b = [], []
        while i < len(a) or k < len(b):
            if ends_a <= ends_b:
                own_a.append(a[i][0])
                ends_a += len(a[i][1])
                i += 1
            else:
                own_b.append(b[k][0])
                ends_b += len(b[k][1])
                k += 1
            if ends_a == ends_b:
                groups.append((own_a, own_b))
                links.append((own_a[-1], own_b[-1]))
                own_a, own_b = [], []
        documents.append((len(a), len(b), groups, links))
    counts = Counter(x for d in documents for x in d[3])
    highest = Counter()
    for (_, y), n in counts.items():
        highest[y] = max(highest[y], n)
    return [
        (na, nb, len(g), len(x), sum(counts[p] == highest[p[1]] for p in x), sum(counts[p] for p in x), ";".join(f"{','.join(map(str, p))}|{','.join(map(str, q))}" for p, q in g))
        for na, nb, g, x in documents
    ]


NAMES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
AWKWARD_TEXTS = [
    None, "", " ", "  two  blanks ", "▁ mark", "<0x41> <s> </s> <unk>", "<|endoftext|>x", "\n\r\t\x0b tabs", "Ünïcode ß 漢字 🙂🇩🇪 ﬁ", "a" * 5000, "x" * 3 + "\x00", "éé", "ab" * 4000,
    "one two", "one two", "one two", "²①½", " 　wide", "ﷺ", "﻿bom", "👩‍👩‍👧‍👦" * 50,
]


def test_against_a_walk(spark):
    rnd = random.Random(3)
    alphabet = "abcdeiou stnrhé ßñ'.,!?\n漢字🙂12"
    texts = AWKWARD_TEXTS + ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 90))) for _ in range(400)]
    frame = spark.createDataFrame([(i, t, 7, 8, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_a long, count_sum long, __at string").repartition(5)
    rows = sorted(alignment.align(frame, A, B).collect(), key=lambda r: r.doc_id)
    assert [r.text for r in rows] == texts and {r["__at"] for r in rows} == {"x"}
    for r, want, text in zip(rows, plain(texts), texts):
        assert tuple(r[n] for n in NAMES) == want, text


def test_cuts_are_the_shared_ends():
    rnd = np.random.default_rng(0)
    for n, share in ((1, 0.5), (50, 0.9), (3000, 0.7), (3000, 0.02), (3000, 0.0005)):
        offsets = np.arange(1, n + 1) * 3
        keep_a, keep_b = rnd.random(n) < share, rnd.random(n) < share
        keep_a[-1] = keep_b[-1] = True
        a, b = np.union1d(offsets[keep_a], offsets[:-1] + 1), np.union1d(offsets[keep_b], offsets[:-1] + 2)
        i, k = alignment.shared_cuts(a, b)
        want = np.intersect1d(a, b)
        assert (a[i] == want).all() and (b[k] == want).all()


def test_common_ends_at_one_side_only():
    a, b = np.arange(1, 2000), np.concatenate([np.arange(1, 20), [1999]])
    i, k = alignment.shared_cuts(a, b)
    assert a[i].tolist() == b.tolist() and k.tolist() == list(range(20))


def test_rows_without_tokens(spark, docs):
    assert alignment.align(docs([]), A, B).count() == 0
    rows = alignment.align(docs([(1, None), (2, ""), (None, "")]), A, B).collect()
    assert {tuple(r[n] for n in NAMES) for r in rows} == {(0, 0, 0, 0, 0, 0, "")} and len(rows) == 3


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_query_against_a_walk(spark, texts, sf):
    rows = {r.doc_id: r for r in queries.op13_alignment(spark, f"/root/testdata/{sf}").collect()}
    assert rows.keys() == texts.keys()
    for (key, _), want in zip(texts.items(), plain(list(texts.values()))):
        r = rows[key]
        assert tuple(r[n] for n in NAMES[:-1]) == want[:-1]
        assert r.groups_sha256 == (hashlib.sha256(want[-1].encode()).hexdigest() if want[-1] else "")
