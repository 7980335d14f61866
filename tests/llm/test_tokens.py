import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ebbtide.llm import bpe, queries, token_counts
from ebbtide.llm.vocabulary import read_vocabulary

SF = "/root/testdata/sf0.001"
WORD, BYTE = (public_tokenizers.path(n) for n in (queries.WORD_FILE, queries.BYTE_FILE))
ALPHABET = "abcdeiou stnrhé ßΣσİKſ \u0085\x1c\x1f​　\t\n\r\x0b\x0c'’sS't12३½🙂🇩🇪一二éͅ﻿<|endoftext|>!?.--"


def samples():
    rnd = random.Random(5)
    mixed = ["".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 60))) for _ in range(3000)]
    plain = ["".join(rnd.choice("abt ehrnis") for _ in range(rnd.randint(0, 40))) for _ in range(3000)]
    runs = ["a" * n for n in range(60)] + [" " * n + "x" for n in range(30)] + ["lol" * 30, "ab" * 500, "".join(map(chr, range(1, 3000)))]
    return mixed + plain + runs + ["<|endoftext|>" * 3, "x<|startoftext|> y <|ENDOFTEXT|>", "hello's we'LL don't 'S", ""]


def test_counts_against_the_library():
    own, library = token_counts.TextCounter(read_vocabulary(WORD)), Tokenizer.from_file(WORD)
    texts = samples()
    assert [own.count(t) for t in texts] == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_ids_against_the_library():
    own, library = bpe.Encoder(read_vocabulary(BYTE)), Tokenizer.from_file(BYTE)
    texts = samples()
    for text, encoding in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        packed = own.encode(text)
        assert np.frombuffer(packed, "<u4").tolist() == encoding.ids
        assert own.decode(packed) == library.decode(encoding.ids, skip_special_tokens=False) == text


def test_merging_needs_no_memory_of_words(monkeypatch):
    monkeypatch.setattr(token_counts, "REMEMBERED_WORDS", 2)
    monkeypatch.setattr(bpe, "REMEMBERED_PIECES", 2)
    counter, encoder = token_counts.TextCounter(read_vocabulary(WORD)), bpe.Encoder(read_vocabulary(BYTE))
    text = "one two three four one two three four " * 3
    assert counter.count(text) == len(Tokenizer.from_file(WORD).encode(text, add_special_tokens=False).ids)
    assert encoder.decode(encoder.encode(text)) == text and len(counter.words) <= 2


def test_awkward_rows(docs, awkward):
    frame = docs(awkward).selectExpr("*", "1 AS n_bytes", "2 AS ids", "3 AS n_tokens", "4 AS decoded")
    library = Tokenizer.from_file(WORD)
    want = sorted((repr(k), len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for k, t in awkward)
    assert sorted((repr(r.doc_id), r.n_bytes, r.n_tokens) for r in token_counts.token_counts(frame, WORD).collect()) == want
    decoded = bpe.decode(bpe.encode(frame, BYTE), BYTE)
    assert sorted(decoded.columns) == sorted(frame.columns)
    assert sorted((repr(r.doc_id), r.decoded) for r in decoded.collect()) == sorted((repr(k), t or "") for k, t in awkward)
    assert token_counts.token_counts(docs([]), WORD).count() == 0 and bpe.encode(docs([]), BYTE).count() == 0


def test_whole_tables(spark, texts):
    library = Tokenizer.from_file(WORD)
    for r in queries.op5_token_counts(spark, SF).collect():
        n = len(library.encode(texts[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 2048)
    library = Tokenizer.from_file(BYTE)
    rows = queries.op10_bpe(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_other_models_are_refused(tmp_path):
    path = tmp_path / "unigram.json"
    path.write_text('{"model": {"type": "Unigram"}, "pre_tokenizer": null}')
    with pytest.raises(ValueError):
        read_vocabulary(str(path))


def test_pairs_are_judged_once_and_bounds_change_nothing(monkeypatch):
    """New words meet pairs of tokens that others had; small memories, turned over many times, give the same ids."""
    library = Tokenizer.from_file(BYTE)
    words = [f" {a}{b}{c}" for a in ("re", "an", "thou") for b in ("tion", "ea", "onou", "ly") for c in ("s", "ing", "neth", "er", "wh")]
    text = "".join(words) * 2
    plain = bpe.Encoder(read_vocabulary(BYTE))
    asked, judge = [], bpe.Encoder.compatible
    monkeypatch.setattr(bpe.Encoder, "compatible", lambda self, *pair: asked.append(pair) or judge(self, *pair))
    ids = plain.encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert len(asked) == len(set(asked))
    monkeypatch.setattr(bpe, "REMEMBERED_PIECES", 6)
    monkeypatch.setattr(bpe, "REMEMBERED_PAIRS", 5)
    small = bpe.Encoder(read_vocabulary(BYTE))
    assert small.encode(text) == ids
    assert len(small) <= 3 and len(small.older) <= 3 and sum(map(len, small.pairs.values())) <= 5
