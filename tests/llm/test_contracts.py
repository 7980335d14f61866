"""Cases that earlier versions got wrong: characters, runs beside patterns, keys, hashed counts."""

import random
import unicodedata
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ebbtide.llm import common, language, queries, repeats, secret_spans, token_counts, toxicity
from ebbtide.llm.vocabulary import read_vocabulary

WORD = public_tokenizers.path(queries.WORD_FILE)


def test_every_assigned_character_counts_as_in_the_library():
    own, library = token_counts.TextCounter(read_vocabulary(WORD)), Tokenizer.from_file(WORD)
    points = [chr(i) for i in range(0x110000) if unicodedata.category(chr(i)) not in ("Cn", "Cs", "Co")] + ["\ua7cb", "\ua7dc"]
    texts = [f"a{c}b {c}1{c}" for c in points]
    for i in range(0, len(texts), 50_000):
        part = texts[i : i + 50_000]
        wrong = [t for t, e in zip(part, library.encode_batch(part, add_special_tokens=False)) if own.count(t) != len(e.ids)]
        assert not wrong


@pytest.mark.parametrize("text", ["½ ²", "①②③", "Ⅷ ↂ", "12 ३ ٤", "!? …", "⁰₁ 〇"[:2]])
def test_number_signs_are_no_letters(docs, text):
    frame = docs([(1, text), (2, "the house and the garden"), (3, "das Haus und der Garten")])
    known = frame.filter("doc_id > 1").select(F.when(F.col("doc_id") == 2, "en").otherwise("de").alias("lang"), "text")
    found = {r.doc_id: r.languages for r in language.identify(frame, known).collect()}
    assert not found[1] and found[2] and found[3]


def random_text(n, seed=4):
    return "".join(random.Random(seed).choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", k=n))


@pytest.mark.parametrize("beside", ["-token=abcdefgh12", "/secret=abcdefgh1", "+" + "0123456789abcdef" * 2])
def test_what_a_pattern_leaves_of_a_run_is_tested(beside):
    key = random_text(40)
    alone = [s for s in secret_spans.find(key) if s[0] == "random"]
    after = [s for s in secret_spans.find(f"x {key}{beside} y") if s[0] == "random"]
    assert len(alone) == 1 and any(s[1] == 2 and s[2] >= 42 and s[3] < 0.05 for s in after)
    before = [s for s in secret_spans.find(f"{beside.lstrip('-/+')}!{key}") if s[0] == "random"]
    assert any(s[2] - s[1] >= 39 for s in before)
    # Patterns keep what is theirs.
    for text in (f"x {key}{beside} y",):
        spans = secret_spans.find(text)
        assert all(a[2] <= b[1] for a in spans for b in spans if a[0] == "random" and b[0] != "random" and a[1] < b[1])
        assert sum(s[0] != "random" for s in spans) >= 1


def test_repeats_by_keys_of_any_order(spark):
    passage = "these are fifty bytes and some more that are shared by several texts of the table"
    rows = [("b", f"one {passage} two"), ("a", f"three {passage} four"), (None, f"five {passage}"), ("c", None), ("b", "short")]
    found = repeats.remove_repeats(spark.createDataFrame(rows, "doc_id string, text string"))
    kept = sorted((repr(r.doc_id), bytes(r.kept).decode()) for r in found.collect())
    numbers = {"a": 0, "b": 1, "c": 2}
    same = repeats.remove_repeats(spark.createDataFrame([(numbers.get(k), t) for k, t in rows], "doc_id long, text string"))
    names = {i: k for k, i in numbers.items()}
    assert kept == sorted((repr(names.get(r.doc_id)), bytes(r.kept).decode()) for r in same.collect())
    assert dict(kept)["'a'"] == rows[1][1]


def test_hashed_counts_are_those_of_single_grams(spark):
    rnd = random.Random(1)
    texts = ["".join(rnd.choice("abcdefßλ漢é𝒳 ") for _ in range(rnd.randint(0, 80))) for _ in range(300)] + ["", "a b", "x1 y"]
    counts, pairs = toxicity.learn_letters(spark.createDataFrame([(t,) for t in texts], f"{common.TEXT} string"))
    want, want_pairs = Counter(), Counter()
    for text in texts:
        for word in text.lower().split():
            if word.isalpha():
                framed = f"<<{word}>"
                for i in range(len(framed) - 2):
                    want[toxicity.bucket(framed[i : i + 3])] += 1
                    want_pairs[toxicity.bucket(framed[i : i + 2])] += 1
    for got, wanted in ((counts, want), (pairs, want_pairs)):
        assert {int(i): int(got[i]) for i in np.flatnonzero(got)} == dict(wanted)


def test_tables_of_one_operator_at_a_time():
    with common.only_used():
        common.per_process(("one", 1), lambda: "a")
    with common.only_used():
        common.per_process(("two", 1), lambda: "b")
    assert set(common._KEPT) == {("two", 1)}
    with common.only_used():
        pass
    assert not common._KEPT


def test_very_long_texts(spark, docs):
    """Half a megabyte of words, and of one character, in every text operator that reads whole texts."""
    rnd = random.Random(0)
    words = " ".join(rnd.choice(["the", "house", "garden", "secret", "running", "42", "über", "noch"]) for _ in range(80_000))
    frame = docs([(1, words), (2, "z" * 200_000), (3, None)])
    assert [r.n_bytes for r in token_counts.token_counts(frame, WORD).orderBy("doc_id").collect()] == [len(words.encode()), 200_000, 0]
    assert secret_spans.secret_spans(frame).count() == 3
    labelled = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    assert toxicity.toxicity(frame, labelled).count() == 3
    assert language.identify(frame, spark.createDataFrame([("en", words)], "lang string, text string")).count() == 3
