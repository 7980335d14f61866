import base64
import hashlib
import random
import time

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from ebbtide.llm import byte_pairs, queries

from test_tokens import samples

SF = "/root/testdata/sf0.001"
RANKS, PATTERN = public_tokenizers.path(queries.RANK_FILE), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def encoded(spark, texts, **options):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    both = byte_pairs.decode(byte_pairs.encode(frame, RANKS, PATTERN, **options), RANKS)
    return sorted(both.collect(), key=lambda r: r.doc_id)


def test_against_the_library(spark, library):
    texts = samples() + ["-" * 3000, "=-" * 400, "na" * 700, "x" * 20000, "<|endoftext|>", "q" + "zx" * 50 + "漢字" * 30]
    for r, text in zip(encoded(spark, texts), texts):
        assert r.ids == library.encode_ordinary(text) and r.n_tokens == len(r.ids), text[:60]
        assert bytes(r.decoded) == text.encode()


def test_every_character(spark, library):
    """All code points between letters, digits, blanks and marks: classes are those of the library."""
    points = [chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    texts = ["".join(f"{c}a {c}1{c}. {c} " for c in points[i : i + 512]) for i in range(0, len(points), 512)]
    wrong = [i for i, (r, text) in enumerate(zip(encoded(spark, texts), texts)) if r.ids != library.encode_ordinary(text)]
    assert not wrong


@pytest.mark.parametrize("known", [0, 3, 8])
def test_words_beyond_the_table(spark, library, monkeypatch, known):
    monkeypatch.setattr(byte_pairs, "KNOWN", known)
    texts = ["one two three four five six seven eight nine ten " * 3, "anticonstitutionnellement 12345 !!!???"]
    assert [r.ids for r in encoded(spark, texts)] == [library.encode_ordinary(t) for t in texts]


@pytest.mark.parametrize("remembered, left, digits", [(1 << 19, 1 << 18, 4), (12, 1 << 18, 1 << 12), (1 << 19, 5, 3)])
def test_words_left_to_the_fold_are_remembered(spark, library, monkeypatch, remembered, left, digits):
    """Numbers of several digits, tasks that begin anew, and texts with more words than are remembered."""
    for name, value in (("KNOWN", 2), ("REMEMBERED", remembered), ("LEFT", left), ("DIGITS", digits)):
        monkeypatch.setattr(byte_pairs, name, value)
    texts = [" ".join(f"word{(7 * i + j) % 31}é the" for j in range(i % 9)) for i in range(60)] + [None, "", "漢字 漢字"]
    assert [r.ids for r in encoded(spark, texts)] == [library.encode_ordinary(t or "") for t in texts]


def test_a_word_is_folded_once_a_task(spark, monkeypatch):
    """Before, every occurrence of a word that was not known went to the fold."""
    monkeypatch.setattr(byte_pairs, "KNOWN", 0)
    made, map_texts = [], byte_pairs.map_texts
    monkeypatch.setattr(byte_pairs, "map_texts", lambda *a, **k: made.append(map_texts(*a, **k)) or made[-1])
    frame = spark.createDataFrame([(i, "same words in all texts same words") for i in range(50)], "doc_id long, text string").coalesce(1)
    assert byte_pairs.encode(frame, RANKS, PATTERN).count() == 50
    assert sorted(w for r in made[0].collect() for w in r["__left"]) == [" all", " in", " same", " texts", " words", "same"]


def test_known_words_are_flat_and_those_of_one_hash_are_told_apart():
    import pyarrow as pa
    import xxhash

    key = lambda w: xxhash.xxh64_intdigest(w, seed=42) - (1 << 64 if xxhash.xxh64_intdigest(w, seed=42) >> 63 else 0)
    known = byte_pairs.Known(pa.array([key("b"), key("a"), key("c")]), pa.array(["b", "a", "other"]), pa.array(["B", "A", "O"]))
    assert known.forms(["a", "b", "c", "d"]) == ["A", "B", None, None] and known["a"] == "A" and "c" not in known
    assert byte_pairs.Known(pa.array([], pa.int64()), pa.array([], pa.string()), pa.array([], pa.string())).forms(["a"]) == [None]


def test_decoding_of_nulls_and_foreign_ids(spark, library):
    rows = [(0, [1, 2, 300]), (1, None), (2, []), (3, [5])]
    frame = spark.createDataFrame(rows, "doc_id long, ids array<int>").coalesce(1)
    found = {r.doc_id: bytes(r.decoded) for r in byte_pairs.decode(frame, RANKS).collect()}
    assert found == {k: library.decode_bytes(ids or []) for k, ids in rows}
    for bad in ([1, 10**8], [-1], [None]):
        with pytest.raises(Exception):
            byte_pairs.decode(spark.createDataFrame([(0, bad)], "doc_id long, ids array<int>"), RANKS).collect()


def test_awkward_rows(spark, docs, awkward, library):
    frame = docs(awkward).selectExpr("*", "1 AS ids", "2 AS n_tokens", "3 AS decoded", "4 AS __code")
    found = byte_pairs.decode(byte_pairs.encode(frame, RANKS, PATTERN), RANKS)
    assert sorted(found.columns) == sorted(frame.columns)
    want = sorted((repr(k), library.encode_ordinary(t or ""), (t or "").encode()) for k, t in awkward)
    assert sorted((repr(r.doc_id), r.ids, bytes(r.decoded)) for r in found.collect()) == want
    assert byte_pairs.encode(docs([]), RANKS, PATTERN).count() == 0


def test_known_words_are_bounded_and_folded_like_others(spark, library, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ranks, pattern = byte_pairs.read_ranks(RANKS), byte_pairs.FREQUENT_FIRST[PATTERN]
    monkeypatch.setattr(byte_pairs, "KNOWN", 700)
    known = byte_pairs.frequent_words(docs, "text", pattern, ranks)
    assert 500 < len(known) < 900 and {" the", ",", "."} <= set(known)
    assert all(len(library.encode_ordinary(w)) == len(c) for w, c in known.items())


def test_texts_stay_where_they_are(spark):
    encoded = byte_pairs.encode(spark.read.parquet(f"{SF}/documents.parquet"), RANKS, PATTERN)
    assert "Exchange" not in encoded._jdf.queryExecution().executedPlan().treeString()


def test_ranks_that_are_no_merges_are_refused(tmp_path):
    singles = [bytes([b]) for b in range(256)]
    for more in ([b"abc"], [b"ab", b"abcd"]):
        path = tmp_path / f"{len(more)}.tiktoken"
        path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % i for i, t in enumerate(singles + more)))
        with pytest.raises(ValueError):
            byte_pairs.read_ranks(str(path))


def test_query_against_the_library(spark, texts, library):
    rows = queries.op12_byte_pairs(spark, SF).select("*", F.length("ids_sha256")).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode_bytes(ids)).hexdigest()


def test_a_long_word_of_many_merges(spark, library):
    """Before, each merge of a long word made all of its pairs be looked up again: 137 s for this one, 12 s since."""
    word = "".join(random.Random(5).choices("abcdefghijklmnopqrstuvwxyzéüñ", k=120_000))
    frame = spark.createDataFrame([(0, word)], "doc_id long, text string")
    begin = time.monotonic()
    (row,) = byte_pairs.encode(frame, RANKS, PATTERN).collect()
    assert time.monotonic() - begin < 45
    assert row.ids == library.encode_ordinary(word)


def test_known_words_fit_the_driver(spark):
    """What a table of many frequent words sends to the driver and to each task; before, all 200,000 words."""
    frame = spark.createDataFrame([(i, " ".join(f"w{chr(97 + j % 26)}x{i * 100 + j:x}" for j in range(100))) for i in range(2000)], "doc_id long, text string")
    known = byte_pairs.frequent_words(frame, "text", r"\S+", byte_pairs.read_ranks(RANKS))
    assert 100_000 < len(known) < 140_000
    assert known.keys.nbytes + known.words.nbytes + known.codes.nbytes < 8 << 20


def test_the_plain_engine_cuts_like_the_other():
    import regex

    draw, pattern = random.Random(3), byte_pairs.FREQUENT_FIRST[PATTERN]
    signs = ["a", "é", "漢", "ß", "1", "²", "٣", "Ⅷ", " ", "\n", "\t", "\x1c", "\x85", " ", " ", "　", "'s", "'ll", "'", "!", "́", "‍", "🙂", "𝒳", "𝟙"]
    find, cut = byte_pairs._finder(pattern), regex.compile(pattern).findall
    for n in range(4000):
        text = "".join(draw.choices(signs if n % 2 else signs[:-3], k=draw.randrange(30)))
        assert find(text) == cut(text), ascii(text)


def test_a_file_of_single_bytes(spark, tmp_path):
    path = tmp_path / "single.tiktoken"
    path.write_bytes(b"".join(base64.b64encode(bytes([b])) + b" %d\n" % b for b in range(256)))
    frame = spark.createDataFrame([(0, "one é")], "doc_id long, text string")
    (row,) = byte_pairs.decode(byte_pairs.encode(frame, str(path), PATTERN), str(path)).collect()
    assert row.ids == list("one é".encode()) and bytes(row.decoded) == "one é".encode()
