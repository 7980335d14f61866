"""Byte-level BPE by a rank file: Spark higher-order functions fold the ranked merges over the bytes of distinct words.

A word is a string with one character per token. It starts as its bytes (characters U+0000 to U+00FF). Merges never go back to
a lower rank, so taking the merges in the order of their ranks, each at all of its places from the left, comes to the same as
looking for the lowest pair again and again. Only the merge of a token whose bytes occur in the word can ever apply: these
ranks are listed where the words are cut, and the fold replaces one listed pair after the other by the character of the
joined token. Pairs and characters are literal arrays, found by rank.

Texts never travel. The distinct words of a bounded number of texts are folded once and sent to the tasks; a task cuts its
texts into words, takes what is known from there and leaves the other words to a fold beside the text that has them first: two
characters beyond those of the tokens stand for each, here and in the task's later texts. Which words are known or remembered
changes speed only. Decoding joins the tokens' bytes, one character each, from a literal array.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
from collections import Counter
from collections.abc import Callable, Iterator, Mapping
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut_lineage, map_texts, only_used, per_process, session, unused
from .vocabulary import PIECES

# Texts that frequent words are looked for in, how many words are known at most, and the most bytes of such a word: these bound
# what is sent to tasks.
SAMPLED, KNOWN, KNOWN_BYTES = 20_000, 1 << 17, 32

# Known words that a task remembers beside those it left to the fold, and words left that it remembers; one text may have more.
REMEMBERED, LEFT = 1 << 17, 1 << 18

# Characters of texts whose tokens are joined at once.
JOINED = 1 << 18

# A left word's number is written in two digits of this base (the first one may be greater).
DIGITS = 1 << 12

FIRST, SURROGATES, SURROGATE_COUNT = 0x100, 0xD800, 0x800


def _code_point(rank: int) -> int:
    """Of a token of several bytes; those of single bytes are the bytes."""
    at = FIRST + rank
    return at if at < SURROGATES else at + SURROGATE_COUNT


def _split_once(token: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """Parts of a token when all merges of lower rank are done."""
    parts, limit = [token[i : i + 1] for i in range(len(token))], ranks[token]
    while True:
        best = min(((ranks.get(a + b, limit), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))), default=(limit, 0))
        if best[0] >= limit:
            return parts
        i = best[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


@lru_cache(maxsize=2)
def read_ranks(path: str) -> dict:
    """Tokens by rank, also as JSON with one character per byte, and by rank the pair that a merge joins and the character of
    the joined token, as JSON; bounded by the file.

    The file has to hold all single bytes, and each longer token has to be the merge of two tokens that lower ranks lead
    to: then merges never go back to a lower rank, and each token comes from one pair. Else a ValueError is raised.
    """
    with open(path, "rb") as f:
        data = f.read()
    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line.strip())}
    tokens = {r: t for t, r in ranks.items()}
    if len(tokens) != len(ranks) or sorted(tokens) != list(range(len(tokens))) or any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("ranks from 0 on and all single bytes are expected")
    symbol = {t: t.decode("latin-1") if len(t) == 1 else chr(_code_point(r)) for t, r in ranks.items()}
    pairs = []
    for rank in range(len(tokens)):
        token, parts = tokens[rank], []
        if len(token) > 1:
            parts = _split_once(token, ranks)
            if len(parts) != 2:
                raise ValueError(f"token {rank} is not the merge of two tokens of lower rank")
        pairs.append("".join(symbol[part] for part in parts))
    content = [tokens[r] for r in range(len(tokens))]
    return {
        "digest": hashlib.sha256(data).hexdigest(),
        "tokens": content,
        "bytes": [ranks[bytes([b])] for b in range(256)],
        "pieces": json.dumps([t.decode("latin-1") for t in content]),
        "pairs": json.dumps(pairs),
        "symbols": json.dumps([symbol[t] for t in content]),
    }


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def folded(words: Column, merges: Column, ranks: dict) -> Column:
    """An array of words, with the ranks of each that `ranks_within` lists, as an array of their folded forms."""
    pairs, symbols = (F.from_json(F.lit(ranks[name]), "array<string>") for name in ("pairs", "symbols"))

    def step(s: Column, rank: Column) -> Column:
        return F.replace(s, F.get(pairs, rank), F.get(symbols, rank))

    def fold(word: Column, listed: Column) -> Column:
        return F.aggregate(listed, F.decode(F.encode(word, "UTF-8"), "ISO-8859-1"), step)

    return F.zip_with(words, merges, fold)


def ranks_within(ranks: dict) -> Callable[[], Callable[[str], list[int]]]:
    """What makes, in a task, the function that lists the ranks of the tokens of several bytes that occur in a word, rising."""
    tokens, digest = ranks["tokens"], ranks["digest"]

    def build():
        found = ahocorasick.Automaton()
        for rank, token in enumerate(tokens):
            if len(token) > 1:
                found.add_word(token.decode("latin-1"), rank)
        if not len(found):  # single bytes only
            return lambda word: []
        found.make_automaton()
        return lambda word: sorted({rank for _, rank in found.iter(word.encode().decode("latin-1"))})

    return lambda: per_process(("byte-pairs", digest), build)


# The usual split with its frequent alternatives first: the others begin with an apostrophe and cannot match there.
FREQUENT_FIRST = {PIECES: r""" ?\p{L}+| ?\p{N}+|'s|'t|'re|'ve|'m|'ll|'d| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""}


def _class(members: str) -> str:
    """The characters of the basic plane that an expression of the regex module matches, as ranges for a class of any engine."""
    ranges: list[list[int]] = []
    for match in regex.finditer(members, "".join(chr(i) for i in range(0x10000))):
        if ranges and ranges[-1][1] == match.start() - 1:
            ranges[-1][1] += 1
        else:
            ranges.append([match.start(), match.start()])
    return "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in ranges)


def _finder(pattern: str) -> Callable[[str], list[str]]:
    """All matches in a text. For the usual split, texts within the basic plane go to the plain engine, whose classes are quick there."""
    find = regex.compile(pattern).findall
    if pattern != FREQUENT_FIRST[PIECES]:
        return find
    letters, numbers, blanks = _class(r"\p{L}"), _class(r"\p{N}"), _class(r"\s")
    marks = f" ?[^{blanks}{letters}{numbers}]+|[{blanks}]+(?![^{blanks}])|[{blanks}]+"
    plain = re.compile(f" ?[{letters}]+| ?[{numbers}]+|'s|'t|'re|'ve|'m|'ll|'d|{marks}").findall
    beyond = re.compile("[\U00010000-\U0010ffff]").search
    return lambda text: find(text) if beyond(text) else plain(text)


def finder(pattern: str) -> Callable[[str], list[str]]:
    return per_process(("finder", pattern), lambda: _finder(pattern))


class Forms(dict):
    """Of the words a task has seen: the form of a known one, the two digits of the number of one that is left to the fold."""

    def __init__(self, known: dict[str, str], beyond: int, digits: int, most_known: int, most_left: int):
        self.known, self.beyond, self.digits = known, beyond, digits
        self.most_known, self.most_left = most_known, most_left
        self.count, self.left = 0, []

    def begin(self) -> int:
        """Before a text: words left for an earlier one stay numbered while they are not too many. How many these are."""
        if self.count >= self.most_left:
            self.clear()
            self.count = 0
        self.left = []
        return self.count

    def __missing__(self, word: str) -> str:
        form = self.known.get(word)
        if form is None:
            form = chr(self.beyond + self.count // self.digits) + chr(self.beyond + self.count % self.digits)
            self.count += 1
            self.left.append(word)
        elif len(self) - self.count >= self.most_known:
            return form
        self[word] = form
        return form


class Known(Mapping):
    """Words with their folded forms in flat arrays, sorted by the words' hashes: no object per word, wherever they are sent."""

    def __init__(self, keys: pa.Array, words: pa.Array, codes: pa.Array):
        order = np.argsort(keys.to_numpy())
        self.keys, self.words, self.codes = keys.to_numpy()[order], words.take(pa.array(order)), codes.take(pa.array(order))

    def forms(self, words: list[str]) -> list[str | None]:
        """Of each word, None where it is not known. Of words with the same hash one is found, the others are not known."""
        if not len(self.keys):
            return [None] * len(words)
        keys = np.array([xxhash.xxh64_intdigest(w, seed=42) for w in words], np.uint64).view(np.int64)
        at = pa.array(np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1))
        return [code if w == found else None for w, found, code in zip(words, self.words.take(at).to_pylist(), self.codes.take(at).to_pylist())]

    def table(self) -> dict[str, str]:
        """All words with their forms, for a process that looks many of them up."""
        return dict(zip(self.words.to_pylist(), self.codes.to_pylist()))

    def __getitem__(self, word: str) -> str:
        if (code := self.forms([word])[0]) is None:
            raise KeyError(word)
        return code

    def __iter__(self) -> Iterator[str]:
        return iter(self.words.to_pylist())

    def __len__(self) -> int:
        return len(self.keys)


def frequent_words(docs: DataFrame, text: str, pattern: str, ranks: dict) -> Known:
    """The words of about SAMPLED texts with their folded forms: about KNOWN of at most KNOWN_BYTES bytes, the frequent ones first."""
    texts = docs.select(F.col(f"`{text}`").alias("text")).filter(F.col("text") != "")
    share = SAMPLED / max(1, texts.count())
    chosen = texts.filter(F.rand(7) < share) if share < 1 else texts

    within = ranks_within(ranks)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with only_used():
            of = within()
        for batch in batches:
            merges = pa.array(list(map(of, batch.column(0).to_pylist())), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), merges], names=["word", "merges"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with only_used():
            find, counts = finder(pattern), Counter()
        for batch in batches:
            for t in batch.column(0).to_pylist():
                counts.update(find(t))
            if len(counts) > 500_000:
                yield pa.RecordBatch.from_pydict({"word": list(counts), "n": list(counts.values())})
                counts.clear()
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    words = chosen.mapInArrow(run, "word string, n long").filter(F.octet_length("word") <= KNOWN_BYTES).groupBy("word").agg(F.sum("n").alias("n"))
    words = cut_lineage(words, "words")  # read twice
    # The least count that still fits, and what share of the words of the next count does.
    least, room, part = 1, KNOWN, 0.0
    for row in words.groupBy("n").agg(F.count("*").alias("words")).orderBy(F.desc("n")).collect():  # as many rows as there are counts
        if row.words > room:
            least, part = row.n + 1, room / row.words
            break
        room -= row.words
    lucky = F.pmod(F.xxhash64("word"), F.lit(1 << 20)) < int(part * (1 << 20))
    kept = words.filter((F.col("n") >= least) | ((F.col("n") == least - 1) & lucky)).select("word")
    # Few bytes make few files and those few tasks: as many as any shuffle has.
    kept = kept.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "word")
    kept = kept.mapInArrow(listed, "word string, merges array<int>")
    code = F.get(folded(F.array("word"), F.array("merges"), ranks), F.lit(0))
    found = kept.select("word", code.alias("code"), F.xxhash64("word").alias("key")).toArrow()
    return Known(*(found[c].combine_chunks() for c in ("key", "word", "code")))


def encode(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns `keep` (all by default) with `ids`, an array of integers, and `n_tokens`.

    Every match of `pattern` (a split in the dialect of byte-level rank files) is encoded by itself, whole; text outside
    of matches is left out, special strings are plain text. A null or empty text has no ids; repeated rows each give a
    row; input columns named `ids` or `n_tokens` are replaced. An empty table gives no rows.
    """
    spark = session(docs.sparkSession)
    ranks, pattern = read_ranks(ranks_path), FREQUENT_FIRST.get(pattern, pattern)
    words = spark.sparkContext.broadcast(frequent_words(docs, text, pattern, ranks))
    single = np.array(ranks["bytes"], np.int32)
    run = uuid.uuid4().hex  # each call has words of its own
    within = ranks_within(ranks)
    code, left, merges, base, both = (unused(docs, f"__{n}") for n in ("code", "left", "merges", "base", "both"))
    kept = [c for c in (docs.columns if keep is None else keep) if c not in ("ids", "n_tokens")]
    beyond = max(0x10000, _code_point(len(ranks["tokens"])))  # no token has this character or a later one

    def cut():
        find, of, known = finder(pattern), within(), per_process(("known", run), lambda: words.value.table())
        forms = Forms(known, beyond, DIGITS, REMEMBERED, LEFT)

        def one(t: str) -> tuple[str, list[str], list[list[int]], int]:
            """The text's characters, the words that are left to the fold now with their ranks, and how many were left before."""
            begin = forms.begin()
            return "".join(map(forms.__getitem__, find(t))), forms.left, list(map(of, forms.left)), begin

        return lambda texts: [list(c) for c in zip(*map(one, texts))] if texts else [[], [], [], []]

    def join():
        pool, ends = np.zeros(0, np.uint32), np.zeros(1, np.int64)  # characters of the task's left words, and where each ends
        rank = np.arange(beyond, dtype=np.int32) - FIRST  # of a character
        rank[SURROGATES:] -= SURROGATE_COUNT
        rank[:FIRST] = single

        def points(codes: list[str]) -> np.ndarray:
            return np.frombuffer("".join(codes).encode("utf-32-le"), np.uint32)

        def ids(rows: list) -> list[np.ndarray]:
            """Of texts between which the task did not begin anew."""
            nonlocal pool, ends
            if rows[0][base] + 1 < len(ends):
                pool, ends = pool[: ends[rows[0][base]]], ends[: rows[0][base] + 1]
            if new := [w for row in rows for w in row[left]]:
                pool = np.concatenate([pool, points(new)])
                ends = np.concatenate([ends, ends[-1] + np.cumsum(list(map(len, new)))])
            own = points([row[code] for row in rows])
            stops = np.cumsum([0, *(len(row[code]) for row in rows)])
            first, second = np.flatnonzero(own >= beyond).reshape(-1, 2).T
            if len(first):
                word = (own[first].astype(np.int64) - beyond) * DIGITS + (own[second].astype(np.int64) - beyond)
                sizes, begins = np.ones(len(own), np.int64), np.arange(len(pool), len(pool) + len(own))
                sizes[first], sizes[second], begins[first] = ends[word + 1] - ends[word], 0, ends[word]
                after = np.concatenate([[0], np.cumsum(sizes)])
                own = np.concatenate([pool, own])[np.arange(after[-1]) + np.repeat(begins - after[:-1], sizes)]
                stops = after[stops]
            found = rank[own]
            return [found[a:b] for a, b in zip(stops, stops[1:])]

        def work(rows):
            found, part, size = [], [], 0
            for row in rows:
                if part and (size >= JOINED or row[base] < part[-1][base] + len(part[-1][left])):
                    found += ids(part)
                    part, size = [], 0
                part.append(row)
                size += len(row[code])
            if part:
                found += ids(part)
            return [found, [len(i) for i in found]]

        return work

    lists = T.ArrayType(T.ArrayType(T.IntegerType()))
    made = [(code, T.StringType()), (left, T.ArrayType(T.StringType())), (merges, lists), (base, T.IntegerType())]
    rows = map_texts(docs, text, kept, made, cut)
    rows = rows.select(*[F.col(f"`{c}`") for c in kept], F.struct(code, folded(F.col(left), F.col(merges), ranks).alias(left), base).alias(both))
    return map_texts(rows, both, kept, [("ids", T.ArrayType(T.IntegerType())), ("n_tokens", T.LongType())], join)


def decode(encoded: DataFrame, ranks_path: str, ids: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """Columns `keep` (all by default) with `decoded`, the concatenated bytes of the tokens.

    Null or empty ids give no bytes; an id outside of the file, or a null one, is an error; a clashing input column `decoded` is replaced.
    """
    session(encoded.sparkSession)
    own, kept = F.col(f"`{ids}`"), [c for c in (encoded.columns if keep is None else keep) if c != "decoded"]

    def joined(pieces: Column) -> Column:
        def piece(i: Column) -> Column:
            return F.coalesce(F.get(pieces, i), F.raise_error(F.lit("an id outside of the file")))

        return F.array_join(F.transform(own, piece), "")

    pieces = F.from_json(F.lit(read_ranks(ranks_path)["pieces"]), "array<string>")
    decoded = F.encode(F.coalesce(_let(pieces, joined), F.lit("")), "ISO-8859-1")
    return encoded.select(*[F.col(f"`{c}`") for c in kept], decoded.alias("decoded"))
