"""Toxicity of whole texts, scored after undoing disguises with a noisy-channel model.

A disguised word is read as a lattice: every character may stand for itself or for letters that it resembles, a repeated
character may be one, a mark may be nothing, a blank between single characters may be nothing or end a word. The Viterbi path
through the lattice under a character trigram model is the restored word, or the words of a run of single characters. The trigram model is counted over all documents; which restored words and word
beginnings speak for toxicity is learned from labelled documents.

The trigram model is hashed into a fixed number of buckets and the learned weights have a bound of their own, so what is
broadcast does not grow with the input.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import TEXT, Scratch, map_texts, only_used, session

# Labelled rows that weights are learned from at most, of each class, chosen by a hash of their key; most weights.
FIT_ROWS, MOST_WEIGHTS = 20_000, 50_000
# A feature is tried when it is in this share of the toxic documents, and in so many; it is kept when the lower bound of its
# log odds reaches LEAST_WEIGHT. START is the log odds of a text without any feature.
TRIED_SHARE, TRIED_ROWS, LEAST_WEIGHT, CONFIDENCE = 0.003, 5, 2.0, 1.65
START = -4.0
BEGINNINGS = (4, 5, 6, 7)
BUCKETS = 1 << 18
# Words of up to so many characters are remembered, up to so many per task: changes speed only.
REMEMBERED_CHARS, REMEMBERED_WORDS = 64, 100_000

# Letters that a sign may stand for.
RESEMBLES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t",
    "(": "c", "€": "e", "*": "aeiou", "#": "aeiou", "%": "aeiou",
}
SEPARATORS = set(".-_*~'`^")
EDGE = ".,;:?!\"'()[]{}<>«»“”„‘’…-–—_*~`^=/\\"
LETTER = re.compile(r"[^\W\d_]")
TRAILING = re.compile(r"[*#%&$!|+]{3,}$")
REPEATED = re.compile(r"(.)\1\1", re.S)
# Longer words are cut at marks that stand for no letter and part none.
LONG_WORD = 40
PIECES = re.compile(r"[^\w" + re.escape("".join(sorted((set(RESEMBLES) | SEPARATORS)))) + "]+")
# Signs that make a word without letters and digits worth decoding.
LETTERLIKE = set("@$")
# Log costs of the channel: reading a sign as a letter, dropping a mark, dropping a repetition (a
# character that is there just twice is rarely one too many).
AS_LETTER, DROP_MARK, DROP_REPEAT, DROP_DOUBLE = -1.0, -0.5, -0.5, -4.0


# Odd multipliers of the gram hash, and the 64 bits it lives in.
MULTIPLIERS, FINISH, WORD_BITS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9), 0xD6E8FEB86659FD93, (1 << 64) - 1


def bucket(gram: str) -> int:
    """Of two or three characters; `buckets` gives the same for many at once."""
    h = sum(ord(c) * m for c, m in zip(gram, MULTIPLIERS)) & WORD_BITS
    return ((h ^ h >> 32) * FINISH & WORD_BITS) >> 46


def buckets(points: np.ndarray, size: int) -> np.ndarray:
    """Of all runs of `size` code points."""
    n = len(points) - size + 1
    h = sum(points[i : n + i] * np.uint64(MULTIPLIERS[i]) for i in range(size))
    return ((h ^ (h >> np.uint64(32))) * np.uint64(FINISH)) >> np.uint64(46)


class Letters:
    """Log probability of a character after two others, from hashed trigram counts."""

    def __init__(self, counts: np.ndarray, pairs: np.ndarray):
        self.counts, self.pairs, self.seen = counts, pairs, {}

    def log(self, a: str, b: str, c: str) -> float:
        gram = a + b + c
        value = self.seen.get(gram)
        if value is None:
            if len(self.seen) > 200_000:
                self.seen.clear()
            value = self.seen[gram] = math.log((self.counts[bucket(gram)] + 0.05) / (self.pairs[bucket(a + b)] + 2.0))
        return value


def disguised(word: str) -> bool:
    """Whether a word in lower case mixes letters with signs that may stand for letters, repeats one thrice, or has marks within."""
    if word.isalpha():
        return REPEATED.search(word) is not None
    core = TRAILING.sub("", word).strip(EDGE)
    if core.isalpha():
        return REPEATED.search(core) is not None
    signs = sum(c in RESEMBLES or c in SEPARATORS for c in core)
    letters = sum(c.isalpha() for c in word)
    if not letters:
        return len(core) > 2 and core == word and all(c in RESEMBLES and not c.isdigit() for c in core) and len(set(core)) > 1 and not LETTERLIKE.isdisjoint(core)
    return 0 < signs <= 2 * letters or REPEATED.search(core) is not None


def restore(word: str, model: Letters) -> str:
    """The Viterbi path through the lattice of a word in lower case, or of single characters with blanks between them."""
    word = TRAILING.sub("", word).lstrip(EDGE.replace("*", "").replace("(", "").replace("!", "")).rstrip(".,;:?!\"')]}")
    # A path is a chain of (path before, character).
    paths: dict[tuple[str, str], tuple[float, tuple | None]] = {("<", "<"): (0.0, None)}
    signs = word.replace(" ", "")
    previous, i = "", -1
    for c in word:
        step: dict[tuple[str, str], tuple[float, tuple | None]] = {}
        if c == " ":
            # Nothing, or the end of a word.
            ended = [(score + model.log(a, b, ">"), path) for (a, b), (score, path) in paths.items() if b != "<"]
            step.update(paths)
            if ended:
                score, path = max(ended, key=lambda x: x[0])
                if score > step.get(("<", "<"), (-1e300,))[0]:
                    step["<", "<"] = score, (path, " ")
            paths = step
            continue
        i += 1
        readings = [(c, 0.0)] if c.isalpha() else []
        readings += [(letter, AS_LETTER) for letter in RESEMBLES.get(c, "")]
        long_run = c == previous and (signs[i + 1 : i + 2] == c or signs[i - 2 : i - 1] == c)
        dropped = DROP_REPEAT if long_run else DROP_DOUBLE if c == previous else DROP_MARK if c in SEPARATORS or not readings else None
        for (a, b), (score, path) in paths.items():
            for letter, cost in readings:
                value = score + cost + model.log(a, b, letter)
                if value > step.get((b, letter), (-1e300,))[0]:
                    step[b, letter] = value, (path, letter)
            if dropped is not None and score + dropped > step.get((a, b), (-1e300,))[0]:
                step[a, b] = score + dropped, path
        # States are pairs of characters that signs here may stand for: the alphabet bounds them, none is dropped.
        paths, previous = step, c
    path = max(((score + (model.log(a, b, ">") if b != "<" or " " not in word else 0.0), path) for (a, b), (score, path) in paths.items()), key=lambda x: x[0])[1]
    found = []
    while path is not None:
        path, letter = path
        found.append(letter)
    return "".join(reversed(found))


def raw_words(text: str) -> set[str]:
    """Distinct words in lower case; runs of single characters put together, and once more with blanks between them."""
    words = text.lower().split()
    found = set(words)
    single = bytes([len(w) == 1 for w in words])
    at = single.find(b"\1\1\1")
    while at >= 0:
        end = single.find(b"\0", at)
        run = words[at : end if end >= 0 else len(words)]
        found.add("".join(run))
        if any(c.isalpha() for c in run):
            found.add(" ".join(run))
        at = single.find(b"\1\1\1", at + len(run))
    return found


def restored_words(raw: str, model: Letters) -> list[str]:
    """The words that one of `raw_words` is restored to: several for a run of single characters and for a long word."""
    if " " in raw:
        return restore(raw, model).split()
    return [plain(w, model) for w in ([raw] if len(raw) <= LONG_WORD else PIECES.split(raw)) if w]


def plain(word: str, model: Letters) -> str:
    return restore(word, model) if disguised(word) else TRAILING.sub("", word).strip(EDGE)


def features(word: str) -> list[str]:
    """The word and its beginnings."""
    return [word, *[word[:n] + "-" for n in BEGINNINGS if len(word) >= n]] if len(word) > 2 else []


def letter_counts(texts: DataFrame) -> DataFrame:
    """(kind, bucket, n) of trigrams and of their first two characters over all words of column __text."""

    def run(batches):
        with only_used():
            sums = np.zeros((2, BUCKETS), np.int64)
        words: Counter = Counter()

        def settle():
            if not words:
                return
            points = np.frombuffer("".join(f"<<{w}>" for w in words).encode("utf-32-le"), np.uint32).astype(np.uint64)
            sizes = np.fromiter(map(len, words), np.int64, len(words)) + 3
            # Grams that begin at the last two characters of a word would reach into the next.
            begins = np.ones(len(points), bool)
            ends = np.cumsum(sizes)
            begins[ends - 1] = begins[ends - 2] = False
            times = np.repeat(np.fromiter(words.values(), np.int64, len(words)), sizes)[begins]
            for kind, size in ((0, 3), (1, 2)):
                hashed = np.append(buckets(points, size), np.zeros(size - 1, np.uint64))[begins]
                sums[kind] += np.bincount(hashed.astype(np.int64), weights=times, minlength=BUCKETS).astype(np.int64)
            words.clear()

        for batch in batches:
            for text in batch.column(0).to_pylist():
                words.update(w for w in text.lower().split() if w.isalpha())
                if len(words) > 200_000:
                    settle()
        settle()
        for kind in (0, 1):
            at = np.flatnonzero(sums[kind])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), kind), pa.int32()), pa.array(at, pa.int32()), pa.array(sums[kind][at], pa.int64())], names=["kind", "bucket", "n"])

    return texts.mapInArrow(run, "kind int, bucket int, n long").groupBy("kind", "bucket").agg(F.sum("n").alias("n"))


def learn_letters(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """At most 2 x BUCKETS counts, whatever the corpus holds."""
    rows = letter_counts(texts).toPandas()
    counts = np.zeros((2, BUCKETS))
    counts[rows["kind"].to_numpy(dtype=np.int64), rows["bucket"].to_numpy(dtype=np.int64)] = rows["n"]
    return counts[0], counts[1]


def apart(texts: DataFrame) -> DataFrame:
    """One text of each group of copies, near ones included for the most part: the least hash of its five-word shingles.

    Copies are no independent evidence: without this every rare word of a text with many copies would look like a sign.
    """

    def mark(text: str) -> int:
        words = text.lower().split()
        return min((zlib.crc32(" ".join(words[i : i + 5]).encode()) for i in range(max(1, len(words) - 4))), default=0)

    marked = map_texts(texts, TEXT, [], [("text", T.StringType()), ("mark", T.LongType())], lambda: lambda batch: [batch, [mark(t) for t in batch]])
    return marked.groupBy("mark").agg(F.min("text").alias(TEXT)).select(TEXT)


def feature_rows(texts: DataFrame, letters, tried=None) -> DataFrame:
    """(feature, n): documents of column __text with each feature, or with each of the `tried` features."""

    def run(batches):
        with only_used():
            model = Letters(*letters.value)
        wanted = None if tried is None else tried.value
        sums: Counter = Counter()
        cache: dict[str, list[str]] = {}

        def rows():
            return pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array(list(sums.values()), pa.int64())], names=["feature", "n"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                own: set[str] = set()
                for word in raw_words(text):
                    found = cache.get(word)
                    if found is None:
                        found = [f for w in restored_words(word, model) for f in features(w) if wanted is None or f in wanted]
                        if len(word) <= REMEMBERED_CHARS:
                            if len(cache) >= REMEMBERED_WORDS:
                                cache.clear()
                            cache[word] = found
                    own.update(found)
                sums.update(own)
            if len(sums) > 500_000:
                yield rows()
                sums.clear()
        yield rows()

    return texts.mapInArrow(run, "feature string, n long").groupBy("feature").agg(F.sum("n").alias("n"))


def learn_weights(toxic: DataFrame, clean: DataFrame, letters) -> tuple[dict[str, float], float]:
    """Weights by feature, at most MOST_WEIGHTS, and the log odds of a document without any."""
    n_toxic, n_clean = toxic.count(), clean.count()
    if not n_toxic or not n_clean:
        return {}, START
    least = max(TRIED_ROWS, TRIED_SHARE * n_toxic)
    positive = feature_rows(toxic, letters).filter(F.col("n") >= least).orderBy(F.desc("n"), "feature").limit(MOST_WEIGHTS)
    counts = {r["feature"]: r["n"] for r in positive.collect()}
    spark = toxic.sparkSession
    against = {r["feature"]: r["n"] for r in feature_rows(clean, letters, spark.sparkContext.broadcast(frozenset(counts))).collect()}
    weights = {}
    for feature, t in counts.items():
        c = against.get(feature, 0) + 0.5
        odds = math.log((t / (n_toxic + 1)) / (c / (n_clean + 1)))
        bound = odds - CONFIDENCE * math.sqrt(1 / t + 1 / c)
        if bound >= LEAST_WEIGHT:
            weights[feature] = bound
    return weights, START


class Scorer:
    def __init__(self, letters, weights: dict[str, float], start: float):
        self.model, self.weights, self.start = Letters(*letters), weights, start
        self.cache: dict[str, list[tuple[str, float]]] = {}

    def words(self, raw: str) -> list[tuple[str, float]]:
        """Restored words that have a weight."""
        found = self.cache.get(raw)
        if found is None:
            found = []
            for restored in restored_words(raw, self.model):
                weight = max((self.weights[f] for f in features(restored) if f in self.weights), default=0.0)
                if weight:
                    found.append((restored, weight))
            if len(raw) <= REMEMBERED_CHARS:
                if len(self.cache) >= REMEMBERED_WORDS:
                    self.cache.clear()
                self.cache[raw] = found
        return found

    def score(self, text: str) -> tuple[float, list[str]]:
        """Probability-like score, and the restored words that speak for it."""
        own: dict[str, float] = {}
        for raw in raw_words(text):
            own.update(self.words(raw))
        odds = self.start + sum(own.values())
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, odds)))), sorted(own)


def toxicity(docs: DataFrame, labelled: DataFrame, text: str = "text", keep: list[str] | None = None, key: str = "doc_id", fit_rows: int = FIT_ROWS, out: tuple[str, str] = ("toxic_score", "toxic_words")) -> DataFrame:
    """Columns `keep` (all by default) with toxic_score (0 to 1) and toxic_words (restored words that speak for it).

    `labelled` (`key`, toxic) is what weights are learned from: at most about `fit_rows` rows of each class, chosen by a hash
    of the key, joined to the documents' texts. The character model covers all documents. Null and empty texts get the score
    of a text without any such word; so does every text when one class has no labelled document. Rows without a label, and
    null labels or keys, teach nothing. Repeated rows each give a row. `out` names the two columns; input
    columns with these names are replaced.
    """
    spark = session(docs.sparkSession)
    texts = docs.select(F.coalesce(F.col(f"`{text}`"), F.lit("")).alias(TEXT))
    letters = spark.sparkContext.broadcast(learn_letters(texts))

    own = labelled.filter(f"toxic IS NOT NULL AND `{key}` IS NOT NULL").select(F.col(f"`{key}`").alias("__key"), (F.col("toxic") == 1).alias("__toxic"))

    def sample(rows: DataFrame) -> DataFrame:
        """At most `fit_rows` labels: small enough to broadcast by that bound, so that texts are not shuffled."""
        chosen = rows.orderBy(F.xxhash64("__key", F.lit(3)), "__key").limit(fit_rows)
        found = docs.select(F.col(f"`{key}`").alias("__key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias(TEXT))
        return apart(found.join(F.broadcast(chosen.select("__key").distinct()), "__key", "left_semi").select(TEXT))

    tables = Scratch(spark, "toxicity")
    toxic, clean = tables.write(sample(own.filter("__toxic")), "toxic"), tables.write(sample(own.filter("NOT __toxic")), "clean")
    weights, start = learn_weights(toxic, clean, letters)
    tables.drop("toxic", "clean")
    learned = spark.sparkContext.broadcast((weights, start))

    def make():
        scorer = Scorer(letters.value, *learned.value)

        def work(batch):
            found = [scorer.score(t) for t in batch]
            return [[s for s, _ in found], [w for _, w in found]]

        return work

    return map_texts(docs, text, docs.columns if keep is None else keep, [(out[0], T.DoubleType()), (out[1], T.ArrayType(T.StringType()))], make)
