"""Language identification as a mixture: each document's language proportions by expectation-maximisation.

Per learned language there is a table of n-gram frequencies (hashed into a fixed number of buckets, so its size is bounded
by the number of languages). A word's likelihood in a language is the product over its n-grams. A document's words come from
a mixture of languages; expectation-maximisation estimates the proportions, and the set of languages is the one of highest
likelihood less a penalty per language. Documents of a batch are estimated side by side.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import TEXT, map_texts, session

BUCKETS, GRAMS = 1 << 16, (2, 3, 4)
SMOOTHING = 0.5
ROUNDS, SHARE, PENALTY = 12, 0.01, 3.0
# Words that a process remembers: their likelihoods take so many bytes at most.
REMEMBERED_BYTES = 32 << 20
MOST_LANGUAGES = 1024
# Letters of any script; number signs are none.
WORD = regex.compile(r"\p{L}+")
UNKNOWN = "und"


def grams(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per length of n-grams: buckets of the byte n-grams of all words with their borders, and the words they are of."""
    data = np.frombuffer(f"<{'><'.join(words)}>".encode(), np.uint8).astype(np.uint32)
    starts = np.flatnonzero(data == ord("<"))
    word = np.repeat(np.arange(len(words)), np.diff(np.append(starts, len(data))))
    rolled = data
    for size in range(2, GRAMS[-1] + 1):
        rolled = (rolled[:-1] * np.uint32(0x01000193)) ^ data[size - 1 :]
        if size in GRAMS:
            whole = word[: len(rolled)] == word[size - 1 :]
            mixed = (rolled[whole] ^ (rolled[whole] >> np.uint32(15))) * np.uint32(0x85EBCA6B)
            yield (mixed ^ (mixed >> np.uint32(13))) % np.uint32(BUCKETS), word[: len(rolled)][whole]


def held_out(key: Column, folds: int, remainder: int) -> Column:
    """Whether crc32 of the key as text leaves the remainder; a null key counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % folds == remainder


def gram_counts(labelled: DataFrame) -> DataFrame:
    """(lang, bucket, n) over all rows of (lang, __text); each task sums its own rows first."""

    def run(batches):
        sums: dict[str, np.ndarray] = {}
        words: dict[str, Counter] = {}

        def settle(lang):
            own = sums.setdefault(lang, np.zeros(BUCKETS, np.int64))
            counted = words.pop(lang)
            times = np.fromiter(counted.values(), np.int64, len(counted))
            for bucket, word in grams(list(counted)) if counted else ():
                own += np.bincount(bucket, weights=times[word], minlength=BUCKETS).astype(np.int64)

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = words.setdefault(lang, Counter())
                own.update(WORD.findall(text.lower()))
                if len(own) > 100_000:
                    settle(lang)
        for lang in list(words):
            settle(lang)
        for lang, own in sums.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(own[at], pa.int64())], names=["lang", "bucket", "n"])

    counted = labelled.mapInArrow(run, "lang string, bucket int, n long")
    return counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def fit(labelled: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages in order, and log frequencies (buckets x languages): at most BUCKETS x MOST_LANGUAGES numbers."""
    rows = gram_counts(labelled).toPandas()
    languages = sorted(rows["lang"].unique())
    if len(languages) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    counts = np.zeros((BUCKETS, max(1, len(languages))), np.float64)
    place = {lang: i for i, lang in enumerate(languages)}
    counts[rows["bucket"].to_numpy(dtype=np.int64), rows["lang"].map(place).to_numpy(dtype=np.int64)] = rows["n"]
    return languages, np.log((counts + SMOOTHING) / (counts.sum(axis=0) + SMOOTHING * BUCKETS)).astype(np.float32)


class Mixture:
    def __init__(self, languages: list[str], table: np.ndarray):
        self.languages, self.table = languages, table
        self.most = max(1000, REMEMBERED_BYTES // (4 * len(languages)))
        self.place: dict[str, int] = {}
        self.known = np.empty((self.most, len(languages)), np.float32)

    def likelihoods(self, words: list[str]) -> np.ndarray:
        if len(self.place) + len(words) > self.most:
            self.place.clear()
        if len(words) > self.most:
            return self._of(words).astype(np.float64)
        first = len(self.place)
        place = self.place
        at = [place.setdefault(word, len(place)) for word in words]
        if len(place) > first:
            self.known[first : len(place)] = self._of(list(islice(reversed(place), len(place) - first))[::-1])
        return self.known[at].astype(np.float64)

    def _of(self, words: list[str]) -> np.ndarray:
        """Log likelihood of each word in each language: the sum over its n-grams."""
        total = np.zeros((len(words), len(self.languages)), np.float32)
        for bucket, word in grams(words):
            if len(word):
                first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
                total[word[first]] += np.add.reduceat(self.table[bucket], first, axis=0)
        return total

    def estimate(self, texts: list[str]) -> list[list[tuple[str, float]]]:
        """Languages with proportions, largest first, of each text; none where a text has no letter."""
        found: list[list[tuple[str, float]]] = [[] for _ in texts]
        counters = [Counter(WORD.findall(t.lower())) for t in texts]
        docs = [i for i, c in enumerate(counters) if c]
        if not docs or not self.languages:
            return found
        part, size = [], 0
        for i in docs:
            part.append(i)
            size += len(counters[i])
            if size > 200_000:
                self._estimate(part, counters, found)
                part, size = [], 0
        if part:
            self._estimate(part, counters, found)
        return found

    def _estimate(self, docs: list[int], counters: list[Counter], found: list) -> None:
        sizes = np.array([len(counters[i]) for i in docs])
        likely = self.likelihoods([w for i in docs for w in counters[i]])
        weight = np.array([n for i in docs for n in counters[i].values()], np.float64)
        starts = np.r_[0, np.cumsum(sizes)[:-1]]
        total = np.add.reduceat(weight, starts)
        top = likely.max(axis=1, keepdims=True)
        ratio = np.exp(likely - top)
        base = np.add.reduceat(weight * top[:, 0], starts)

        def maximise(which: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Proportions and log likelihood of the documents `which` over the allowed languages."""
            rows = np.concatenate([np.arange(starts[d], starts[d] + sizes[d]) for d in which])
            own, first = sizes[which], np.r_[0, np.cumsum(sizes[which])[:-1]]
            of = np.repeat(np.arange(len(which)), own)
            r, w = ratio[rows], weight[rows, None]
            share = allowed / allowed.sum(axis=1, keepdims=True)
            for _ in range(ROUNDS if allowed.sum(axis=1).max() > 1 else 1):
                mixed = r * share[of]
                mixed /= np.maximum(mixed.sum(axis=1, keepdims=True), 1e-300)
                share = np.add.reduceat(mixed * w, first, axis=0) / total[which, None]
            fit = np.log(np.maximum((r * share[of]).sum(axis=1), 1e-300))
            return share, np.add.reduceat(fit * w[:, 0], first) + base[which]

        everything = np.arange(len(docs))
        share, _ = maximise(everything, np.ones((len(docs), len(self.languages))))
        rank = np.argsort(-share, axis=1, kind="stable")
        best_share = np.zeros_like(share)
        best_share[everything, rank[:, 0]] = 1.0
        single = np.add.reduceat(likely * weight[:, None], starts, axis=0)[everything, rank[:, 0]]
        best_value = single - PENALTY
        # One language more at a time, for the documents where the next one has a share worth trying.
        for k in range(2, len(self.languages) + 1):
            trying = np.flatnonzero(share[everything, rank[:, k - 1]] >= SHARE)
            if not len(trying):
                break
            allowed = np.zeros((len(trying), len(self.languages)))
            for j in range(k):
                allowed[np.arange(len(trying)), rank[trying, j]] = 1.0
            tried, value = maximise(trying, allowed)
            value = value - PENALTY * k
            better = value > best_value[trying]
            best_share[trying[better]], best_value[trying[better]] = tried[better], value[better]
        for d, i in enumerate(docs):
            order = np.argsort(-best_share[d], kind="stable")
            found[i] = [(self.languages[j], float(best_share[d, j])) for j in order if best_share[d, j] >= 1e-3]


LANGUAGES = T.ArrayType(T.StructType([T.StructField("lang", T.StringType()), T.StructField("share", T.DoubleType())]))


def identify(docs: DataFrame, labelled: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns `keep` (all by default) and `languages`: (lang, share), largest share first, adding up to about 1.

    `labelled` (lang, text) is what the languages are learned from: all its rows with neither null. A null text or one
    without a letter has no languages, and so has every text when nothing was learned. Ties go to the language that sorts
    first. Repeated rows each give a row and each count in learning. An input column `languages` is replaced.
    """
    spark = session(docs.sparkSession)
    rows = labelled.filter("lang IS NOT NULL AND text IS NOT NULL").select("lang", F.col("text").alias(TEXT))
    shared = spark.sparkContext.broadcast(fit(rows))

    def make():
        languages, table = shared.value
        mixture = Mixture(languages, table) if languages else None
        return lambda texts: [[[{"lang": a, "share": s} for a, s in found] for found in (mixture.estimate(texts) if mixture else [[]] * len(texts))]]

    return map_texts(docs, text, docs.columns if keep is None else keep, [("languages", LANGUAGES)], make)
