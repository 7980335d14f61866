"""Secrets in whole texts: fixed patterns, and tokens that a battery of randomness tests takes for random.

A token is tested under the encoding inferred from its characters. Three tests ask whether it may be random: chi-squared
uniformity over the alphabet, runs above and below the alphabet's middle, serial correlation of neighbours. Against ordinary
text stands the likelihood ratio of two models over all neighbours of the token: the alphabet's uniform one, and that of
ordinary words, counted over the short words of all documents (changes of character class; letters after letters, whatever
their case). If a token were ordinary, a ratio of r or more would have a probability of 1/r at most, whatever length and
encoding: that bound, divided by the least p-value of the battery (times three), is the token's p-value. The p-values of
all tokens of the corpus go through the step-up procedure that controls the rate of false discoveries.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import TEXT, Scratch, map_texts, session

# Kinds in order, patterns and least lengths of the base.
KINDS = ["assign", "access", "hex", "random"]
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_LEAST, ACCESS_LEAST = 8, 16

# A match of ASSIGN holds one of these in lower case.
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

# A run ends at '=', except for '=' at its end: padding.
RUN = re.compile(r"[A-Za-z0-9+/_-]{20,}(?:=+(?![A-Za-z0-9+/_=-]))?")
LEAST_TOKEN = 20
# Characters of the alphabets: maximal parts of a run within one of them are tokens too.
PARTS = [re.compile(rf"[{c}]{{20,}}") for c in ("A-Za-z0-9+/", "A-Za-z0-9+", "A-Za-z0-9_-", "A-Za-z0-9_", "A-Za-z0-9-", "A-Za-z0-9", "a-z0-9", "A-Z0-9")]
SIGNS = str.maketrans("", "", "-_")
CLEAR = 0.001
# A test of the battery rejects below this p-value; false discoveries are held to this rate; changes of character class
# between neighbours of an ordinary token, whatever the corpus shows in half of the weight; share of letters that any letter
# may follow; counts that a class or letter starts from.
REJECT, RATE, ORDINARY_CHANGES, ANY_LETTER, BEFORE = 0.001, 0.01, 0.2, 0.1, 20.0
SHORT_RUN = re.compile(r"[A-Za-z0-9]+")
# p-values are counted in tenths of their decimal logarithm, from 10^0 to 10^-40 and less.
STEPS, LAST_STEP = 10, 400

LOWER, UPPER, DIGIT = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"


def normal_tail(z: float) -> float:
    """Two-sided."""
    return math.erfc(abs(z) / math.sqrt(2))


def encoding(token: str) -> str | None:
    """The smallest alphabet of an encoding that fits and shows itself: hexadecimal, base 32, 36 or 64."""
    has = set(token)
    digits, lower, upper = has & set(DIGIT), has & set(LOWER), has & set(UPPER)
    if not digits or not (lower or upper):
        return None
    if has <= set(DIGIT + "abcdef"):
        return DIGIT + "abcdef"
    if has <= set(DIGIT + "ABCDEF"):
        return DIGIT + "ABCDEF"
    if has <= set(UPPER + "234567"):
        return UPPER + "234567"
    if has <= set(DIGIT + LOWER):
        return DIGIT + LOWER
    if has <= set(DIGIT + UPPER):
        return DIGIT + UPPER
    if lower and upper:
        for alphabet in (UPPER + LOWER + DIGIT + "+/", UPPER + LOWER + DIGIT + "-_"):
            if has <= set(alphabet):
                return alphabet
    return None


def battery(values: list[int], size: int) -> list[float]:
    """p-values of uniformity, runs and serial correlation for a sequence of places in an alphabet of `size`."""
    n = len(values)
    # Uniformity over classes of neighbouring places, few enough that five are expected in each.
    classes = max(2, min(size, n // 5))
    counts = Counter(v * classes // size for v in values)
    expected = [sum(1 for v in range(size) if v * classes // size == c) * n / size for c in range(classes)]
    chi = sum((counts[c] - e) ** 2 / e for c, e in enumerate(expected))
    d = classes - 1
    # Wilson and Hilferty: the cube root of chi-squared over its degrees is nearly normal.
    z = ((chi / d) ** (1 / 3) - (1 - 2 / (9 * d))) / math.sqrt(2 / (9 * d))
    uniform = 0.5 * math.erfc(z / math.sqrt(2))
    high = [2 * v >= size for v in values]
    a, b = sum(high), n - sum(high)
    if not a or not b:
        return [uniform, 0.0, 0.0]
    runs = 1 + sum(x != y for x, y in zip(high, high[1:]))
    mean = 1 + 2 * a * b / n
    spread = math.sqrt(max(1e-12, (mean - 1) * (mean - 2) / (n - 1)))
    middle = sum(values) / n
    variance = sum((v - middle) ** 2 for v in values)
    serial = sum((x - middle) * (y - middle) for x, y in zip(values, values[1:])) / variance if variance else 1.0
    return [uniform, normal_tail((runs - mean) / spread), normal_tail((serial + 1 / n) * math.sqrt(n))]


def character_class(c: str) -> int | None:
    return 0 if c in DIGIT else 1 if c in LOWER else 2 if c in UPPER else None


class Ordinary:
    """Log probability of a letter or digit after another one in ordinary text, from counts of pairs in short words."""

    def __init__(self, pairs: dict[str, int] | None = None):
        classes, letters = np.zeros((3, 3)), np.zeros((26, 26))
        for (x, y), n in (pairs or {}).items():
            a, b = character_class(x), character_class(y)
            classes[a, b] += n
            if a and b:
                letters[LOWER.index(x.lower()), LOWER.index(y.lower())] += n
        fixed = np.full((3, 3), ORDINARY_CHANGES / 2)
        np.fill_diagonal(fixed, 1 - ORDINARY_CHANGES)
        change = fixed / 2 + (classes + BEFORE * fixed) / (classes.sum(1, keepdims=True) + BEFORE) / 2
        # Letters seen at all, for those before which little was seen.
        single = (letters.sum(0) + BEFORE / 26) / (letters.sum() + BEFORE)
        after = (letters + BEFORE * single) / (letters.sum(1, keepdims=True) + BEFORE)
        after, single = (1 - ANY_LETTER) * after + ANY_LETTER / 26, (1 - ANY_LETTER) * single + ANY_LETTER / 26
        self.log: dict[str, float] = {}
        for x in DIGIT + LOWER + UPPER:
            for y in DIGIT + LOWER + UPPER:
                a, b = character_class(x), character_class(y)
                which = 0.1 if not b else after[LOWER.index(x.lower()), LOWER.index(y.lower())] if a else single[LOWER.index(y.lower())]
                self.log[x + y] = math.log(change[a, b] * which)


PLAIN = Ordinary()


def pair_counts(texts: DataFrame) -> DataFrame:
    """(pair, n): neighbours within the short words of column __text; 62 x 62 rows at most."""

    def run(batches):
        pairs: Counter = Counter()
        words: Counter = Counter()

        def settle():
            for word, n in words.items():
                for part in SHORT_RUN.findall(word):
                    for pair in map("".join, zip(part, part[1:])):
                        pairs[pair] += n
            words.clear()

        for batch in batches:
            for text in batch.column(0).to_pylist():
                words.update(w for w in text.split() if len(w) < LEAST_TOKEN)
                if len(words) > 200_000:
                    settle()
        settle()
        yield pa.RecordBatch.from_arrays([pa.array(list(pairs), pa.string()), pa.array(list(pairs.values()), pa.int64())], names=["pair", "n"])

    return texts.mapInArrow(run, "pair string, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def randomness(token: str, ordinary: Ordinary = PLAIN) -> float | None:
    """p-value of being ordinary: 1 if a test of the battery rejects randomness; None for a token without an encoding."""
    token = token.rstrip("=")
    if not (any(c in LOWER for c in token) and any(c in UPPER for c in token)):
        # A key of one case in groups: no alphabet of its kind has signs.
        token = token.translate(SIGNS)
    alphabet = encoding(token) if len(token) >= LEAST_TOKEN else None
    if alphabet is None:
        return None
    place = {c: i for i, c in enumerate(alphabet)}
    random = min(battery([place[c] for c in token], len(alphabet))) * 3
    if random < REJECT:
        return 1.0
    # Signs part words in ordinary tokens: only neighbours that are letters or digits count.
    uniform = -math.log(len(alphabet))
    ratio = sum(uniform - ordinary.log[pair] for x, y in zip(token, token[1:]) if (pair := x + y) in ordinary.log)
    return max(min(1.0, math.exp(-ratio) / min(1.0, random)), 1e-300)


def random_tokens(run: str, ordinary: Ordinary = PLAIN) -> list[tuple[int, int, float]]:
    """(start, end, p) of tokens of a run that may be random, without overlaps: of the run and its parts the longest with p <= CLEAR,
    else that of least p. A p-value is multiplied by the number of tokens tried, as one of them is picked.
    """
    body = len(run.rstrip("="))
    tried = {(0, body)} | {m.span() for part in PARTS for m in part.finditer(run, 0, body)}
    found = [(max(p, CLEAR), s - e, p, s, e) for s, e in tried if (p := randomness(run[s:e], ordinary)) is not None]
    chosen: list[tuple[int, int, float]] = []
    for _, _, p, s, e in sorted(found):
        end = len(run) if e == body else e
        if not any(a < end and s < b for a, b, _ in chosen):
            chosen.append((s, end, min(1.0, p * len(tried))))
    return chosen


def find(text: str, ordinary: Ordinary = PLAIN) -> list[tuple[str, int, int, float | None]]:
    """(kind, start, end, p) by start, then kind; positions are code points, p is that of random tokens."""
    spans: list[tuple[int, int, int, float | None]] = []
    data = text.encode()
    lowered = data.lower()
    if any(k in lowered for k in KEYWORDS):
        spans += [(m.start(), 0, m.end(), None) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if b"AKIA" in data:
        spans += [(m.start(), 1, m.end(), None) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    spans += [(m.start(), 2, m.end(), None) for m in HEX.finditer(text)]
    if any(len(w) >= LEAST_TOKEN and not w.isalpha() for w in text.split()):
        base = sorted((s, e) for s, _, e, _ in spans)
        at = 0
        for m in RUN.finditer(text):
            # What a pattern's match leaves of a run is tested by itself.
            begin = m.start()
            while at < len(base) and base[at][0] < m.end():
                if base[at][1] > begin:
                    spans += [(begin + s, 3, begin + e, p) for s, e, p in random_tokens(text[begin : max(begin, base[at][0])], ordinary)]
                    begin = base[at][1]
                if base[at][1] >= m.end():
                    break  # it may reach into the next run
                at += 1
            if begin < m.end():
                spans += [(begin + s, 3, begin + e, p) for s, e, p in random_tokens(text[begin : m.end()], ordinary)]
    return [(KINDS[k], s, e, p) for s, k, e, p in sorted(spans, key=lambda x: x[:3])]


def step(p: Column) -> Column:
    return F.least(F.floor(-F.log10(p) * STEPS), F.lit(LAST_STEP))


def discovery_step(candidates: DataFrame, rate: float = RATE) -> int:
    """The first step whose tokens are discoveries: 10^-(step/10) <= rate * (tokens from this step on) / (all tokens)."""
    counts = {r["at"]: r["n"] for r in candidates.groupBy(step(F.col("p")).alias("at")).agg(F.count(F.lit(1)).alias("n")).collect()}
    total, beyond, found = sum(counts.values()), 0, LAST_STEP + 1
    for at in sorted(counts, reverse=True):
        beyond += counts[at]
        if 10 ** (-at / STEPS) <= rate * beyond / total:
            found = at
    return found


SPANS = T.ArrayType(
    T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("p", T.DoubleType())])
)


def secret_spans(docs: DataFrame, text: str = "text", keep: list[str] | None = None, rate: float = RATE) -> DataFrame:
    """Columns `keep` (all by default) and `spans`: array of (kind, start, end, p) by start, then kind.

    Kinds are assign, access and hex by pattern, and random by test; p is the p-value of random tokens, else null. What a
    pattern matches is left to it, the rest of a run of characters before and after it is tested. Positions are code points of the whole text, the end exclusive.
    A null or empty text has no spans; repeated rows each give a row and each count as tests; an input column `spans` is
    replaced; an empty table gives no rows.
    """
    spark = session(docs.sparkSession)

    counts = pair_counts(docs.select(F.coalesce(F.col(f"`{text}`"), F.lit("")).alias(TEXT))).collect()
    pairs = spark.sparkContext.broadcast({r["pair"]: r["n"] for r in counts})

    def make():
        ordinary = Ordinary(pairs.value)
        return lambda texts: [[[{"kind": k, "start": s, "end": e, "p": p} for k, s, e, p in find(t, ordinary)] for t in texts]]

    found = Scratch(spark, "secrets").write(map_texts(docs, text, docs.columns if keep is None else keep, [("spans", SPANS)], make), "spans")
    tested = found.select(F.explode("spans").alias("s")).filter("s.kind = 'random'").select("s.p")
    first = discovery_step(tested, rate)
    return found.withColumn("spans", F.filter("spans", lambda s: s["p"].isNull() | (step(s["p"]) >= first)))


def listed(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))
