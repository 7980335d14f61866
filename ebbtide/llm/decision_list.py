"""Quality rules: a learned decision list over statistics of whole texts, as ordered Spark conditions.

Sequential covering: a rule is a conjunction of thresholds, grown one condition at a time on two thirds of the labelled rows
and cut back on the other third; rows that it covers are set aside, and the next rule is learned from the rest. All counting
is one aggregate per step over the stored statistics; the driver sees a few counts per statistic and bin. Only DataFrame
functions are used.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, Scratch, session

# Characters that count as symbols; least words; most percent of words in repeated windows.
SYMBOLS, LEAST_WORDS, MOST_REPEAT_PERCENT = "#*$%&|<>", 50, 50

# Labelled rows that rules are learned from at most, chosen by a hash of their key.
FIT_ROWS = 200_000
BINS, MOST_RULES, MOST_CONDITIONS, LEAST_SUPPORT, LEAST_PRECISION = 24, 12, 4, 8, 0.9

STATISTICS = ["n_words", "mean_word", "symbol_share", "dup_line_share", "repeat_share", "distinct_share", "upper_share", "mark_share"]


def base_statistics(text: Column) -> dict[str, Column]:
    """Steps of columns, each built on those before; a null text has no words."""
    spaces = "[\\x20\\x09-\\x0D]+"
    return {
        "_text": F.coalesce(text, F.lit("")),
        "_trimmed": F.btrim("_text", F.lit(SPACES)),
        "_words": F.when(F.col("_trimmed") == "", F.array().cast("array<string>")).otherwise(F.split("_trimmed", spaces)),
        "_lines": F.filter(F.split("_text", "\n", -1), lambda line: F.btrim(line, F.lit(SPACES)) != ""),
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.char_length(F.translate("_text", SPACES, "")).cast("long"),
        "n_symbols": (F.char_length("_text") - F.char_length(F.translate("_text", SYMBOLS, ""))).cast("long"),
        "_n_lines": F.size("_lines"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "_n_distinct": F.size(F.array_distinct("_words")),
        "_n_upper": F.regexp_count("_text", F.lit("\\p{Lu}")),
        "_n_marks": F.char_length("_text") - F.char_length(F.translate("_text", "!?=_-+@", "")),
        # Windows of three words with their place, in an order that puts equal ones side by side (a hash first, for speed;
        # equality is that of the words).
        "_windows": F.when(
            F.col("n_words") >= 3,
            F.sort_array(
                F.transform(
                    F.slice(F.arrays_zip(F.col("_words").alias("a"), F.slice("_words", 2, F.greatest(F.size("_words"), F.lit(1))).alias("b"), F.slice("_words", 3, F.greatest(F.size("_words"), F.lit(1))).alias("c")), 1, F.greatest(F.size("_words") - 2, F.lit(1))),
                    lambda w, i: F.struct(F.xxhash64(w["a"], w["b"], w["c"]).alias("h"), w["a"].alias("a"), w["b"].alias("b"), w["c"].alias("c"), i.alias("i")),
                )
            ),
        ).otherwise(F.array().cast("array<struct<h:bigint,a:string,b:string,c:string,i:int>>")),
        # Places whose window equals the one before or behind it, in order of place.
        "_equal_next": F.zip_with(
            "_windows",
            F.slice("_windows", 2, F.greatest(F.size("_windows"), F.lit(1))),
            lambda x, y: F.coalesce((x["h"] == y["h"]) & (x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"]), F.lit(False)),
        ),
        "_repeated": F.sort_array(
            F.filter(
                F.zip_with(
                    "_windows",
                    F.zip_with("_equal_next", F.concat(F.array(F.lit(False)), "_equal_next"), lambda a, b: a | b),
                    lambda w, again: F.when(again, w["i"]),
                ),
                lambda i: i.isNotNull(),
            )
        ),
        # Words covered by windows at these places: up to three each, less where the next one begins earlier.
        "n_repeat_words": F.aggregate(
            F.zip_with("_repeated", F.slice("_repeated", 2, F.greatest(F.size("_repeated"), F.lit(1))), lambda i, j: F.coalesce(F.least(j - i, F.lit(3)), F.lit(3))),
            F.lit(0),
            lambda a, b: a + b,
        ).cast("long"),
        "base_failed": (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEAT_PERCENT * F.col("n_words")),
        "mean_word": F.col("word_chars") / F.greatest("n_words", F.lit(1)),
        "symbol_share": F.col("n_symbols") / F.greatest("n_words", F.lit(1)),
        "dup_line_share": F.col("n_dup_lines") / F.greatest("_n_lines", F.lit(1)),
        "repeat_share": F.col("n_repeat_words") / F.greatest("n_words", F.lit(1)),
        "distinct_share": F.col("_n_distinct") / F.greatest("n_words", F.lit(1)),
        "upper_share": F.col("_n_upper") / F.greatest("word_chars", F.lit(1)),
        "mark_share": F.col("_n_marks") / F.greatest("n_words", F.lit(1)),
    }


BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def statistics(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """`key` with the counts of BASE and the shares of STATISTICS, for every row."""
    df = docs.select(F.col(f"`{key}`").alias("__key"), F.col(f"`{text}`").alias("__raw"))
    for name, column in base_statistics(F.col("__raw")).items():
        df = df.withColumn(name, column)
    return df.select(F.col("__key").alias(key), *BASE, *[s for s in STATISTICS if s not in BASE])


@dataclass(frozen=True)
class Condition:
    statistic: str
    above: bool
    threshold: float

    def column(self) -> Column:
        c = F.col(self.statistic)
        return c >= F.lit(self.threshold) if self.above else c <= F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.statistic} {'>=' if self.above else '<='} {self.threshold!r}"


Rule = tuple[Condition, ...]


def _all(conditions) -> Column:
    held = F.lit(True)
    for c in conditions:
        held = held & c.column()
    return held


def learn(labelled: DataFrame, tables: Scratch) -> list[Rule]:
    """Rules for bad rows, in order, from STATISTICS, `bad` (boolean) and `part` (0 to 2; part 2 judges)."""
    labelled = tables.write(labelled, "labelled")
    if not labelled.filter("bad").limit(1).count():
        return []
    cuts = labelled.agg(*[F.percentile_approx(s, [i / BINS for i in range(1, BINS)], 2000).alias(s) for s in STATISTICS]).first()
    # Cuts of the bad rows alone too: they may sit in the outermost bins of all rows.
    bad_cuts = labelled.filter("bad").agg(*[F.percentile_approx(s, [i / BINS for i in range(1, BINS)], 2000).alias(s) for s in STATISTICS]).first()
    edges = {s: sorted({float(v) for v in [*cuts[s], *bad_cuts[s]]}) for s in STATISTICS}

    def place(s):
        return F.size(F.filter(F.array(*[F.lit(e) for e in edges[s]]), lambda e: F.col(s) >= e))

    binned = tables.write(labelled.select("*", *[place(s).alias(f"bin_{s}") for s in STATISTICS]), "binned")

    def best_condition(rows: DataFrame) -> Condition | None:
        """The condition with the most information gained for bad rows."""
        melted = rows.select("bad", F.explode(F.array(*[F.struct(F.lit(s).alias("s"), F.col(f"bin_{s}").alias("b")) for s in STATISTICS])).alias("m"))
        counts = melted.groupBy("m.s", "m.b").agg(F.count_if("bad").alias("bad"), F.count(F.lit(1)).alias("n")).collect()
        found = None
        for s in STATISTICS:
            own = sorted((r["b"], r["bad"], r["n"]) for r in counts if r["s"] == s)
            bad, n = sum(r[1] for r in own), sum(r[2] for r in own)
            if not bad or bad == n:
                return None
            before = math.log2(bad / n)
            for i, edge in enumerate(edges[s], 1):
                low_bad, low_n = sum(r[1] for r in own if r[0] < i), sum(r[2] for r in own if r[0] < i)
                for above, p, m in ((True, bad - low_bad, n - low_n), (False, low_bad, low_n)):
                    if p >= LEAST_SUPPORT and m < n:
                        gain = p * (math.log2(p / m) - before)
                        if found is None or gain > found[0] + 1e-9:
                            found = gain, s, above, edge
        if found is None or found[0] <= 0:
            return None
        # The threshold is moved up to the nearest bad row, so that rows beyond all bad ones are not judged by it.
        _, s, above, edge = found
        side = F.col(s) >= edge if above else F.col(s) < edge
        nearest = rows.filter(F.col("bad") & side).agg((F.min if above else F.max)(s)).first()[0]
        return Condition(s, above, float(nearest))

    rules: list[Rule] = []
    rest = binned
    for _ in range(MOST_RULES):
        grown: list[Condition] = []
        rows = rest.filter("part < 2")
        while len(grown) < MOST_CONDITIONS:
            found = best_condition(rows)
            if found is None:
                break
            grown.append(found)
            rows = rows.filter(found.column())
        if not grown:
            break
        # The shortest beginning of the conjunction that judges unseen rows best.
        judged = rest.filter("part = 2").agg(*[
            f(_all(grown[:k]) & b).alias(f"{name}{k}") for k in range(1, len(grown) + 1) for name, f, b in (("bad", F.count_if, F.col("bad")), ("good", F.count_if, ~F.col("bad")))
        ]).first()
        values = [((judged[f"bad{k}"] - judged[f"good{k}"]) / max(1, judged[f"bad{k}"] + judged[f"good{k}"]), k) for k in range(1, len(grown) + 1)]
        worth, k = max(values, key=lambda v: (round(v[0], 6), -v[1]))
        support = judged[f"bad{k}"] + judged[f"good{k}"]
        if support == 0 or judged[f"bad{k}"] / support < LEAST_PRECISION:
            break
        rules.append(tuple(grown[:k]))
        rest = rest.filter(~_all(grown[:k]))
    return rules


def verdict(rules: list[Rule]) -> Column:
    """The decision list as one ordered condition: the first rule that holds rejects, else the row is kept."""
    listed = F.when(F.col("base_failed"), False)
    for rule in rules:
        listed = listed.when(_all(rule), False)
    return listed.otherwise(True)


def quality(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", fit_rows: int = FIT_ROWS) -> DataFrame:
    """One row per input row: `key`, the columns of BASE and STATISTICS, and kept.

    `labels` holds `key` and quality (0 is bad). Rules are learned from at most about `fit_rows` labelled rows, chosen by a
    hash of the key; counts and verdicts cover every row and whole texts. A null text has no words and fails; rows without a
    label, and null labels, teach nothing; without labels only the base decides. Repeated rows each give a row; an empty
    table gives none. Other columns are not read.
    """
    spark = session(docs.sparkSession)
    tables = Scratch(spark, "quality")
    stats = tables.write(statistics(docs, text, key), "statistics")
    own = labels.filter(F.col("quality").isNotNull()).select(F.col(f"`{key}`").alias("__k"), (F.col("quality") == 0).alias("bad"))
    share = min(1.0, fit_rows / max(1, own.count()))
    own = own.filter(F.pmod(F.xxhash64("__k", F.lit(7)), F.lit(1 << 20)) < int(share * (1 << 20)) + (share >= 1.0))
    joined = stats.join(own, F.col(f"`{key}`") == F.col("__k"))
    labelled = joined.filter("NOT base_failed").select("bad", F.pmod(F.xxhash64("__k", F.lit(11)), F.lit(3)).alias("part"), *[F.col(s).cast("double").alias(s) for s in STATISTICS])
    return stats.withColumn("kept", verdict(learn(labelled, tables)))
