"""Baseline profiles and the constraints suggested by them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

FRACTIONAL, INTEGRAL, TEXT = "Fractional", "Integral", "String"

_KINDS = {
    "double": FRACTIONAL, "float": FRACTIONAL, "int": INTEGRAL, "bigint": INTEGRAL, "smallint": INTEGRAL, "tinyint": INTEGRAL,
}


def inferred_type(spark_type: str) -> str:
    return FRACTIONAL if spark_type.startswith("decimal") else _KINDS.get(spark_type, TEXT)


def long_form(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, value) pairs of numeric columns."""
    pairs = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in features]
    return df.select(F.explode(F.array(*pairs)).alias("p")).select("p.*")


def long_text(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, category) pairs of text columns; NULL is its own category."""
    pairs = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("category")) for c in features]
    return df.select(F.explode(F.array(*pairs)).alias("p")).select("p.*")


def profile(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """One row per feature: type, counts, completeness, mean, deviation, range, distinct values.

    Numeric statistics of all features come from one pass without exploding the rows.
    """
    kinds = {c: inferred_type(t) for c, t in df.dtypes if c in features}

    def stats(i: int, c: str) -> list[Column]:
        value = F.col(c).cast("double") if kinds[c] != TEXT else F.lit(None).cast("double")
        return [
            F.count(c).alias(f"n{i}"), F.avg(value).alias(f"m{i}"), F.stddev_samp(value).alias(f"s{i}"),
            F.min(value).alias(f"lo{i}"), F.max(value).alias(f"hi{i}"),
        ]

    single = df.agg(F.count(F.lit(1)).alias("n"), *[a for i, c in enumerate(features) for a in stats(i, c)])
    rows = [
        F.struct(
            F.lit(c).alias("feature"), F.lit(kinds[c]).alias("inferred_type"), F.col("n").alias("row_count"),
            F.col(f"n{i}").alias("num_present"), F.try_divide(f"n{i}", "n").alias("completeness"),
            F.col(f"m{i}").alias("mean"), F.col(f"s{i}").alias("std_dev"), F.col(f"lo{i}").alias("min"), F.col(f"hi{i}").alias("max"),
        )
        for i, c in enumerate(features)
    ]
    return single.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def split_kinds(df: DataFrame, features: Sequence[str]) -> tuple[list[str], list[str]]:
    """(numeric, text) columns among `features` that the frame has."""
    kinds = {c: inferred_type(t) for c, t in df.dtypes}
    there = [c for c in features if c in kinds]
    return [c for c in there if kinds[c] != TEXT], [c for c in there if kinds[c] == TEXT]


def value_counts(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, value, n) of numeric columns without NULL; the counting is combined before the shuffle."""
    if not features:
        return df.sparkSession.createDataFrame([], "feature string, value double, n long")
    return long_form(df, features).where(F.col("value").isNotNull()).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))


# Size of a quantile sketch: its memory and error depend on this number, not on the rows.
SKETCH_K = 4096


def value_sketches(df: DataFrame, features: Sequence[str], k: int = SKETCH_K) -> DataFrame:
    """(feature, sketch, n) of numeric columns: a quantile sketch per feature, merged over tasks; NULL and NaN are left out."""
    if not features:
        return df.sparkSession.createDataFrame([], "feature string, sketch binary, n long")
    rows = long_form(df, features).where(F.col("value").isNotNull() & ~F.isnan("value"))
    return rows.groupBy("feature").agg(F.kll_sketch_agg_double("value", k).alias("sketch"), F.count(F.lit(1)).alias("n"))


def category_counts(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, category, n) of text columns; NULL is a category."""
    if not features:
        return df.sparkSession.createDataFrame([], "feature string, category string, n long")
    return long_text(df, features).groupBy("feature", "category").agg(F.count(F.lit(1)).alias("n"))


def categories(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Count and share of each category; the counting is combined before the shuffle."""
    counts = long_text(df, features).groupBy("feature", "category").agg(F.count(F.lit(1)).alias("count"))
    totals = counts.groupBy("feature").agg(F.sum("count").alias("total"))
    return counts.join(totals, "feature").select("feature", "category", "count", (F.col("count") / F.col("total")).alias("share"))


def histogram(df: DataFrame, profiled: DataFrame, features: Sequence[str], bins: int = 10) -> DataFrame:
    """Rows per equal-width bin between the profile's minimum and maximum; outside values go to the end bins.

    The profile should be a stored one; it has one row per feature, so the planner sees its size. The edges stay with the
    rows up to the result.
    """
    edges = profiled.where(F.col("feature").isin(list(features))).select("feature", "min", "max")
    placed = long_form(df, features).where(F.col("value").isNotNull()).join(edges, "feature")
    width = F.col("max") - F.col("min")
    raw_bin = F.when(width > 0, F.floor((F.col("value") - F.col("min")) / width * bins)).otherwise(F.lit(0))
    bin_no = F.least(F.greatest(raw_bin, F.lit(0)), F.lit(bins - 1)).cast("int")
    return placed.groupBy("feature", "min", "max", bin_no.alias("bin")).agg(F.count(F.lit(1)).alias("count")).select(
        "feature", "bin", (F.col("min") + width * F.col("bin") / bins).alias("lower"),
        (F.col("min") + width * (F.col("bin") + 1) / bins).alias("upper"), "count",
    )


def suggest_constraints(profiled: DataFrame, min_completeness: float = 0.95) -> DataFrame:
    """Limits for live data: a feature complete in the baseline may miss up to 1 - `min_completeness`, another no more than it did.

    A feature that the baseline never saw has to be there from now on. Fractional features get limits for mean and
    deviation, whole numbers and text do not.
    """
    fractional = F.col("inferred_type") == FRACTIONAL
    seen = F.coalesce(F.col("completeness"), F.lit(0.0))
    return profiled.select(
        "feature", "inferred_type",
        F.when(seen == 0, F.lit(min_completeness)).otherwise(F.least(seen, F.lit(min_completeness))).alias("min_completeness"),
        F.when(F.col("min") >= 0, True).otherwise(False).alias("non_negative"),
        F.when(fractional, F.col("mean")).alias("mean"), F.when(fractional, F.col("std_dev")).alias("std_dev"),
    )


def baseline_vs_live(baseline: DataFrame, live: DataFrame) -> DataFrame:
    """Means and counts of both profiles side by side; a feature that one side lacks has NULL there."""
    left = baseline.select("feature", F.col("mean").alias("base_mean"), F.col("num_present").alias("base_present"))
    right = live.select("feature", F.col("mean").alias("live_mean"), F.col("num_present").alias("live_present"))
    return left.join(right, "feature", "full")


def schema_changes(baseline: DataFrame, live: DataFrame) -> DataFrame:
    """Features that appeared, vanished or changed their type, from two profiles."""
    old = baseline.select("feature", F.col("inferred_type").alias("old_type"))
    new = live.select("feature", F.col("inferred_type").alias("new_type"))
    change = (
        F.when(F.col("old_type").isNull(), "added").when(F.col("new_type").isNull(), "removed")
        .when(F.col("old_type") != F.col("new_type"), "changed")
    )
    return old.join(new, "feature", "full").withColumn("change", change).where(F.col("change").isNotNull())
