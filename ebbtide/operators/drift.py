"""Drift of live data against a baseline, and what to do about it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..constants import (
    CRITICAL_WEIGHT, DISTRIBUTION_WEIGHT, DRIFT_STEP, RETRAIN_SCORE, RETRAIN_VIOLATIONS,
)
from ..functions.running import running
from ..functions.special import chi_squared_p_value
from ..session import cut_lineage
from .profile import category_counts, value_counts


def constraint_violations(live: DataFrame, constraints: DataFrame, sigmas: float = 3.0) -> DataFrame:
    """Live profile against constraints, one row per broken rule."""
    c = constraints.select(
        "feature", F.col("inferred_type").alias("want_type"), "min_completeness", "non_negative",
        F.col("mean").alias("want_mean"), F.col("std_dev").alias("want_std"),
    )
    joined = live.join(c, "feature", "full")
    rules = F.array(
        F.when(F.col("row_count").isNull(), "missing_column_check"),
        F.when(F.col("want_type").isNull(), "extra_column_check"),
        F.when(F.col("inferred_type") != F.col("want_type"), "data_type_check"),
        F.when(F.col("completeness") < F.col("min_completeness"), "completeness_check"),
        F.when(F.col("non_negative") & (F.col("min") < 0), "non_negative_check"),
        F.when(F.abs(F.col("mean") - F.col("want_mean")) > sigmas * F.col("want_std"), "baseline_drift_check"),
    )
    broken = joined.select("feature", F.explode(F.filter(rules, lambda r: r.isNotNull())).alias("rule"))
    return broken.select(F.col("feature").alias("feature_name"), F.col("rule").alias("constraint_check_type"))


def _two_counts(base: DataFrame, live: DataFrame, by: Sequence[str]) -> DataFrame:
    """Counts (by, n) of both sides next to each other."""
    both = base.withColumn("_live", F.lit(0)).unionByName(live.withColumn("_live", F.lit(1)))
    return both.groupBy(*by).agg(
        F.coalesce(F.sum(F.when(F.col("_live") == 0, F.col("n"))), F.lit(0)).alias("n_base"),
        F.coalesce(F.sum(F.when(F.col("_live") == 1, F.col("n"))), F.lit(0)).alias("n_live"),
    )


def ks_p_value(distance: Column, n: Column, m: Column, terms: int = 100) -> Column:
    """Asymptotic two-sided p-value of the two-sample statistic."""
    effective = F.sqrt(n * m / (n + m))
    lam = (effective + 0.12 + 0.11 / effective) * distance
    series = F.aggregate(
        F.transform(F.sequence(F.lit(1), F.lit(terms)), lambda j: F.when(j % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * j * j * lam * lam)),
        F.lit(0.0), lambda total, term: total + term,
    )
    return F.when(lam < 0.2, F.lit(1.0)).otherwise(F.least(F.greatest(2.0 * series, F.lit(0.0)), F.lit(1.0)))


def ks_two_sample(base: DataFrame, live: DataFrame, features: Sequence[str], alpha: float = 0.05) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov distance per numeric feature, from counts of distinct values."""
    return ks_of_counts(value_counts(base, features), value_counts(live, features), alpha)


def ks_of_counts(base: DataFrame, live: DataFrame, alpha: float = 0.05) -> DataFrame:
    """The same from (feature, value, n) of both sides, such as a stored baseline's."""
    upto = running(
        _two_counts(base, live, ["feature", "value"]), ["feature"], [F.col("value")],
        {"c_base": ("sum", F.col("n_base")), "c_live": ("sum", F.col("n_live"))}, whole={"t_base": "c_base", "t_live": "c_live"},
    )
    gap = F.abs(F.col("c_base") / F.col("t_base") - F.col("c_live") / F.col("t_live"))
    both = (F.col("t_base") > 0) & (F.col("t_live") > 0)
    found = upto.where(both).groupBy("feature").agg(
        F.max(gap).alias("statistic"), F.max("t_base").alias("n_base"), F.max("t_live").alias("n_live")
    )
    p = ks_p_value(F.col("statistic"), F.col("n_base").cast("double"), F.col("n_live").cast("double"))
    return found.withColumn("p_value", p).withColumn("drifted", F.col("p_value") < alpha)


# Error of a share of values between two points of a quantile sketch of size k, at 99 %, is SCALE / k ** POWER.
SKETCH_SCALE, SKETCH_POWER = 2.446, 0.9433


def ks_of_sketches(base: DataFrame, live: DataFrame, k: int, alpha: float = 0.05, points: int = 4000) -> DataFrame:
    """The same from quantile sketches (feature, sketch, n) of size `k` of both sides, with the error of the distance.

    Each side enters by its quantiles at `points` even steps. `error` bounds how far the distance may be from the exact one:
    the sketches' own error (at 99 %) and what can happen between two quantiles. `certain` says whether the drift stands with
    the least distance that this leaves.
    """
    ranks = F.array(*[F.lit(i / points) for i in range(points + 1)])

    def quantiles(side: DataFrame) -> DataFrame:
        values = side.select("feature", F.explode(F.kll_sketch_get_quantile_double("sketch", ranks)).alias("value"))
        return values.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))

    sizes = base.select("feature", F.col("n").alias("n_base")).join(live.select("feature", F.col("n").alias("n_live")), "feature")
    found = ks_of_counts(quantiles(base), quantiles(live)).select("feature", "statistic").join(sizes, "feature")
    error = 2 * SKETCH_SCALE / k**SKETCH_POWER + 4 / points
    n, m = F.col("n_base").cast("double"), F.col("n_live").cast("double")
    p, least = ks_p_value(F.col("statistic"), n, m), ks_p_value(F.greatest(F.col("statistic") - error, F.lit(0.0)), n, m)
    return found.withColumns({"error": F.lit(error), "p_value": p, "drifted": p < alpha, "certain": least < alpha})


def chi_squared(base: DataFrame, live: DataFrame, features: Sequence[str]) -> DataFrame:
    """Chi-squared homogeneity statistic of categories between baseline and live, with degrees of freedom and p-value (NULL at 0)."""
    return chi_squared_of_counts(category_counts(base, features), category_counts(live, features))


def chi_squared_of_counts(base: DataFrame, live: DataFrame) -> DataFrame:
    """The same from (feature, category, n) of both sides."""
    counts = cut_lineage(_two_counts(base, live, ["feature", "category"]), "category-counts")
    totals = counts.groupBy("feature").agg(
        F.sum("n_base").alias("t_base"), F.sum("n_live").alias("t_live"), (F.count(F.lit(1)) - 1).alias("degrees")
    )
    row = F.col("n_base") + F.col("n_live")
    everything = F.col("t_base") + F.col("t_live")

    def term(observed: str, total: str) -> Column:
        expected = row * F.col(total) / everything
        return F.try_divide((F.col(observed) - expected) * (F.col(observed) - expected), expected)

    parts = F.coalesce(term("n_base", "t_base"), F.lit(0.0)) + F.coalesce(term("n_live", "t_live"), F.lit(0.0))
    found = counts.join(totals, "feature").groupBy("feature", "degrees").agg(F.sum(parts).alias("statistic"))
    return found.withColumn("p_value", chi_squared_p_value(F.col("statistic"), F.col("degrees")))


def distribution_violations(
    base_values: DataFrame | None, live_values: DataFrame | None, base_categories: DataFrame, live_categories: DataFrame,
    alpha: float = 0.05, share_tolerance: float = 0.20, numbers: DataFrame | None = None,
) -> DataFrame:
    """Features whose distribution has moved, one row per broken rule, from stored counts.

    Numbers by the Kolmogorov-Smirnov test, categories by the chi-squared test, and any category whose share moved by more
    than `share_tolerance` of its share in the baseline. `numbers` may give the result of another test of the numbers, such as
    that of sketches, in place of counts. A feature that one side lacks is a matter of the constraints.
    """
    tested = ks_of_counts(base_values, live_values, alpha) if numbers is None else numbers
    moved = tested.where("drifted").select("feature", F.lit("numeric_distribution_check").alias("rule"))
    tested = chi_squared_of_counts(base_categories, live_categories)
    texts = tested.where(F.col("p_value") < alpha).select("feature", F.lit("categorical_distribution_check").alias("rule"))
    counts = _two_counts(base_categories, live_categories, ["feature", "category"])
    totals = counts.groupBy("feature").agg(F.sum("n_base").alias("t_base"), F.sum("n_live").alias("t_live"))
    joined = counts.join(totals, "feature").where((F.col("t_base") > 0) & (F.col("t_live") > 0))
    base_share, live_share = F.col("n_base") / F.col("t_base"), F.col("n_live") / F.col("t_live")
    shares = joined.where(F.abs(live_share - base_share) > share_tolerance * base_share).select(
        "feature", F.lit("categorical_share_check").alias("rule")).distinct()
    return moved.unionByName(texts).unionByName(shares).select(
        F.col("feature").alias("feature_name"), F.col("rule").alias("constraint_check_type"))


def category_shift(base: DataFrame, live: DataFrame, feature: str, tolerance: float = 0.20) -> DataFrame:
    """Share of each category on both sides and whether it moved by more than `tolerance` of the baseline share."""

    def shares(df: DataFrame, name: str) -> DataFrame:
        counts = df.groupBy(F.col(feature).alias("category")).agg(F.count(F.lit(1)).alias("n"))
        return counts.select("category", (F.col("n") / counts.agg(F.sum("n")).scalar()).alias(name))

    both = shares(base, "base_share").join(shares(live, "live_share"), "category", "full").fillna(0.0, ["base_share", "live_share"])
    moved = F.abs(F.col("live_share") - F.col("base_share")) > tolerance * F.col("base_share")
    return both.withColumn("violated", moved)


def drift_score(violations: DataFrame, high_importance: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Weighted score in [0, 1], number of violations and the important features among them."""
    important = F.col("feature_name").isin(list(high_importance))
    of_distribution = F.lower("constraint_check_type").rlike("distribution|baseline")
    weight = F.when(important, CRITICAL_WEIGHT).otherwise(1.0) * F.when(of_distribution, DISTRIBUTION_WEIGHT).otherwise(1.0)
    scored = violations.groupBy(*by) if by else violations
    return scored.agg(
        F.count(F.lit(1)).alias("violation_count"),
        F.least(F.coalesce(F.sum(weight * DRIFT_STEP), F.lit(0.0)), F.lit(1.0)).alias("drift_score"),
        # At most one entry per name in `high_importance`.
        F.array_sort(F.collect_set(F.when(important, F.col("feature_name")))).alias("critical_features"),
    )


def with_decision(scores: DataFrame, score: float = RETRAIN_SCORE, violations: int = RETRAIN_VIOLATIONS) -> DataFrame:
    """Retrain on any critical feature, a high score, or many violations.

    The score is compared after rounding to nine digits: a sum of 0.05 steps that should be 0.3
    must not miss the limit by its last bit.
    """
    rounded = F.round("drift_score", 9)
    retrain = (F.size("critical_features") > 0) | (rounded >= score) | (F.col("violation_count") >= violations)
    return scores.withColumn("retrain", retrain)


def classify(scores: DataFrame, completeness_violations: str = "completeness_count", many: int = 3) -> DataFrame:
    """Name the situation: data issue, severe, minor or none."""
    rounded = F.round("drift_score", 9)
    kind = (
        F.when(F.col(completeness_violations) >= many, "data_issue")
        .when((F.size("critical_features") > 0) | (rounded >= RETRAIN_SCORE), "severe")
        .when(rounded >= 0.1, "minor")
        .otherwise("none")
    )
    return scores.withColumn("drift_class", kind)


def drift_alarms(summaries: DataFrame, score: float = 0.3, violations: int = 3, hours: int = 6) -> DataFrame:
    """Worst score and violation count per period and monitor, with both alarms."""
    return (
        summaries.groupBy(F.window("timestamp", f"{hours} hours").alias("w"), "monitoring_type")
        .agg(F.max("drift_score").alias("max_score"), F.max("violation_count").alias("max_violations"))
        .select(
            F.col("w.start").alias("period_start"), "monitoring_type", "max_score", "max_violations",
            (F.round("max_score", 9) > score).alias("score_alarm"),
            ((F.col("monitoring_type") == "model_quality") & (F.col("max_violations") > violations)).alias("violations_alarm"),
        )
    )


def drift_summary(scored: DataFrame, timestamp: Column, schedule: str, monitoring_type: str, report_uri: str) -> DataFrame:
    """The audit record of one analysis."""
    return scored.select(
        timestamp.alias("timestamp"), F.lit(schedule).alias("schedule"), F.lit(monitoring_type).alias("monitoring_type"),
        "violation_count", "drift_score", "critical_features", F.col("retrain").alias("retraining_triggered"),
        F.lit(report_uri).alias("source_report_uri"),
    )
