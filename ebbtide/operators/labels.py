"""Ground truth: predictions joined to confirmed outcomes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .asof import asof_latest


def merged_labels(
    preds: DataFrame, outcomes: DataFrame, end: Column, outcome_days: int = 7, lookback_days: int = 90
) -> DataFrame:
    """inference_id, prediction, label, probability for outcomes confirmed in the days before `end`."""
    start = end - F.make_dt_interval(days=F.lit(outcome_days))
    earliest = start - F.make_dt_interval(days=F.lit(lookback_days))
    confirmed = outcomes.where(F.col("outcome_date").between(start, end))
    logged = preds.where(F.col("inference_timestamp").between(earliest, end))
    joined = asof_latest(logged, confirmed, max_age_days=lookback_days)
    return joined.select(
        "inference_id",
        F.col("churn_prediction").cast("int").alias("prediction"),
        F.col("churned").cast("int").alias("label"),
        F.col("churn_probability").alias("probability"),
    )


def merge_summary(merged: DataFrame) -> DataFrame:
    """How many rows were merged, predicted and actual churn rate."""
    return merged.agg(
        F.count(F.lit(1)).alias("merged_count"),
        F.avg(F.col("prediction").cast("double")).alias("churn_rate_pred"),
        F.avg(F.col("label").cast("double")).alias("churn_rate_actual"),
    )
