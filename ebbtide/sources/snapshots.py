"""Reading feature snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..constants import CATEGORICAL_FEATURES, CUSTOMER, LABEL, NUMERIC_FEATURES
from ..operators.curate import newest_per_key


def read_features(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def latest_per_customer(features: DataFrame) -> DataFrame:
    """Newest snapshot row of each customer that had events in the last seven days."""
    active = features.where(F.col("total_events_7d").isNotNull())
    return newest_per_key(active, CUSTOMER, [F.col("snapshot_date").desc(), F.col("_computed_at").desc_nulls_last()])


def load_features(
    features: DataFrame, as_of: Column, snapshot_date: Column | None = None, lookback_days: int = 90
) -> DataFrame:
    """Model inputs and label, one row per customer: of one date, or the newest of the last days."""
    day = F.col("snapshot_date")
    wanted = day == snapshot_date if snapshot_date is not None else day >= F.date_sub(as_of, lookback_days)
    return latest_per_customer(features.where(wanted)).select(CUSTOMER, LABEL, *CATEGORICAL_FEATURES, *NUMERIC_FEATURES)


def latest_partition(df: DataFrame, column: str) -> DataFrame:
    """Greatest partition value as one row; NULL when the table is empty."""
    return df.agg(F.max(column).alias("latest"))


def has_partition(df: DataFrame, condition: Column) -> bool:
    """Whether any row lies in the partition; reads at most one row."""
    return not df.where(condition).limit(1).isEmpty()
