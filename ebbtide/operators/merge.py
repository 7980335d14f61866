"""Upsert by key and version, as a pure function of two frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .curate import newest_per_key, total_order


def merge_events(target: DataFrame, incoming: DataFrame, key: str = "event_id", version: str = "_etl_timestamp") -> DataFrame:
    """The target after the upsert: the newer version wins, an equal version keeps the target."""
    columns = target.columns
    both = target.withColumn("_kept", F.lit(1)).unionByName(incoming.select(*columns).withColumn("_kept", F.lit(0)))
    order = [F.col(version).desc_nulls_last(), F.col("_kept").desc(), *total_order(both, skip=("_kept",))]
    return newest_per_key(both, key, order).select(*columns)


def merge_plan(target: DataFrame, incoming: DataFrame, key: str = "event_id", version: str = "_etl_timestamp") -> DataFrame:
    """What the upsert does with each incoming row: insert, update or keep."""
    latest = newest_per_key(incoming, key, [F.col(version).desc_nulls_last(), *total_order(incoming)])
    old = target.select(F.col(key).alias("_key"), F.col(version).alias("_old"))
    action = F.when(F.col("_key").isNull(), "insert").when(F.col("_old") < F.col(version), "update").otherwise("keep")
    return latest.join(old, F.col(key) == F.col("_key"), "left").select(key, action.alias("action"))
