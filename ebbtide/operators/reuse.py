"""Reuse of stored predictions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..constants import PREDICTION_TTL_SECONDS
from ..functions.scalars import prediction_key
from ..session import cut_lineage
from ..sinks.writers import append_predictions
from .curate import newest_per_key

PREDICTION = ["churn_probability", "churn_prediction", "model_version", "threshold", "model_type"]

STORE = (
    "prediction_key string, customer_id string, churn_probability double, churn_prediction boolean, model_version string, "
    "threshold double, model_type string, scored_at timestamp, date date, run string"
)


def keyed(requests: DataFrame, features: Sequence[str], customer: str = "customer_id") -> DataFrame:
    return requests.withColumn("prediction_key", prediction_key(F.col(customer), features))


def read_store(spark: SparkSession, path: str, as_of: dt.datetime, ttl_s: int = PREDICTION_TTL_SECONDS) -> DataFrame:
    """Stored predictions of the days that the time to live reaches back to; other partitions are not read."""
    first = (as_of - dt.timedelta(seconds=ttl_s)).date()
    return spark.read.schema(STORE).parquet(path).where(F.col("date").between(F.lit(first), F.lit(as_of.date())))


def unexpired(store: DataFrame, as_of: Column, ttl_s: int = PREDICTION_TTL_SECONDS) -> DataFrame:
    """Newest stored prediction per key that is younger than the time to live."""
    alive = (F.col("scored_at") > as_of - F.make_dt_interval(secs=F.lit(ttl_s))) & (F.col("scored_at") <= as_of)
    return newest_per_key(store.where(alive), "prediction_key", [F.col("scored_at").desc(), F.col("model_version").desc()])


def incremental_score(
    requests: DataFrame, store: DataFrame, score: Callable[[DataFrame], DataFrame], features: Sequence[str], as_of: Column,
    ttl_s: int = PREDICTION_TTL_SECONDS,
) -> DataFrame:
    """Score only the requests without an unexpired stored prediction; `cached` tells which is which.

    `features` has to name every input of the model: a prediction is reused only for equal inputs. The store is read and
    joined once; the matched requests are written, so that neither the reuse nor the scoring repeats the join.
    """
    held = unexpired(store, as_of, ttl_s).select("prediction_key", F.struct(*PREDICTION).alias("_held"))
    asked = keyed(requests, features)
    matched = cut_lineage(asked.join(held, "prediction_key", "left"), "matched")
    columns = [*asked.columns, *PREDICTION, "cached"]
    reused = matched.where(F.col("_held").isNotNull()).select(*asked.columns, "_held.*").withColumn("cached", F.lit(True))
    fresh = score(matched.where(F.col("_held").isNull()).select(*asked.columns)).withColumn("cached", F.lit(False))
    return reused.select(*columns).unionByName(fresh.select(*columns))


def to_store(scored: DataFrame, scored_at: Column) -> DataFrame:
    """Rows to add to the store: what was scored now."""
    fresh = scored.where(~F.col("cached"))
    return fresh.select("prediction_key", "customer_id", *PREDICTION, scored_at.alias("scored_at"), F.to_date(scored_at).alias("date"))


def write_store(scored: DataFrame, path: str, scored_at: Column, run: str) -> None:
    """Add what was scored now by date; a repeated run replaces its own rows."""
    append_predictions(to_store(scored, scored_at), path, run)


def invalidated(store: DataFrame, refreshed: DataFrame, customer: str = "customer_id") -> DataFrame:
    """The store without the predictions of customers whose features changed."""
    return store.join(refreshed.select(customer).distinct(), customer, "left_anti").select(*store.columns)
