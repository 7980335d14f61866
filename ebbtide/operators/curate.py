"""Raw events to curated events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .. import schemas
from ..constants import MAX_SESSION_SECONDS, MAX_TRANSACTION_AMOUNT
from ..functions.scalars import clamped, event_time, known_customer, normalised


def newest_per_key(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """One row per key, the first along `order`.

    Spark keeps one row per key in each input task before the shuffle (window group limit), so a
    key with a huge number of copies does not travel.
    """
    rank = F.row_number().over(W.partitionBy(key).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def total_order(df: DataFrame, skip: tuple[str, ...] = ()) -> list[Column]:
    """Every sortable column, descending, so that equal versions still have one winner."""
    sortable = [f.name for f in df.schema.fields if f.name not in skip and f.dataType.typeName() not in ("map", "variant")]
    return [F.col(c).desc_nulls_last() for c in sortable]


def deduplicated(raw: DataFrame) -> DataFrame:
    """One row per event id: the one ingested last."""
    return newest_per_key(raw, "event_id", [F.col("_ingest_timestamp").desc_nulls_last(), *total_order(raw)])


def with_event_time(raw: DataFrame) -> DataFrame:
    """Add `event_timestamp` from text or from a timestamp."""
    is_text = dict(raw.dtypes)["timestamp"] == "string"
    parsed = event_time(F.col("timestamp")) if is_text else F.col("timestamp").cast("timestamp")
    return raw.withColumn("event_timestamp", parsed)


def cleaned(events: DataFrame) -> DataFrame:
    """The value rules, column by column; rows are kept."""
    amount = F.col("transaction_amount")
    return events.withColumns({
        "event_type": normalised(F.col("event_type")),
        "device": normalised(F.col("device")),
        "plan": normalised(F.col("plan")),
        "customer_state": normalised(F.col("customer_state")),
        "customer_id": known_customer(F.col("customer_id")),
        "session_duration": clamped(F.col("session_duration"), 0, MAX_SESSION_SECONDS),
        "transaction_amount": F.when(amount < 0, F.lit(0.0)).when(~(amount > MAX_TRANSACTION_AMOUNT), amount),
        "feature_flags": F.from_json("feature_flags", schemas.FLAGS),
    })


def curate(raw: DataFrame, start: Column, end: Column, etl_ts: Column, job_name: str) -> DataFrame:
    """The curated rows of the inclusive time range [start, end].

    The range is applied before the deduplication, so only rows of the range are shuffled.
    """
    in_range = with_event_time(raw).where(F.col("event_timestamp").between(start, end))
    kept = cleaned(deduplicated(in_range)).where(F.col("customer_id").isNotNull())
    time = "event_timestamp"
    return kept.withColumns({
        "event_year": F.year(time), "event_month": F.month(time), "event_day": F.dayofmonth(time),
        "event_hour": F.hour(time), "_etl_timestamp": etl_ts.cast("timestamp"), "_etl_job": F.lit(job_name),
    }).select(*[f.name for f in schemas.CURATED_EVENT.fields])


def load_metrics(raw: DataFrame, curated: DataFrame) -> DataFrame:
    """Rows read, rows kept, share of raw rows without customer (NULL when nothing was read)."""
    read = raw.agg(
        F.count(F.lit(1)).alias("raw_records"),
        F.avg(F.col("customer_id").isNull().cast("double")).alias("null_customer_rate"),
    )
    kept = curated.agg(F.count(F.lit(1)).alias("n")).scalar()
    return read.select("raw_records", kept.alias("curated_records"), "null_customer_rate")
