"""Partitioned writes of each layer."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..session import cut_lineage
from ..sources.paths import exists

HOURLY = ["year", "month", "day", "hour"]


def gathered(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows brought together by partition value before a partitioned write.

    The rebalance hint lets adaptive execution split a partition value that is too large for one
    task and put small ones together, so neither a hot hour nor thousands of tiny files result.
    """
    return df.hint("rebalance", *[F.col(c) for c in columns])


def overwrite_partitions(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """Replace only the partitions that the frame has rows for; running it again changes nothing."""
    (
        gathered(df, columns).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "snappy")
        .partitionBy(*columns).parquet(path)
    )


def write_raw(df: DataFrame, path: str, batch: str | None = None) -> None:
    """Append raw events by event hour.

    With a `batch` name its files get a partition of their own, which a repeated attempt replaces.
    """
    if batch is None:
        gathered(df, HOURLY).write.mode("append").option("compression", "snappy").partitionBy(*HOURLY).parquet(path)
    else:
        overwrite_partitions(df.withColumn("batch", F.lit(batch)), path, [*HOURLY, "batch"])


def write_quarantine(df: DataFrame, path: str, batch: str | None = None) -> None:
    """Rejected records by error type and date, with the original text."""
    if batch is None:
        gathered(df, ["error_type", "date"]).write.mode("append").partitionBy("error_type", "date").parquet(path)
    else:
        overwrite_partitions(df.withColumn("batch", F.lit(batch)), path, ["error_type", "date", "batch"])


def write_splits(split: DataFrame, path: str, date: str) -> DataFrame:
    """Write train, validation and test rows under a date and summarise what was written."""
    from ..operators.prep import split_summary

    target = f"{path.rstrip('/')}/date={date}"
    (
        gathered(split, ["split"]).write.mode("overwrite").option("partitionOverwriteMode", "static")
        .option("compression", "snappy").partitionBy("split").parquet(target)
    )
    return split_summary(split.sparkSession.read.parquet(target))


def write_merged_labels(merged: DataFrame, path: str, date: str) -> str:
    """CSV with header under the run date."""
    target = f"{path.rstrip('/')}/{date.replace('-', '/')}"
    merged.write.mode("overwrite").option("header", True).csv(target)
    return target


def replace_runs(records: DataFrame, path: str, days: Sequence[str], kind: str = "parquet") -> None:
    """Write records by the partition columns `days`; a run (column `run`) that is written again replaces its own.

    The days that the records touch are read, rows of the same runs are left out, and these days alone are overwritten:
    one folder per day, however many runs it has. Only the list of days passes the driver. An empty name is NULL, as in
    any partition.
    """
    spark = records.sparkSession
    named = {f.name: F.nullif(F.col(f.name), F.lit("")) for f in records.schema.fields if f.name in days and f.dataType.typeName() == "string"}
    fresh = cut_lineage(records.withColumns(named) if named else records, "records")
    rows = fresh
    if exists(spark, path):
        # One text per day, from partition columns alone: the scan is pruned by it.
        day = F.concat_ws("\x01", *[F.coalesce(F.col(d).cast("string"), F.lit("\x02")) for d in days])
        touched = [r.day for r in fresh.select(day.alias("day")).distinct().collect()]
        held = spark.read.schema(fresh.schema).format(kind).load(path).where(day.isin(touched))
        runs = fresh.select(*[F.col(c).alias(f"_{c}") for c in (*days, "run")]).distinct()
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in (*days, "run")])
        rows = fresh.unionByName(held.join(runs, same, "left_anti").select(*fresh.columns))
    gathered(rows, days).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*days).format(kind).save(path)


# Digits of a moment in the name of a run.
MOMENT = "yyyyMMdd'T'HHmmss"


def append_drift_summaries(summaries: DataFrame, path: str, environment: str) -> None:
    """JSON records by environment and date; a run (schedule, type and moment) that is repeated replaces its own records."""
    parts = [F.col(c) for c in ("schedule", "monitoring_type") if c in summaries.columns]
    run = F.concat_ws("-", *parts, F.date_format("timestamp", MOMENT))
    rows = summaries.withColumns({"environment": F.lit(environment), "date": F.to_date("timestamp"), "run": run})
    replace_runs(rows, path, ["environment", "date"], "json")


def append_check_results(results: DataFrame, path: str, suite: str, run_at: Column) -> None:
    """Rows of a check suite or of quality gates, by suite and date; a run that is repeated replaces its own rows."""
    rows = results.withColumns({
        "suite": F.lit(suite), "run_at": run_at, "date": F.to_date(run_at), "run": F.date_format(run_at, MOMENT),
    })
    replace_runs(rows, path, ["suite", "date"])


def append_predictions(scored: DataFrame, path: str, run: str) -> None:
    """Predictions by date: other runs of the day stay, a run that is repeated replaces its own rows."""
    replace_runs(scored.withColumn("run", F.lit(run)), path, ["date"])
