"""Reading raw events and wire text, in batch and as a stream."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from .. import schemas
from .paths import existing


def read_raw(spark: SparkSession, path: str, start: Column, end: Column, merge_schema: bool = False) -> DataFrame:
    """Raw events of every day from `start` to `end`, pruned by the partition columns.

    Only the folders of these days are listed. With the declared schema no file footer is read for
    planning. `merge_schema` also returns columns that newer files have added, at the price of
    reading the footers.
    """
    first, last = spark.range(1).select(F.to_date(start), F.to_date(end)).first()
    days = [first + dt.timedelta(days=i) for i in range((last - first).days + 1)]
    folders = existing(spark, [f"{path.rstrip('/')}/year={d.year}/month={d.month}/day={d.day}" for d in days])
    if not folders:
        return spark.createDataFrame([], schemas.RAW_EVENT)
    reader = spark.read.option("mergeSchema", True) if merge_schema else spark.read.schema(schemas.RAW_EVENT)
    return reader.option("basePath", path).parquet(*folders)


def incremental_raw(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Stream of raw files not yet processed; the query's checkpoint remembers which were."""
    reader = spark.readStream.schema(schemas.RAW_EVENT)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def read_events_json(spark: SparkSession, path: str, streaming: bool = False, files_per_batch: int | None = None) -> DataFrame:
    """Wire events as text lines in column `value`; the text is kept for the quarantine."""
    if not streaming:
        return spark.read.text(path)
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(path)


def schema_diff(spark: SparkSession, known: T.StructType, incoming: T.StructType) -> DataFrame:
    """Columns added, dropped or retyped between two schemas."""
    old, new = ({f.name: f.dataType.simpleString() for f in s.fields} for s in (known, incoming))
    rows = [
        (c, "added" if c not in old else "dropped" if c not in new else "changed", old.get(c), new.get(c))
        for c in sorted(old.keys() | new.keys()) if old.get(c) != new.get(c)
    ]
    return spark.createDataFrame(rows, "column string, change string, old_type string, new_type string")


def evolved(known: T.StructType, incoming: T.StructType) -> T.StructType:
    """The known schema plus the new columns; dropped columns stay, known types win."""
    names = set(known.fieldNames())
    return T.StructType([*known.fields, *[f for f in incoming.fields if f.name not in names]])
