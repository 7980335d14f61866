"""Which folders exist; the listing stays on the driver and is bounded by the days asked for."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import SparkSession


def _hadoop(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    hadoop_path, fs = _hadoop(spark, path)
    return fs.exists(hadoop_path)


def existing(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    return [p for p in paths if exists(spark, p)]


def size_in_bytes(spark: SparkSession, path: str) -> int:
    hadoop_path, fs = _hadoop(spark, path)
    return fs.getContentSummary(hadoop_path).getLength()


def day_folders(path: str, start: dt.date, end: dt.date) -> list[str]:
    """YYYY/MM/DD folders of the inclusive range."""
    days = (end - start).days + 1
    return [f"{path.rstrip('/')}/{start + dt.timedelta(days=i):%Y/%m/%d}" for i in range(days)]
