"""Reading captured predictions and confirmed outcomes from daily folders."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schemas
from ..functions.scalars import event_time, present
from .paths import day_folders, existing


def parse_capture(lines: DataFrame, value: str = "value") -> DataFrame:
    """Capture lines to predictions with `readable`; the output is JSON text inside the JSON line."""
    line_schema = schemas.struct(*[(f.name, f.dataType) for f in schemas.CAPTURE_LINE.fields], ("_bad", schemas.STR))
    out_schema = schemas.struct(*[(f.name, f.dataType) for f in schemas.CAPTURE_OUTPUT.fields], ("_bad", schemas.STR))
    options = {"columnNameOfCorruptRecord": "_bad"}
    outer = lines.select(F.from_json(value, line_schema, options).alias("r"))
    text = F.coalesce("r.captureData.endpointOutput.data", "r.captureData.endpointOutput.body", F.lit("{}"))
    both = outer.withColumn("o", F.from_json(text, out_schema, options))
    answer = F.lower("o.churn_prediction")
    return both.select(
        (F.col("r._bad").isNull() & F.col("o._bad").isNull()).alias("readable"),
        F.col("r.inferenceId").alias("inference_id"),
        present(F.col("r.eventMetadata.customAttributes.customer_id")).alias("customer_id"),
        F.col("o.churn_probability").alias("churn_probability"),
        F.when(answer == "true", 1).when(answer == "false", 0).otherwise(answer.try_cast("int")).alias("churn_prediction"),
        event_time(F.col("r.eventMetadata.inferenceTime")).alias("inference_timestamp"),
    )


def capture_lines(spark: SparkSession, path: str, start: dt.date, end: dt.date) -> DataFrame:
    folders = existing(spark, day_folders(path, start, end))
    if not folders:
        return spark.createDataFrame([], "value string")
    return spark.read.text(folders, recursiveFileLookup=True)


def read_capture(spark: SparkSession, path: str, start: dt.date, end: dt.date) -> DataFrame:
    """Predictions of the inclusive date range; a line that cannot be read is left out, the rest of its file is kept."""
    parsed = parse_capture(capture_lines(spark, path, start, end).where(F.trim("value") != ""))
    return parsed.where("readable").drop("readable")


def unreadable_captures(spark: SparkSession, path: str, start: dt.date, end: dt.date) -> DataFrame:
    """How many lines of the range could and could not be read."""
    parsed = parse_capture(capture_lines(spark, path, start, end).where(F.trim("value") != ""))
    return parsed.agg(F.count_if("readable").alias("readable"), F.count_if(~F.col("readable")).alias("unreadable"))


def read_outcomes(spark: SparkSession, path: str, start: dt.date, end: dt.date) -> DataFrame:
    """Outcomes of the inclusive date range; an empty range gives an empty frame with the schema."""
    folders = existing(spark, day_folders(path, start, end))
    if not folders:
        return spark.createDataFrame([], schemas.OUTCOME)
    return spark.read.schema(schemas.OUTCOME).parquet(*folders)
