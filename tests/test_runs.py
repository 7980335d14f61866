"""Records by day: runs replaced inside their day, whatever their names look like."""

import os

from pyspark.sql import functions as F

from ebbtide.sinks import writers as W

ODD = "a b:c/d=é%{x}[1],(&)@\\'\"#?*^~"


def moment(text):
    return F.lit(text).cast("timestamp")


def write(spark, path, value, suite, at):
    W.append_check_results(spark.createDataFrame([(value,)], "v int"), path, suite, moment(at))


def values(spark, path):
    return sorted((r["v"], r["suite"]) for r in spark.read.parquet(path).collect())


def test_a_run_replaces_itself_and_nothing_else(spark, folder):
    path = f"{folder}/checks"
    for value, suite, at in ((1, ODD, "2024-01-31 10:00:00"), (2, ODD, "2024-01-31 10:00:00"), (3, ODD, "2024-01-31 11:00:00"), (4, "b", "2024-01-31 10:00:00"),
                             (5, ODD, "2024-02-01 10:00:00"), (6, "", "2024-01-31 10:00:00"), (7, "", "2024-01-31 10:00:00")):
        write(spark, path, value, suite, at)
    assert values(spark, path) == [(2, ODD), (3, ODD), (4, "b"), (5, ODD), (7, None)]


def test_one_folder_per_day(spark, folder):
    path = f"{folder}/drift"
    hours = spark.range(24 * 5).select((F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(hours=F.col("id").cast("int"))).alias("timestamp"), F.lit("hourly").alias("schedule"), F.lit(1).alias("n"))
    for _ in range(2):
        W.append_drift_summaries(hours, path, "dev")
    days = [d for d in os.listdir(f"{path}/environment=dev") if d.startswith("date=")]
    assert len(days) == 5 and spark.read.json(path).count() == 120


def test_predictions_of_other_runs_stay(spark, folder):
    path = f"{folder}/predictions"
    rows = spark.createDataFrame([("a", 0.5)], "customer_id string, p double").withColumn("date", F.to_date(F.lit("2024-01-31")))
    for run in ("one", "two", "one"):
        W.append_predictions(rows, path, run)
    assert sorted(r["run"] for r in spark.read.parquet(path).collect()) == ["one", "two"]
