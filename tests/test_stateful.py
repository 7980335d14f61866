"""Streams with timers: silence of a whole stream, late rows in a table of their own, alerts equal to batch."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from ebbtide.operators import alerts as K
from ebbtide.streaming import ingest as S
from ebbtide.streaming import stateful as Y
from test_streaming import EVENTS, put, ts


@pytest.fixture(autouse=True)
def store(spark):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    yield
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


def wait_for(condition, seconds=60):
    until = time.time() + seconds
    while not condition() and time.time() < until:
        time.sleep(0.3)
    assert condition()


def test_a_stream_that_stops_altogether(spark, folder):
    put(spark, folder, "events", [("1", ts("2024-01-01"), "only"), ("2", ts("2024-01-01T00:00:05"), "only")], EVENTS)
    stream = spark.readStream.schema(EVENTS).parquet(f"{folder}/events")
    found = Y.silent_by_timer(stream, "source", seconds=3)
    query = found.writeStream.format("memory").queryName("silences").outputMode("append").trigger(processingTime="300 milliseconds").option("checkpointLocation", f"{folder}/mark").start()

    def rows():
        return sorted((r["source"], r["last_seen"]) for r in spark.table("silences").collect())

    try:
        wait_for(lambda: len(rows()) == 1)
        time.sleep(4)
        assert rows() == [("only", ts("2024-01-01T00:00:05"))]
        # It comes back and stops again: a second row.
        put(spark, folder, "events", [("3", ts("2024-01-02"), "only")], EVENTS)
        wait_for(lambda: len(rows()) == 2)
        assert rows() == [("only", ts("2024-01-01T00:00:05")), ("only", ts("2024-01-02"))]
    finally:
        query.stop()


def test_late_rows_are_kept_aside(spark, folder):
    def run():
        stream = spark.readStream.schema(EVENTS).parquet(f"{folder}/events")
        Y.start_with_late_table(stream, f"{folder}/out", f"{folder}/late", f"{folder}/mark", available_now=True).awaitTermination()

    def ids(name):
        return sorted(r["event_id"] for r in spark.read.schema(EVENTS + ", batch int").parquet(f"{folder}/{name}").collect())

    put(spark, folder, "events", [("a", ts("2024-01-01"), "x"), ("a", ts("2024-01-01"), "x"), ("b", ts("2024-01-05"), "x")], EVENTS)
    run()
    put(spark, folder, "events", [("b", ts("2024-01-05"), "x"), ("c", ts("2024-01-04T04:00:00"), "x"), ("old", ts("2023-12-30"), "x"), ("none", None, "x")], EVENTS)
    run()
    put(spark, folder, "events", [("old", ts("2023-12-30"), "x"), ("d", ts("2024-01-05T01:00:00"), "x")], EVENTS)
    run()
    assert ids("out") == ["a", "b", "c", "d"] and ids("late") == ["none", "old", "old"]


def test_ids_are_remembered_in_few_states(spark, folder, monkeypatch):
    """Many ids, few states; each id is known, forgotten and known again by itself."""
    monkeypatch.setattr(Y, "BUCKETS", 4)

    def run():
        stream = spark.readStream.schema(EVENTS).parquet(f"{folder}/events")
        query = Y.start_with_late_table(stream, f"{folder}/out", f"{folder}/late", f"{folder}/mark", available_now=True)
        query.awaitTermination()
        return [s["numRowsTotal"] for p in query.recentProgress for s in p["stateOperators"]]

    day = [(f"e{i}", ts("2024-01-01") + dt.timedelta(minutes=i), "x") for i in range(300)]
    put(spark, folder, "events", [*day, *day], EVENTS)
    held = run()
    assert held and max(held) <= 30
    # The watermark passes e0 to e99 by as much again, so that these are new when they come back.
    put(spark, folder, "events", [("new", ts("2024-01-01T01:40:00") + dt.timedelta(hours=50, seconds=-1), "x")], EVENTS)
    run()
    put(spark, folder, "events", [(e, ts("2024-01-03"), "x") for e, _, _ in day], EVENTS)
    run()
    out = {r["event_id"]: r["count"] for r in spark.read.parquet(f"{folder}/out").groupBy("event_id").count().collect()}
    assert out == {"new": 1, **{f"e{i}": 2 if i < 100 else 1 for i in range(300)}}


SAMPLE = "metric string, series string, ts timestamp, value double"


def test_alerts_equal_batch(spark, folder):
    rules = K.rule_table(spark, [("High", "load", ">", 0.8, 120, 60, "critical"), ("Low", "load", "<", 0.2, 0, 60, "warning")])
    start = ts("2024-01-01")
    values = {"a": [0.9] * 5 + [0.1] + [0.9] * 2 + [0.5] + [0.95] * 4 + [0.1], "b": [0.9, 0.9, None, 0.9, 0.9, 0.9, 0.9, 0.1, 0.1, 0.5, 0.5, 0.5, 0.5, 0.5]}
    samples = [("load", s, start + dt.timedelta(minutes=i), v) for s, own in values.items() for i, v in enumerate(own)]
    samples = [x for x in samples if not (x[1] == "b" and x[2].minute == 5)]  # a gap
    end = [("load", "a", start + dt.timedelta(minutes=60), 0.5)]

    def run():
        stream = spark.readStream.schema(SAMPLE).parquet(f"{folder}/in")
        S.start_append(Y.alert_states(stream, rules, "5 minutes"), f"{folder}/out", f"{folder}/mark", available_now=True).awaitTermination()

    # Out of order within the delay, then what pushes the watermark, then late repetitions.
    put(spark, folder, "in", [x for i, x in enumerate(samples) if i % 3 != 1], SAMPLE)
    put(spark, folder, "in", [x for i, x in enumerate(samples) if i % 3 == 1], SAMPLE)
    run()
    put(spark, folder, "in", end, SAMPLE)
    run()
    put(spark, folder, "in", samples[:6], SAMPLE)
    run()
    got = spark.read.parquet(f"{folder}/out")
    columns = ["alert", "series", "severity", "ts", "value", "met", "firing"]
    mine = sorted((tuple(r[c] for c in columns) for r in got.where("met IS NOT NULL").collect()), key=repr)
    batch = K.evaluate_alerts(spark.createDataFrame(samples, SAMPLE), rules)
    assert mine == sorted((tuple(r[c] for c in columns) for r in batch.collect()), key=repr)
    assert {r["state"] for r in got.collect()} == {"inactive", "pending", "firing", "resolved"}


def test_an_alert_ends_with_its_samples(spark, folder):
    rules = K.rule_table(spark, [("High", "load", ">", 0.8, 60, 60, "critical")])
    start = ts("2024-01-01")

    def run():
        stream = spark.readStream.schema(SAMPLE).parquet(f"{folder}/in")
        S.start_append(Y.alert_states(stream, rules, "0 seconds"), f"{folder}/out", f"{folder}/mark", available_now=True).awaitTermination()

    put(spark, folder, "in", [("load", "a", start + dt.timedelta(minutes=i), 1.0) for i in range(3)], SAMPLE)
    run()
    put(spark, folder, "in", [("load", "other", start + dt.timedelta(hours=1), 0.0)], SAMPLE)
    run()
    put(spark, folder, "in", [("load", "other", start + dt.timedelta(hours=2), 0.0)], SAMPLE)
    run()
    rows = [(r["state"], r["value"]) for r in spark.read.parquet(f"{folder}/out").where("series = 'a'").orderBy("ts").collect()]
    assert rows == [("pending", 1.0), ("firing", 1.0), ("firing", 1.0), ("resolved", None)]
