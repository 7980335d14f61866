"""Streams over files: same result as batch, restarts, late rows, silence."""

import datetime as dt

from pyspark.sql import functions as F

from ebbtide.operators import ingest as I
from ebbtide.sinks.tables import VersionedTable
from ebbtide.sources import raw as R
from ebbtide.streaming import ingest as S, silence
from test_curation import TABLE
from test_ingest import CASES


def ts(text):
    return dt.datetime.fromisoformat(text)


def put(spark, folder, name, rows, schema):
    """One file per call, so that a stream sees the calls as separate arrivals."""
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/{name}")


def test_ingest_equals_batch_and_survives_a_restart(spark, folder):
    wire = f"{folder}/wire"
    # Valid lines get ids of their own; blank lines cannot be told from line ends in a text file.
    lines = [t for t, _, _ in CASES if t]
    spark.createDataFrame([(t,) for t in lines[:15]], "value string").coalesce(1).write.text(wire)

    def run():
        S.start_ingest(R.read_events_json(spark, wire, streaming=True), f"{folder}/raw", f"{folder}/bad", f"{folder}/mark", available_now=True).awaitTermination()
        return spark.read.parquet(f"{folder}/raw").count(), spark.read.parquet(f"{folder}/bad").count()

    run()
    spark.createDataFrame([(t,) for t in lines[15:]], "value string").coalesce(1).write.mode("append").text(wire)
    counts = run()
    batch = {r["result"]: r["records"] for r in I.outcome_counts(I.route_events(R.read_events_json(spark, wire))).collect()}
    assert counts == (batch[I.OK], batch[I.FAILED])
    assert run() == counts


def test_listener_sees_counts(spark, folder):
    wire = f"{folder}/wire"
    spark.createDataFrame([(t,) for t, _, _ in CASES], "value string").coalesce(1).write.text(wire)
    listener = S.OutcomeListener()
    spark.streams.addListener(listener)
    try:
        routed = S.observed(I.route_events(R.read_events_json(spark, wire, streaming=True)))
        stream = S.start_append(routed.select("result"), f"{folder}/out", f"{folder}/mark", available_now=True)
        listener.watch(stream)
        stream.awaitTermination()
        totals = listener.wait()
    finally:
        spark.streams.removeListener(listener)
    results = [r for _, r, _ in CASES]
    assert totals == {
        "ok": results.count("Ok"), "dropped": results.count("Dropped"), "failed": results.count("ProcessingFailed")}


EVENTS = "event_id string, event_timestamp timestamp, source string"


def test_dedup_across_batches(spark, folder):
    def run():
        stream = spark.readStream.schema(EVENTS).parquet(f"{folder}/events")
        S.start_append(S.deduplicated_stream(stream), f"{folder}/out", f"{folder}/mark", available_now=True).awaitTermination()
        return sorted(r["event_id"] for r in spark.read.parquet(f"{folder}/out").collect())

    put(spark, folder, "events", [("a", ts("2024-01-01"), "x"), ("a", ts("2024-01-01"), "x"), ("b", ts("2024-01-02"), "x")], EVENTS)
    assert run() == ["a", "b"]
    # Re-delivered inside the overlap: dropped. Older than 25 hours behind the newest: left to the batch merge.
    put(spark, folder, "events", [("b", ts("2024-01-02"), "x"), ("c", ts("2024-01-01T04:00:00"), "x"), ("old", ts("2023-12-30"), "x")], EVENTS)
    assert run() == ["a", "b", "c"]


def test_lateness(spark):
    newest = ts("2024-01-03")
    rows = [(str(h), newest - dt.timedelta(hours=h), "x") for h in (0, 20, 25, 26)]
    marked = S.with_lateness(spark.createDataFrame(rows, EVENTS), F.lit(newest))
    assert {r["event_id"]: r["late"] for r in marked.collect()} == {"0": False, "20": False, "25": False, "26": True}


def test_upsert_stream_skips_a_committed_batch(spark, folder):
    table = VersionedTable(spark, f"{folder}/table", TABLE, ["day"])
    put(spark, folder, "in", [("a", 1, ts("2024-01-01"), 1), ("b", 1, ts("2024-01-01"), 1)], TABLE)

    def run(mark):
        stream = spark.readStream.schema(TABLE).parquet(f"{folder}/in")
        S.start_upsert(stream, table, "t", f"{folder}/{mark}", at=ts("2024-01-05"), available_now=True).awaitTermination()
        return {(r["event_id"], r["value"]) for r in table.read().collect()}, table.commits().count()

    assert run("mark") == ({("a", 1), ("b", 1)}, 1)
    # A lost checkpoint repeats batch 0, which the table knows.
    assert run("other") == ({("a", 1), ("b", 1)}, 1)
    put(spark, folder, "in", [("a", 2, ts("2024-01-02"), 1)], TABLE)
    assert run("mark") == ({("a", 2), ("b", 1)}, 2)


def test_silence(spark, folder):
    def run():
        stream = spark.readStream.schema(EVENTS).parquet(f"{folder}/events")
        S.start_append(silence.silent_sources(stream, "source"), f"{folder}/out", f"{folder}/mark", available_now=True).awaitTermination()
        return {tuple(r) for r in spark.read.schema("source string, last_seen timestamp").parquet(f"{folder}/out").collect()}

    start = ts("2024-01-01")
    put(spark, folder, "events", [("1", start, "stopped"), ("2", start, "steady")], EVENTS)
    run()
    put(spark, folder, "events", [(str(m), start + dt.timedelta(minutes=m), "steady") for m in range(1, 60)], EVENTS)
    run()
    put(spark, folder, "events", [(str(m), start + dt.timedelta(minutes=m), "steady") for m in range(60, 63)], EVENTS)
    found = run()
    assert found == {("stopped", start)}
