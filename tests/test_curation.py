"""Curation, merge, tables, sources and sinks on hand-written rows."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from ebbtide import schemas
from ebbtide.operators import curate as C, merge as M
from ebbtide.plans import jobs
from ebbtide.sinks import tables as T, writers as W
from ebbtide.sources.paths import size_in_bytes
from ebbtide.sources import labels as L, raw as R, snapshots as N


def ts(text):
    return dt.datetime.fromisoformat(text)


def raw_row(event_id, time="2024-01-10T12:00:00", ingested="2024-01-10T13:00:00", **changes):
    row = dict(
        event_id=event_id, customer_id="c1", event_type="login", timestamp=ts(time), device="mobile", session_id="s", session_duration=10,
        transaction_amount=1.0, feature_flags='{"a": true}', cohort="2024-Q1", plan="pro", customer_state="healthy",
        _ingest_timestamp=ts(ingested), _schema_version="1.0")
    row.update(changes)
    at = row["timestamp"]
    row.update(year=at.year, month=at.month, day=at.day, hour=at.hour)
    return tuple(row[f] for f in schemas.RAW_EVENT.fieldNames())


def curated(spark, rows, start="2024-01-10", end="2024-01-11"):
    frame = spark.createDataFrame(rows, schemas.RAW_EVENT)
    lit = [F.lit(x).cast("timestamp") for x in (start, end, "2024-01-12")]
    return {r["event_id"]: r for r in C.curate(frame, *lit, "job").collect()}


@pytest.mark.parametrize("given, kept", [(-5, 0), (0, 0), (86400, 86400), (86401, 86400), (None, None)])
def test_duration(spark, given, kept):
    assert curated(spark, [raw_row("e", session_duration=given)])["e"]["session_duration"] == kept


@pytest.mark.parametrize("given, kept", [(-1.0, 0.0), (0.0, 0.0), (100000.0, 100000.0), (100000.01, None), (None, None)])
def test_amount(spark, given, kept):
    assert curated(spark, [raw_row("e", transaction_amount=given)])["e"]["transaction_amount"] == kept


def test_customers(spark):
    names = {"a": "", "b": "anonymous", "c": "Anonymous", "d": None, "e": " ", "f": "c9"}
    got = curated(spark, [raw_row(k, customer_id=v) for k, v in names.items()])
    assert {k: r["customer_id"] for k, r in got.items()} == {"c": "Anonymous", "e": " ", "f": "c9"}


def test_flags_and_text(spark):
    flags = {"ok": '{"a": true, "b": false}', "mixed": '{"a": "yes"}', "bad": "not json", "none": None}
    got = curated(spark, [raw_row(k, feature_flags=v, device=" Mobile ", event_type="LOGIN") for k, v in flags.items()])
    assert got["ok"]["feature_flags"] == {"a": True, "b": False}
    assert got["bad"]["feature_flags"] is None and got["none"]["feature_flags"] is None
    assert (got["ok"]["device"], got["ok"]["event_type"]) == ("mobile", "login")


def test_range_is_inclusive(spark):
    times = {"first": "2024-01-10T00:00:00", "last": "2024-01-11T00:00:00", "early": "2024-01-09T23:59:59", "late": "2024-01-11T00:00:01"}
    assert set(curated(spark, [raw_row(k, time=v) for k, v in times.items()])) == {"first", "last"}


def test_newest_delivery_wins(spark):
    rows = [raw_row("e", ingested=f"2024-01-10T13:0{i}:00", session_duration=i) for i in (1, 3, 2)]
    assert curated(spark, rows)["e"]["session_duration"] == 3
    # Without an order between deliveries the result still does not depend on the order of rows.
    same = [raw_row("e", session_duration=i) for i in (1, 3, 2)]
    assert curated(spark, same)["e"]["session_duration"] == curated(spark, same[::-1])["e"]["session_duration"]


VERSIONED = "event_id string, value int, _etl_timestamp timestamp"


def test_merge(spark, rows):
    old, same, new = ts("2024-01-01"), ts("2024-01-02"), ts("2024-01-03")
    target = spark.createDataFrame([("a", 1, same), ("b", 1, same), ("c", 1, same), ("d", 1, same)], VERSIONED)
    incoming = spark.createDataFrame([("a", 2, old), ("b", 2, same), ("c", 2, new), ("e", 2, old), ("e", 3, new)], VERSIONED)
    merged = M.merge_events(target, incoming)
    assert {(r[0], r[1]) for r in merged.collect()} == {("a", 1), ("b", 1), ("c", 2), ("d", 1), ("e", 3)}
    assert rows(M.merge_events(merged, incoming)) == rows(merged)
    assert {tuple(r) for r in M.merge_plan(target, incoming).collect()} == {("a", "keep"), ("b", "keep"), ("c", "update"), ("e", "insert")}


TABLE = schemas.struct(("event_id", schemas.STR), ("value", schemas.INT), ("_etl_timestamp", schemas.TS), ("day", schemas.INT))


def test_table_moves_keys_and_keeps_history(spark, folder):
    table = T.VersionedTable(spark, folder, TABLE, ["day"])
    assert table.read().count() == 0

    def put(rows, at, batch=None):
        frame = spark.createDataFrame([(k, v, ts(t), d) for k, v, t, d in rows], TABLE)
        return table.upsert(frame, "event_id", "_etl_timestamp", ts(at), batch)

    def now(at=None):
        return {(r["event_id"], r["value"], r["day"]) for r in table.read(at).collect()}

    assert put([("a", 1, "2024-01-01", 1), ("b", 1, "2024-01-01", 2), ("c", 1, "2024-01-01", 3)], "2024-01-01", "one") == 1
    # a moves from day 1 to day 2, which leaves day 1 empty; b is stale; c is untouched.
    assert put([("a", 2, "2024-01-02", 2), ("b", 9, "2023-12-31", 4)], "2024-01-02", "two") == 2
    after = {("a", 2, 2), ("b", 1, 2), ("c", 1, 3)}
    assert now() == after
    assert put([("a", 5, "2024-01-05", 2)], "2024-01-03", "two") is None
    assert now() == after
    assert now(ts("2024-01-01T12:00:00")) == {("a", 1, 1), ("b", 1, 2), ("c", 1, 3)}
    assert now(ts("2023-01-01")) == set()
    touched = {(r["version"], r["day"]): r["rows"] for r in table.commits().collect()}
    assert touched[(2, 1)] == 0 and (2, 3) not in touched
    assert table.compact(["event_id"], ts("2024-01-06")) == 3
    assert now() == after


def test_compaction_cuts_only_what_exceeds_a_file(spark, folder):
    """Three days of about the same size in files of up to one and a half days; then in files of less than a day."""
    table = T.VersionedTable(spark, folder, TABLE, ["day"])
    rows = spark.range(6000).select(
        F.col("id").cast("string").alias("event_id"), F.col("id").cast("int").alias("value"), F.lit("2024-01-01").cast("timestamp").alias("_etl_timestamp"),
        (F.col("id") % 3).cast("int").alias("day"))
    table.upsert(rows, "event_id", "_etl_timestamp", ts("2024-01-01"))

    def files():
        placed = table.read().select("*", F.input_file_name().alias("file"))
        return {r["day"]: r["files"] for r in placed.groupBy("day").agg(F.count_distinct("file").alias("files")).collect()}

    day = max(size_in_bytes(spark, f) for f in table.folders())
    table.compact(["event_id"], ts("2024-01-02"), target_bytes=day * 3 // 2)
    assert files() == {0: 1, 1: 1, 2: 1}
    table.compact(["event_id"], ts("2024-01-03"), target_bytes=day // 4)
    assert all(n > 1 for n in files().values())
    assert {(r["event_id"], r["day"]) for r in table.read().collect()} == {(str(i), i % 3) for i in range(6000)}


def test_expirable_versions(spark):
    commits = spark.createDataFrame([(v, ts("2024-01-01") + dt.timedelta(days=v), v % 3) for v in range(1, 21)], "version int, committed_at timestamp, day int")
    old = T.expirable_versions(commits, F.lit("2024-01-22").cast("timestamp"), max_age_days=7, keep=10)
    assert {r["version"] for r in old.collect()} == set(range(1, 11))
    pinned = commits.unionByName(spark.createDataFrame([(4, ts("2024-01-05"), 99)], commits.schema))
    assert 4 not in {r["version"] for r in T.unreferenced(old, pinned, ["day"]).collect()}


def test_partition_tiers(spark):
    days = spark.createDataFrame([(dt.date(2024, 1, 1) - dt.timedelta(days=d),) for d in (89, 90, 365, 2555)], "date date")
    report = T.partition_age_report(days, F.lit("2024-01-01").cast("timestamp"))
    assert {r["age_days"]: r["tier"] for r in report.collect()} == {89: "hot", 90: "cold", 365: "archive", 2555: "delete"}


def test_raw_range_spans_three_days(spark, folder):
    stamps = ["2024-01-09T23:30:00", "2024-01-10T12:00:00", "2024-01-11T00:30:00", "2024-01-12T01:00:00"]
    frame = spark.createDataFrame([raw_row(str(i), time=t) for i, t in enumerate(stamps)], schemas.RAW_EVENT)
    W.write_raw(frame, folder)
    got = R.read_raw(spark, folder, F.lit("2024-01-09 23:00:00").cast("timestamp"), F.lit("2024-01-11 00:45:00").cast("timestamp"))
    assert {r["event_id"] for r in got.collect()} == {"0", "1", "2"}
    assert N.has_partition(got, F.col("day") == 10) and not N.has_partition(got, F.col("day") == 12)


def test_new_raw_column_is_merged(spark, folder):
    frame = spark.createDataFrame([raw_row("a")], schemas.RAW_EVENT)
    W.write_raw(frame, folder)
    W.write_raw(frame.withColumn("event_id", F.lit("b")).withColumn("campaign", F.lit("x")), folder)
    at = F.lit("2024-01-10").cast("timestamp")
    merged = R.read_raw(spark, folder, at, at, merge_schema=True)
    assert {(r["event_id"], r["campaign"]) for r in merged.collect()} == {("a", None), ("b", "x")}
    diff = {tuple(r) for r in R.schema_diff(spark, schemas.RAW_EVENT, merged.schema).collect()}
    assert ("campaign", "added", None, "string") in diff
    assert R.evolved(schemas.RAW_EVENT, merged.schema).fieldNames()[-1] == "campaign"


def test_batch_written_twice_counts_once(spark, folder):
    frame = spark.createDataFrame([raw_row("a"), raw_row("b", time="2024-01-10T15:00:00")], schemas.RAW_EVENT)
    for _ in range(2):
        W.write_raw(frame, folder, "b0")
    W.write_raw(frame, folder, "b1")
    assert spark.read.parquet(folder).count() == 4


def capture_line(i, customer, time, p, decision, body=False):
    output = json.dumps({"churn_probability": p, "churn_prediction": decision})
    return json.dumps({
        "inferenceId": i, "eventMetadata": {"inferenceTime": time, "customAttributes": {"customer_id": customer}},
        "captureData": {"endpointOutput": {"body" if body else "data": output}}})


def test_ground_truth_job(spark, folder):
    end = ts("2024-01-31")
    lines = {
        "2024/01/20": [capture_line("p1", "a", "2024-01-20T10:00:00Z", 0.9, True), "{torn", capture_line("p2", "a", "2024-01-20T11:00:00Z", 0.2, False, body=True)],
        "2024/01/28": [capture_line("p3", "a", "2024-01-28T00:00:00Z", 0.7, True), capture_line("p4", "b", "2024-01-28T09:00:00Z", 0.1, 0), capture_line("p5", "", "2024-01-28T09:00:00Z", 0.1, 0)],
    }
    for day, texts in lines.items():
        spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1).write.text(f"{folder}/capture/{day}")
    rows = [("a", True, ts("2024-01-27")), ("a", False, ts("2024-01-28")), ("b", True, ts("2024-01-28")), ("c", True, ts("2024-01-30")), ("", True, ts("2024-01-30"))]
    spark.createDataFrame(rows, schemas.OUTCOME).write.parquet(f"{folder}/outcomes/2024/01/30")
    assert L.unreadable_captures(spark, f"{folder}/capture", dt.date(2024, 1, 1), dt.date(2024, 1, 31)).first()["unreadable"] == 1
    assert L.read_outcomes(spark, f"{folder}/outcomes", dt.date(2023, 1, 1), dt.date(2023, 1, 5)).count() == 0
    summary = jobs.ground_truth(spark, f"{folder}/capture", f"{folder}/outcomes", f"{folder}/labels", end).first()
    # a on the 27th saw p2, a on the 28th p3 made at that very moment; b's prediction came after its outcome.
    assert summary["merged_count"] == 2
    written = spark.read.option("header", True).schema(schemas.MERGED_LABEL).csv(f"{folder}/labels/2024/01/31")
    assert {(r["inference_id"], r["prediction"], r["label"]) for r in written.collect()} == {("p2", 0, 1), ("p3", 1, 0)}
