"""Wire events and webhooks, against results written by hand."""

import json
import re

import pytest
from pyspark.sql import functions as F

from ebbtide.operators import ingest as I, webhooks as K

GOOD = {"event_id": "e1", "customer_id": "c1", "event_type": "login", "timestamp": "2024-01-01T10:00:00Z"}


def line(**changes):
    return json.dumps({k: v for k, v in {**GOOD, **changes}.items() if v != "<absent>"})


CASES = [
    (line(), "Ok", None),
    (line(timestamp="2024-01-01T00:30:00+02:00"), "Ok", None),
    (line(timestamp="2024-01-01T10:00:00.123456+00:00"), "Ok", None),
    (line(timestamp="2024-01-01"), "Ok", None),
    ("{broken", "ProcessingFailed", "invalid_json"),
    ("", "ProcessingFailed", "invalid_json"),
    ("[" + line() + "]", "ProcessingFailed", "invalid_json"),
    (line() + " " + line(), "ProcessingFailed", "invalid_json"),
    (line() + ", " + line(), "ProcessingFailed", "invalid_json"),
    ("12", "ProcessingFailed", "invalid_json"),
    (line(event_id="<absent>"), "ProcessingFailed", "missing_fields: event_id"),
    (line(customer_id=""), "ProcessingFailed", "missing_fields: customer_id"),
    (line(event_type=None, timestamp=""), "ProcessingFailed", "missing_fields: event_type, timestamp"),
    (line(event_id=0), "ProcessingFailed", "missing_fields: event_id"),
    (line(event_id="0"), "Ok", None),
    (line(event_id=False), "ProcessingFailed", "missing_fields: event_id"),
    (line(event_id=[]), "ProcessingFailed", "missing_fields: event_id"),
    (line(event_id=17), "Ok", None),
    (line(metadata={"source": "smoke-test"}), "Dropped", "smoke_test"),
    (line(metadata={"source": "smoke-test"}, timestamp="nope"), "Dropped", "smoke_test"),
    (line(metadata={"source": "smoke-test"}, event_id=""), "ProcessingFailed", "missing_fields: event_id"),
    (line(metadata=None), "Ok", None),
    (line(metadata={"schema_version": "1.1"}), "Ok", None),
    (line(timestamp="yesterday"), "ProcessingFailed", "invalid_timestamp"),
    (line(timestamp="2024-13-01T00:00:00Z"), "ProcessingFailed", "invalid_timestamp"),
    (line(timestamp=1704067200), "ProcessingFailed", "invalid_timestamp"),
    (line(session_duration="abc"), "ProcessingFailed", "invalid_value: session_duration"),
    (line(session_duration="12.7"), "ProcessingFailed", "invalid_value: session_duration"),
    (line(session_duration=12.7), "Ok", None),
    (line(session_duration=" 12 "), "Ok", None),
    (line(transaction_amount="x", session_duration="y"), "ProcessingFailed", "invalid_value: session_duration, transaction_amount"),
]


@pytest.fixture(scope="module")
def routed(spark):
    lines = spark.createDataFrame([(i, text) for i, (text, _, _) in enumerate(CASES)], "i int, value string")
    return {r["i"]: r for r in I.route_events(lines).collect()}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_route(routed, i):
    text, result, reason = CASES[i]
    assert (routed[i]["result"], routed[i]["reason"]) == (result, reason), text


def test_typed_values(spark):
    text = line(session_duration=12.7, transaction_amount="3.5", feature_flags={"a": True}, metadata={"schema_version": "2.0"},
                timestamp="2024-01-01T00:30:00+02:00")
    row = I.route_events(spark.createDataFrame([(text,)], "value string")).first()
    assert (row["session_duration"], row["transaction_amount"]) == (12, 3.5)
    assert (row["feature_flags"], row["_schema_version"]) == ('{"a":true}', "2.0")
    assert str(row["timestamp"]) == "2023-12-31 22:30:00"
    plain = I.route_events(spark.createDataFrame([(line(),)], "value string")).first()
    assert (plain["feature_flags"], plain["_schema_version"], plain["session_duration"]) == ("{}", "1.0", None)


def test_partition_is_utc(spark):
    routed = I.route_events(spark.createDataFrame([(line(timestamp="2024-01-01T00:30:00+02:00"),)], "value string"))
    row = I.accepted(routed, F.lit("2024-01-02").cast("timestamp")).first()
    assert (row["year"], row["month"], row["day"], row["hour"]) == (2023, 12, 31, 22)


def test_bytes_that_are_not_text(spark):
    frames = spark.createDataFrame([(bytes([0xFF, 0xFE]) + line().encode(),), (line().encode(),)], "data binary")
    encoded = frames.select(F.base64("data").alias("data"))
    results = sorted(r["result"] for r in I.route_events(I.decode_frames(encoded)).collect())
    assert results == ["Ok", "ProcessingFailed"]


def test_rejected_keeps_the_text(spark):
    routed = I.route_events(spark.createDataFrame([("{broken",), (line(event_id=""),), (line(),)], "value string"))
    rows = {(r["error_type"], r["original"]) for r in I.rejected(routed, F.lit("2024-01-02").cast("timestamp")).collect()}
    assert rows == {("invalid_json", "{broken"), ("missing_fields", line(event_id=""))}


SEGMENT = [
    ({"type": "track", "event": "Clicked", "messageId": "m1", "userId": "u1", "properties": {"revenue": 5.0, "transaction_amount": 7.0}},
     ("m1", "u1", "Clicked", "unknown", 0, 5.0)),
    ({"type": "track", "messageId": "m2", "userId": "", "anonymousId": "a1", "properties": {"transaction_amount": 7.0}},
     ("m2", "a1", "feature_usage", "unknown", 0, 7.0)),
    ({"type": "identify", "messageId": "m3", "context": {"device": {"type": "mobile"}}}, ("m3", "anonymous", "profile_update", "mobile", 0, 0.0)),
    ({"type": "screen", "messageId": "m4", "userId": "u"}, ("m4", "u", "session_start", "unknown", 0, 0.0)),
    ({"type": "alias", "messageId": "m5", "userId": "u"}, ("m5", "u", "feature_usage", "unknown", 0, 0.0)),
    ({"messageId": "m6", "userId": "u", "event": "E"}, ("m6", "u", "E", "unknown", 0, 0.0)),
]
SHOWN = ["event_id", "customer_id", "event_type", "device", "CAST(session_duration AS int) AS s", "CAST(transaction_amount AS double) AS t"]


def test_segment(spark):
    calls = spark.createDataFrame([(json.dumps(c),) for c, _ in SEGMENT], "value string")
    got = K.normalize_segment(calls, F.lit("2024-01-01").cast("timestamp"))
    assert sorted(tuple(r) for r in got.selectExpr(*SHOWN).collect()) == sorted(e for _, e in SEGMENT)
    first = got.where("event_id = 'm2'").first()
    assert first["metadata"] == {"source": "segment", "schema_version": "1.0", "original_type": "track"}
    assert first["customer_state"] is None


def test_values_keep_their_type_on_the_way(spark):
    """Text amounts are numbers, fractions are cut, text that is no whole number is rejected, flags pass as they are."""
    sent = [
        {"session_duration": 30.7, "revenue": "12.50", "feature_flags": {"a": True, "b": "x", "c": 1}}, {"session_duration": "45"},
        {"session_duration": "12.7"}, {"revenue": "much"}, {},
    ]
    calls = spark.createDataFrame([(json.dumps({"messageId": str(i), "userId": "u", "properties": p}),) for i, p in enumerate(sent)], "value string")
    routed = I.route_events(K.as_wire(K.normalize_segment(calls, F.lit("2024-01-01").cast("timestamp"))))
    rows = {r["event_id"]: (r["result"], r["session_duration"], r["transaction_amount"], r["feature_flags"]) for r in routed.collect()}
    assert rows["0"] == ("Ok", 30, 12.5, '{"a":true,"b":"x","c":1}')
    assert rows["1"] == ("Ok", 45, 0.0, "{}") and rows["4"] == ("Ok", 0, 0.0, "{}")
    assert [rows[i][0] for i in "23"] == ["ProcessingFailed"] * 2


def test_segment_without_id_is_stable(spark):
    calls = spark.createDataFrame([('{"type": "page", "userId": "u"}',)], "value string")
    at = F.lit("2024-01-01").cast("timestamp")
    one, two = (K.normalize_segment(calls, at).first()["event_id"] for _ in range(2))
    assert one == two and len(one) == 64


def test_amplitude(spark):
    events = [
        {"event_id": "1", "user_id": "u", "event_type": "Viewed Big Page", "time": 1704067200123, "platform": "iOS", "event_properties": {"revenue": 2.5}},
        {"event_id": "2", "device_id": "d", "event_type": "[Amplitude] Start Session", "session_id": "s"},
        {"event_id": "3"},
    ]
    calls = spark.createDataFrame([(json.dumps({"events": events}),), ('{"events": []}',), ("{}",)], "value string")
    got = {r["event_id"]: r for r in K.normalize_amplitude(calls).selectExpr(*SHOWN, "timestamp", "session_id").collect()}
    assert [tuple(got[i])[1:6] for i in "123"] == [
        ("u", "viewed_big_page", "ios", 0, 2.5), ("d", "session_start", "unknown", 0, 0.0), ("anonymous", "feature_usage", "unknown", 0, 0.0)]
    assert got["1"]["timestamp"] == "2024-01-01T00:00:00.123000Z"
    assert got["3"]["timestamp"] == "1970-01-01T00:00:00.000000Z"
    assert (got["2"]["session_id"], got["3"]["session_id"]) == ("s", None)


def test_dispatch(spark):
    calls = spark.createDataFrame(
        [("segment", '{"userId": "u"}'), ("amplitude", '{"events": [{"user_id": "v"}]}'), ("other", "{}"), (None, "{}"), ("segment", "{torn")],
        "source string, value string")
    events, rejected = K.dispatch(calls, F.lit("2024-01-01").cast("timestamp"))
    assert sorted(r["customer_id"] for r in events.collect()) == ["u", "v"]
    assert sorted(r["error_type"] for r in rejected.collect()) == ["invalid_json", "unknown_source", "unknown_source"]


def test_webhook_calls_are_read_once(spark, folder):
    """The filter on what was read used to read every call again; the outcome is told from the text and its one value."""
    bodies = ["\t\n {}", "{", "[1]", "null", None, " 7", '{"events":[{"event_id":"a"},{}]}']
    spark.createDataFrame([(b, "amplitude") for b in bodies], "value string, source string").coalesce(1).write.parquet(f"{folder}/calls")
    calls = spark.read.parquet(f"{folder}/calls")
    received = F.lit("2024-01-01").cast("timestamp")
    plan = K.normalize_segment(calls, received)._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"parseJson\(value#", plan)) == 1
    events, rejected = K.dispatch(calls, received)
    assert events.count() == 2 and rejected.where("reason = 'invalid_json'").count() == 5


def test_a_batch_is_routed_once_for_both_sinks(spark, folder):
    from ebbtide.streaming import ingest as S

    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def read(i):
        seen.add(1)
        return json.dumps({"event_id": str(i), "customer_id": "c", "event_type": "login", "timestamp": "2024-01-01T00:00:00Z"}) if i % 4 else "{"

    for _ in range(2):
        S.write_batch(spark.range(40).select(read("id").alias("value")), 0, f"{folder}/raw", f"{folder}/bad", F.lit("2024-01-31").cast("timestamp"))
    assert seen.value == 80 and spark.read.parquet(f"{folder}/raw").count() == 30 and spark.read.parquet(f"{folder}/bad").count() == 10
