"""From wire text to typed raw events: parse, route, coerce, default, partition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..constants import REQUIRED_FIELDS
from ..functions.scalars import event_time, listed, names_where

OK, DROPPED, FAILED = "Ok", "Dropped", "ProcessingFailed"

# Texts of JSON numbers, booleans and containers that count as "no value".
_EMPTY_JSON = ["0", "0.0", "-0.0", "false", "[]", "{}"]

# Every field is read as text first: a value of another type is then a value to judge, not a broken line.
_WIRE_FIELDS = [
    "event_id", "customer_id", "event_type", "timestamp", "device", "session_id", "session_duration", "transaction_amount",
    "feature_flags", "cohort", "plan", "customer_state", "metadata",
]
_WIRE_SCHEMA = ", ".join(f"{name} STRING" for name in _WIRE_FIELDS)


def _variant(value: Column, field: str, kind: str) -> Column:
    """A field with its JSON type; costly, so only evaluated where the text alone leaves a doubt."""
    return F.try_variant_get(F.try_parse_json(value), f"$.{field}", kind)


def _missing(value: Column, field: str) -> Column:
    """Absent, null, or a value that counts as empty. The text "0" is a value, the number 0 is not."""
    text = F.col(f"_json.{field}")
    doubtful = F.schema_of_variant(_variant(value, field, "variant")) != "STRING"
    return F.when(text.isNull() | (text == ""), True).when(text.isin(_EMPTY_JSON), doubtful).otherwise(False)


def _whole_number(value: Column, field: str) -> Column:
    """Text of a whole number, or a JSON number cut to its whole part; the text "12.7" is neither."""
    text = F.col(f"_json.{field}")
    plain = text.rlike(r"^\s*[+-]?\d+\s*$")
    return F.when(text.isNull(), F.lit(None)).when(plain, text.try_cast("int")).otherwise(_variant(value, field, "int"))


def decode_frames(frames: DataFrame, data: str = "data") -> DataFrame:
    """Base64 frames to text lines; bytes that are not UTF-8 stay invalid and are routed as failed."""
    return frames.withColumn("value", F.unbase64(data).cast("string"))


def route_events(lines: DataFrame, value: str = "value") -> DataFrame:
    """Parse text lines and add `result`, `reason` and the typed raw columns.

    The first rule that applies decides: unreadable text, missing required fields, smoke-test
    records, unreadable time, values that cannot be coerced. Columns of the input are kept, so
    the original text can be quarantined.
    """
    text = F.col(value)
    # Put in brackets, the text of exactly one object is an array of length one; counting builds no values.
    one_value = F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1
    readable = F.is_valid_utf8(text) & F.ltrim(text).startswith("{") & one_value
    # One explode of a one-element array: a filter on the result is not pushed below it, which would
    # put a copy of the parsing into every expression that the filter refers to.
    once = F.explode(F.array(F.struct(
        F.coalesce(readable, F.lit(False)).alias("object"), F.from_json(value, _WIRE_SCHEMA).alias("fields")
    )))
    parsed = lines.select("*", once.alias("_parsed")).select(
        *lines.columns, F.col("_parsed.object").alias("_object"), F.col("_parsed.fields").alias("_json")
    )
    raw = {name: F.col(f"_json.{name}") for name in _WIRE_FIELDS}
    coerced = parsed.withColumns({
        "_session_duration": _whole_number(text, "session_duration"),
        "_transaction_amount": raw["transaction_amount"].try_cast("double"),
    })
    typed = coerced.select(
        *lines.columns,
        "_object",
        listed([(f, _missing(text, f)) for f in REQUIRED_FIELDS]).alias("_absent"),
        (F.get_json_object(raw["metadata"], "$.source") == "smoke-test").alias("_smoke"),
        listed([
            (f, raw[f].isNotNull() & F.col(f"_{f}").isNull()) for f in ("session_duration", "transaction_amount")
        ]).alias("_uncoerced"),
        raw["event_id"].alias("event_id"),
        raw["customer_id"].alias("customer_id"),
        raw["event_type"].alias("event_type"),
        event_time(raw["timestamp"]).alias("timestamp"),
        raw["device"].alias("device"),
        raw["session_id"].alias("session_id"),
        F.col("_session_duration").alias("session_duration"),
        F.col("_transaction_amount").alias("transaction_amount"),
        F.coalesce(raw["feature_flags"], F.lit("{}")).alias("feature_flags"),
        raw["cohort"].alias("cohort"),
        raw["plan"].alias("plan"),
        raw["customer_state"].alias("customer_state"),
        F.coalesce(F.get_json_object(raw["metadata"], "$.schema_version"), F.lit("1.0")).alias("_schema_version"),
    )
    unreadable = ~F.col("_object")
    absent = F.col("_absent") != ""
    no_time = F.col("timestamp").isNull()
    uncoerced = F.col("_uncoerced") != ""
    smoke = F.coalesce(F.col("_smoke"), F.lit(False))
    result = (
        F.when(unreadable | absent, FAILED).when(smoke, DROPPED).when(no_time | uncoerced, FAILED).otherwise(OK)
    )
    reason = (
        F.when(unreadable, "invalid_json")
        .when(absent, F.concat(F.lit("missing_fields: "), F.col("_absent")))
        .when(smoke, "smoke_test")
        .when(no_time, "invalid_timestamp")
        .when(uncoerced, F.concat(F.lit("invalid_value: "), F.col("_uncoerced")))
    )
    return typed.withColumns({"result": result, "reason": reason}).drop("_object", "_absent", "_smoke", "_uncoerced")


def accepted(routed: DataFrame, ingest_ts: Column) -> DataFrame:
    """The raw table's rows: routed Ok, with the partition columns taken from the event time in UTC."""
    return routed.where(F.col("result") == OK).select(
        "event_id", "customer_id", "event_type", "timestamp", "device", "session_id", "session_duration",
        "transaction_amount", "feature_flags", "cohort", "plan", "customer_state",
        *partition_columns("timestamp"), ingest_ts.alias("_ingest_timestamp"), "_schema_version",
    )


def rejected(routed: DataFrame, seen_at: Column, value: str = "value") -> DataFrame:
    """Failed records with their reason and original text."""
    return routed.where(F.col("result") == FAILED).select(
        F.regexp_extract("reason", "^[a-z_]+", 0).alias("error_type"), "reason", F.col(value).alias("original"),
        F.to_date(seen_at).alias("date"),
    )


def partition_columns(ts: str) -> list[Column]:
    return [
        F.year(ts).alias("year"), F.month(ts).alias("month"), F.dayofmonth(ts).alias("day"), F.hour(ts).alias("hour"),
    ]


def outcome_counts(routed: DataFrame) -> DataFrame:
    """How many records were taken, dropped, failed."""
    return routed.groupBy("result").agg(F.count(F.lit(1)).alias("records"))


def missing_fields(events: DataFrame, fields: list[str]) -> DataFrame:
    """Add `missing`: names of the given string columns that are NULL or empty."""
    return events.withColumn("missing", names_where([(f, F.coalesce(F.col(f) == "", F.lit(True))) for f in fields]))


def keyed_by_customer(events: DataFrame, time: str = "event_timestamp", slices: int = 1) -> DataFrame:
    """All rows of a customer in one partition, in time order.

    With `slices` above one a customer is spread over up to so many partitions by day, so that a
    very active customer does not fill a single task; order is then kept within a day only.
    """
    slice_no = F.pmod(F.datediff(F.to_date(time), F.lit("1970-01-01")), F.lit(slices))
    return (
        events.withColumn("_slice", slice_no)
        .repartition("customer_id", "_slice")
        .sortWithinPartitions("customer_id", time)
        .drop("_slice")
    )
