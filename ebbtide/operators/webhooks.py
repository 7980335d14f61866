"""Webhook payloads of two vendors in the common event shape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import schemas
from ..functions.scalars import present

# Vendor call type to event type; a track call carries its own event name.
SEGMENT_TYPES = {"identify": "profile_update", "group": "profile_update", "page": "session_start", "screen": "session_start"}

# Vendor names of session events, after lower-casing and replacing spaces.
AMPLITUDE_ALIASES = {"[amplitude]_start_session": "session_start", "[amplitude]_end_session": "session_end"}

DEFAULT_TYPE = "feature_usage"


def _lookup(column: Column, pairs: dict[str, str]) -> Column:
    found = F.lit(None).cast("string")
    for key, value in reversed(list(pairs.items())):
        found = F.when(column == key, value).otherwise(found)
    return found


def _stable_id(given: Column, payload: Column) -> Column:
    """The vendor's id, or a hash of the payload, so that a repeated run gives the same id."""
    return F.coalesce(given, F.sha2(payload, 256))


def _metadata(source: str, original: Column) -> Column:
    return F.create_map(
        F.lit("source"), F.lit(source), F.lit("schema_version"), F.lit("1.0"), F.lit("original_type"), original
    )


def _shaped(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    return df.select(*[columns[f.name].cast(f.dataType).alias(f.name) for f in schemas.NORMALISED_EVENT.fields])


def _text(call: Column, path: str) -> Column:
    return F.try_variant_get(call, path, "string")


def _value(call: Column, *paths: str, default: str) -> Column:
    """The first of the paths that is there, as the JSON value it is; a null is a value."""
    return F.coalesce(*[F.try_variant_get(call, path, "variant") for path in paths], F.parse_json(F.lit(default)))


def _parsed(calls: DataFrame, value: str, wanted: Column | None = None) -> DataFrame:
    """Add `_text` and `e`, the value of a call if wanted, NULL where there is none.

    One explode of a one-element array: what is asked of `e` later is not pushed below it, so that a call is read once.
    """
    read = F.try_parse_json(value) if wanted is None else F.when(wanted, F.try_parse_json(value))
    return calls.select("*", F.col(value).alias("_text"), F.explode(F.array(read)).alias("e"))


def normalize_segment(calls: DataFrame, received_at: Column, value: str = "value") -> DataFrame:
    """One event per call."""
    return _segment_events(_parsed(calls, value).where(F.col("e").isNotNull()), received_at)


def _segment_events(raw: DataFrame, received_at: Column) -> DataFrame:
    e = F.col("e")
    kind = F.coalesce(_text(e, "$.type"), F.lit("track"))
    event_type = F.when(kind == "track", F.coalesce(_text(e, "$.event"), F.lit(DEFAULT_TYPE))).otherwise(
        F.coalesce(_lookup(kind, SEGMENT_TYPES), F.lit(DEFAULT_TYPE))
    )
    return _shaped(raw, {
        "event_id": _stable_id(_text(e, "$.messageId"), F.col("_text")),
        "customer_id": F.coalesce(present(_text(e, "$.userId")), _text(e, "$.anonymousId"), F.lit("anonymous")),
        "event_type": event_type,
        "timestamp": F.coalesce(_text(e, "$.timestamp"), F.date_format(received_at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")),
        "device": F.coalesce(_text(e, "$.context.device.type"), F.lit("unknown")),
        "session_id": _text(e, "$.context.sessionId"),
        "session_duration": _value(e, "$.properties.session_duration", default="0"),
        "transaction_amount": _value(e, "$.properties.revenue", "$.properties.transaction_amount", default="0.0"),
        "feature_flags": _value(e, "$.properties.feature_flags", default="{}"),
        "cohort": _text(e, "$.context.traits.cohort"),
        "plan": _text(e, "$.context.traits.plan"),
        "customer_state": F.lit(None),
        "metadata": _metadata("segment", kind),
    })


def normalize_amplitude(calls: DataFrame, value: str = "value") -> DataFrame:
    """One event per element of a call's batch."""
    return _amplitude_events(calls.select(F.col(value).alias("_text"), F.try_parse_json(value).alias("e")))


def _amplitude_events(read: DataFrame) -> DataFrame:
    raw = read.select("_text", F.posexplode(F.try_variant_get("e", "$.events", "array<variant>")).alias("_pos", "e"))
    e = F.col("e")
    named = F.replace(F.lower(F.coalesce(_text(e, "$.event_type"), F.lit(DEFAULT_TYPE))), F.lit(" "), F.lit("_"))
    moment = F.timestamp_millis(F.coalesce(F.try_variant_get(e, "$.time", "bigint"), F.lit(0)))
    return _shaped(raw, {
        "event_id": _stable_id(_text(e, "$.event_id"), F.concat_ws("#", "_text", "_pos")),
        "customer_id": F.coalesce(present(_text(e, "$.user_id")), _text(e, "$.device_id"), F.lit("anonymous")),
        "event_type": F.coalesce(_lookup(named, AMPLITUDE_ALIASES), named),
        "timestamp": F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"),
        "device": F.lower(F.coalesce(_text(e, "$.platform"), F.lit("unknown"))),
        "session_id": _text(e, "$.session_id"),
        "session_duration": _value(e, "$.event_properties.session_duration", default="0"),
        "transaction_amount": _value(e, "$.event_properties.revenue", default="0.0"),
        "feature_flags": _value(e, "$.event_properties.feature_flags", default="{}"),
        "cohort": _text(e, "$.user_properties.cohort"),
        "plan": _text(e, "$.user_properties.plan"),
        "customer_state": F.lit(None),
        "metadata": _metadata("amplitude", _text(e, "$.event_type")),
    })


def _is_object(text: Column) -> Column:
    """Of text that is JSON: whether it is an object; blanks are those of JSON."""
    return F.ltrim(text, F.lit(" \t\n\r")).startswith("{")


def dispatch(calls: DataFrame, received_at: Column, source: str = "source", value: str = "value") -> tuple[DataFrame, DataFrame]:
    """(events, rejected): each call normalised by its source; other sources and unreadable bodies are rejected."""
    known = F.coalesce(F.col(source).isin("segment", "amplitude"), F.lit(False))
    judged = _parsed(calls, value, known).withColumn("_ok", F.coalesce(F.col("e").isNotNull() & _is_object(F.col("_text")), F.lit(False)))
    good = judged.where(known & F.col("_ok"))
    events = _segment_events(good.where(F.col(source) == "segment"), received_at).unionByName(
        _amplitude_events(good.where(F.col(source) == "amplitude"))
    )
    reason = F.when(~known, "unknown_source").otherwise("invalid_json")
    rejected = judged.where(~known | ~F.col("_ok")).select(
        reason.alias("error_type"), reason.alias("reason"), F.col(value).alias("original"), F.to_date(received_at).alias("date")
    )
    return events, rejected


def as_wire(events: DataFrame) -> DataFrame:
    """Normalised events as wire text, so that they take the same route as all others."""
    return events.select(F.to_json(F.struct(*[f.name for f in schemas.NORMALISED_EVENT.fields])).alias("value"))
