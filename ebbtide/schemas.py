"""Schemas at each layer boundary."""

from __future__ import annotations

from pyspark.sql import types as T

STR, INT, LONG, DBL, TS, BOOL = (
    T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.TimestampType(), T.BooleanType(),
)
# A JSON value of whatever type it has.
ANY = T.VariantType()


def struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


FLAGS = T.MapType(STR, BOOL)

RAW_EVENT = struct(
    ("event_id", STR), ("customer_id", STR), ("event_type", STR), ("timestamp", TS),
    ("device", STR), ("session_id", STR), ("session_duration", INT), ("transaction_amount", DBL),
    ("feature_flags", STR), ("cohort", STR), ("plan", STR), ("customer_state", STR),
    ("year", INT), ("month", INT), ("day", INT), ("hour", INT),
    ("_ingest_timestamp", TS), ("_schema_version", STR),
)

CURATED_EVENT = struct(
    ("event_id", STR), ("customer_id", STR), ("event_type", STR), ("event_timestamp", TS),
    ("device", STR), ("session_id", STR), ("session_duration", INT), ("transaction_amount", DBL),
    ("feature_flags", FLAGS), ("cohort", STR), ("plan", STR), ("customer_state", STR),
    ("event_year", INT), ("event_month", INT), ("event_day", INT), ("event_hour", INT),
    ("_etl_timestamp", TS), ("_etl_job", STR),
)

# One normalised webhook event, before it is routed like any other wire event. Amounts, durations and flags keep the JSON
# type they came with: routing converts or rejects them.
NORMALISED_EVENT = struct(
    ("event_id", STR), ("customer_id", STR), ("event_type", STR), ("timestamp", STR),
    ("device", STR), ("session_id", STR), ("session_duration", ANY), ("transaction_amount", ANY),
    ("feature_flags", ANY), ("cohort", STR), ("plan", STR), ("customer_state", STR),
    ("metadata", T.MapType(STR, STR)),
)

CAPTURE_LINE = struct(
    ("inferenceId", STR),
    ("eventMetadata", struct(("inferenceTime", STR), ("customAttributes", struct(("customer_id", STR))))),
    ("captureData", struct(("endpointOutput", struct(("data", STR), ("body", STR))))),
)
CAPTURE_OUTPUT = struct(("churn_probability", DBL), ("churn_prediction", STR))

CAPTURED_PREDICTION = struct(
    ("inference_id", STR), ("customer_id", STR), ("churn_probability", DBL), ("churn_prediction", INT),
    ("inference_timestamp", TS),
)
OUTCOME = struct(("customer_id", STR), ("churned", BOOL), ("outcome_date", TS))
MERGED_LABEL = struct(("inference_id", STR), ("prediction", INT), ("label", INT), ("probability", DBL))

DRIFT_SUMMARY = struct(
    ("timestamp", TS), ("schedule", STR), ("monitoring_type", STR), ("violation_count", LONG),
    ("drift_score", DBL), ("critical_features", T.ArrayType(STR)), ("retraining_triggered", BOOL),
    ("source_report_uri", STR),
)
