"""Checks of feature snapshots and of the data flow.

Each check is one row: check, column, severity, metric, threshold, passed, message. All metrics of
a frame come from one aggregation pass; the thresholds are applied to the single result row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from ..constants import CUSTOMER, LABEL, NUMERIC_FEATURES, REQUIRED_COLUMNS
from ..functions.scalars import seconds_between

FAILURE, WARNING = "failure", "warning"


class Check(NamedTuple):
    """A number of the metrics row and what it must satisfy."""

    name: str
    column: str
    severity: str
    metric: Column
    op: str
    threshold: float | None
    complaint: str
    # Whether a number that could not be computed is acceptable.
    null_passes: bool = True


_HOLDS = {
    ">=": lambda m, t: m >= t, "<=": lambda m, t: m <= t, ">": lambda m, t: m > t, "!=": lambda m, t: m != t,
}


def as_rows(single: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Judge a one-row frame: one row per check. The numbers become rows first, so one expression judges them all."""

    def listed(values, kind: str) -> Column:
        return F.array(*[F.lit(v).cast(kind) for v in values])

    arrays = single.select(
        listed([c.name for c in checks], "string").alias("check"), listed([c.column for c in checks], "string").alias("column"),
        listed([c.severity for c in checks], "string").alias("severity"),
        F.array(*[c.metric.cast("double") for c in checks]).alias("metric"),
        listed([c.threshold for c in checks], "double").alias("threshold"), listed([c.op for c in checks], "string").alias("op"),
        listed([c.complaint for c in checks], "string").alias("complaint"),
        listed([c.null_passes for c in checks], "boolean").alias("null_passes"),
    )
    rows = arrays.select(F.explode(F.arrays_zip(*arrays.columns)).alias("c")).select("c.*")
    holds = None
    for op, compare in _HOLDS.items():
        branch = compare(F.col("metric"), F.col("threshold"))
        holds = F.when(F.col("op") == op, branch) if holds is None else holds.when(F.col("op") == op, branch)
    number = F.coalesce(F.round("metric", 3).cast("string"), F.lit("unknown"))
    message = F.concat_ws(" ", F.concat("complaint", F.lit(":")), number, F.lit("is not"), "op", F.col("threshold").cast("string"))
    return rows.withColumn("passed", F.coalesce(holds, F.col("null_passes"))).select(
        "check", "column", "severity", "metric", "threshold", "passed", F.when(~F.col("passed"), message).alias("message")
    )


def _present(features: DataFrame, names: Sequence[str]) -> list[str]:
    return [c for c in names if c in features.columns]


def metrics(features: DataFrame, as_of: Column, columns: Sequence[str] = tuple(NUMERIC_FEATURES)) -> DataFrame:
    """Every number the suite needs in one row: one pass for all columns, one over the customers."""
    wanted = [F.count(F.lit(1)).alias("n")]
    if "snapshot_date" in features.columns:
        newest = F.max(F.col("snapshot_date").cast("timestamp"))
        wanted.append((seconds_between(newest, as_of) / 3600).alias("age_h"))
    if LABEL in features.columns:
        wanted += [F.coalesce(F.sum(LABEL), F.lit(0)).alias("churned"), F.avg(F.col(LABEL).cast("double")).alias("rate")]
    for c in _present(features, columns):
        value = F.col(c).cast("double")
        wanted += [F.avg(value.isNull().cast("double")).alias(f"null_{c}"), F.stddev_samp(value).alias(f"std_{c}")]
    single = features.agg(*wanted)
    if CUSTOMER in features.columns:
        # On its own: beside the others, Spark would shuffle all their states once per customer.
        single = single.withColumn("customers", features.agg(F.count_distinct(CUSTOMER)).scalar())
    return single


def schema_check(features: DataFrame) -> Check:
    """Decided by the schema alone."""
    missing = [c for c in REQUIRED_COLUMNS if c not in features.columns]
    return Check("schema", "", FAILURE, F.lit(len(missing)), "<=", 0, f"Missing columns [{', '.join(missing)}]")


def freshness_check(features: DataFrame, max_age_h: float) -> Check:
    age = F.col("age_h") if "snapshot_date" in features.columns else F.lit(None)
    return Check("freshness", "snapshot_date", FAILURE, age, "<=", max_age_h, "Hours since the latest snapshot", False)


def volume_checks(features: DataFrame, min_rows: int) -> list[Check]:
    n = F.col("n")
    churned = F.col("churned") if LABEL in features.columns else F.lit(0)
    counts = [("total", n, min_rows), ("churned", churned, min_rows // 2), ("active", n - churned, min_rows)]
    return [Check("volume", name, FAILURE, count, ">=", least, f"Number of {name} rows") for name, count, least in counts]


def target_checks(features: DataFrame, low: float, high: float) -> list[Check]:
    if LABEL not in features.columns:
        return [Check("target", LABEL, FAILURE, F.lit(None), ">=", None, "Churn rate", False)]
    return [
        Check("target_low", LABEL, FAILURE, F.col("rate"), ">=", low, "Churn rate"),
        Check("target_high", LABEL, FAILURE, F.col("rate"), "<=", high, "Churn rate"),
    ]


def null_checks(features: DataFrame, max_rate: float, columns: Sequence[str] = tuple(NUMERIC_FEATURES)) -> list[Check]:
    return [
        Check("null_rate", c, FAILURE, F.col(f"null_{c}"), "<=", max_rate, f"NULL rate of {c}") for c in _present(features, columns)
    ]


def variance_checks(features: DataFrame, columns: Sequence[str] = tuple(NUMERIC_FEATURES)) -> list[Check]:
    """A single row has no sample deviation and is not flagged."""
    return [Check("zero_variance", c, WARNING, F.col(f"std_{c}"), "!=", 0, f"Deviation of {c}") for c in _present(features, columns)]


def duplicate_check(max_share: float = 0.01) -> Check:
    """Rows beyond the distinct customers; a NULL customer counts as one of them."""
    share = F.try_divide(F.col("n") - F.col("customers"), F.col("n"))
    return Check("duplicates", CUSTOMER, FAILURE, share, "<=", max_share, "Share of duplicate customers")


def validate(
    features: DataFrame, as_of: Column, min_rows: int = 1000, max_null_rate: float = 0.5, min_churn: float = 0.03,
    max_churn: float = 0.30, max_age_h: float = 48,
) -> DataFrame:
    """The whole suite; the snapshot is fit for training when no row of severity failure failed."""
    checks = [
        schema_check(features),
        freshness_check(features, max_age_h),
        *volume_checks(features, min_rows),
        *target_checks(features, min_churn, max_churn),
        *null_checks(features, max_null_rate),
        *variance_checks(features),
    ]
    if CUSTOMER in features.columns:
        checks.append(duplicate_check())
    return as_rows(metrics(features, as_of), checks)


def verdict(checks: DataFrame) -> DataFrame:
    """One row: did everything of severity failure pass, and how many did not."""
    failed = (F.col("severity") == FAILURE) & ~F.col("passed")
    warned = (F.col("severity") == WARNING) & ~F.col("passed")
    return checks.agg(
        (F.count_if(failed) == 0).alias("passed"), F.count_if(failed).alias("failures"), F.count_if(warned).alias("warnings"),
        F.count(F.lit(1)).alias("evaluated"),
    )


# Expectations: (kind, column, arguments)
DEFAULT_EXPECTATIONS = [
    ("not_null", "customer_id", {}),
    ("unique", "customer_id", {}),
    ("in_set", "is_churned", {"values": [0, 1]}),
    ("between", "days_since_last_login", {"low": 0, "high": 1000}),
]


def _violates(kind: str, column: str, args: Mapping) -> Column:
    """Rows that break a row-wise expectation; NULL satisfies all but not_null."""
    value = F.col(column)
    if kind == "not_null":
        return value.isNull()
    if kind == "in_set":
        return ~value.isin(args["values"])
    if kind == "between":
        return ~value.between(args["low"], args["high"])
    raise ValueError(f"unknown expectation {kind}")


def expectations(df: DataFrame, suite: Sequence[tuple[str, str, Mapping]] = tuple(DEFAULT_EXPECTATIONS)) -> DataFrame:
    """One row per expectation with the number of unexpected rows.

    Row-wise expectations share one pass. Uniqueness counts rows per value first, so a value
    with very many copies is reduced before the shuffle.
    """
    row_wise = [(kind, column, args) for kind, column, args in suite if kind != "unique"]
    counted = df.agg(F.lit(0).alias("_"), *[F.count_if(_violates(*e)).alias(f"u{i}") for i, e in enumerate(row_wise)])
    parts = [as_rows_of_expectations(counted, row_wise)] if row_wise else []
    for kind, column, _ in suite:
        if kind == "unique":
            copies = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
            parts.append(copies.agg(F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("u")).select(
                F.lit("unique").alias("expectation"), F.lit(column).alias("column"), F.col("u").alias("unexpected"),
                (F.col("u") == 0).alias("passed")))
    return reduce(DataFrame.unionByName, parts)


def as_rows_of_expectations(counted: DataFrame, suite: Sequence[tuple]) -> DataFrame:
    rows = [
        F.struct(
            F.lit(kind).alias("expectation"), F.lit(column).alias("column"), F.col(f"u{i}").alias("unexpected"),
            (F.col(f"u{i}") == 0).alias("passed"),
        )
        for i, (kind, column, _) in enumerate(suite)
    ]
    return counted.select(F.explode(F.array(*rows)).alias("e")).select("e.*")


def expectation_summary(results: DataFrame) -> DataFrame:
    return results.agg(
        F.bool_and("passed").alias("success"), F.count(F.lit(1)).alias("evaluated"), F.count_if("passed").alias("successful")
    )


def raw_freshness(raw: DataFrame, now: Column, max_hours: float = 2, ingested: str = "_ingest_timestamp") -> DataFrame:
    """Is the newest raw record recent enough; an empty table is an issue too."""
    newest = raw.agg(F.max(ingested).alias("newest"))
    age = seconds_between(F.col("newest"), now) / 3600
    return as_rows(newest, [Check("raw_freshness", ingested, FAILURE, age, "<=", max_hours, "Hours since the newest raw record", False)])


def arrival_health(
    raw: DataFrame, now: Column, minutes: int = 15, max_lag_s: float = 300, event: str = "timestamp",
    ingested: str = "_ingest_timestamp",
) -> DataFrame:
    """Did records arrive in the last minutes, and how far do they lag behind their event time."""
    recent = raw.where(F.col(ingested).between(now - F.make_dt_interval(mins=F.lit(minutes)), now))
    single = recent.agg(
        F.count(F.lit(1)).alias("records"), F.coalesce(F.max(seconds_between(F.col(event), F.col(ingested))), F.lit(0.0)).alias("lag")
    )
    return as_rows(single, [
        Check("records_arriving", ingested, FAILURE, F.col("records"), ">", 0, f"Records of the last {minutes} minutes"),
        Check("arrival_lag", ingested, FAILURE, F.col("lag"), "<=", max_lag_s, "Seconds records lag behind"),
    ])


def health_report(checks: Sequence[DataFrame]) -> DataFrame:
    """All issues of several checks in one list with the overall state on each row."""
    together = reduce(DataFrame.unionByName, checks)
    issues = together.where(~F.col("passed"))
    summary = together.agg(F.count_if(~F.col("passed")).alias("issues"), F.count(F.lit(1)).alias("checks"))
    return summary.select("checks", "issues", (F.col("issues") == 0).alias("healthy"),
                          F.coalesce(issues.agg(F.array_join(F.array_sort(F.collect_list("check")), ",")).scalar(), F.lit("")).alias("failed"))
