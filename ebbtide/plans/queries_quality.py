"""Validation, profiles, drift, labels and model quality."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..constants import HIGH_IMPORTANCE_FEATURES, NUMERIC_FEATURES
from ..operators import asof as J, drift as D, evaluate as E, labels as B, profile as P, selection as L, validate as V
from ..session import cut_lineage, scratch_dir
from ..sinks import writers as W
from . import adapter as A, jobs
from .adapter import CURATED_SQL, RAW_SQL, r, with_sql
from .queries_features import FEATURES_SQL, stored_features as features
from .registry import query

NOW = "2024-02-03 00:00:00"
LIMITS = {"min_rows": 100, "max_null_rate": 0.5, "min_churn": 0.03, "max_churn": 0.30, "max_age_h": 48}


def _now():
    return F.lit(NOW).cast("timestamp")


def _check_sql(name, column, severity, metric, threshold, passed):
    return (f"SELECT '{name}' AS \"check\", '{column}' AS \"column\", '{severity}' AS severity, {r(metric, 'metric')}, "
            f"CAST({threshold} AS DOUBLE) AS threshold, {passed} AS passed FROM features")


def _suite_sql():
    least, half = LIMITS["min_rows"], LIMITS["min_rows"] // 2
    age = f"date_diff('hour', max(CAST(snapshot_date AS TIMESTAMP)), TIMESTAMP '{NOW}')"
    parts = [
        _check_sql("schema", "", "failure", "max(0)", 0, "TRUE"),
        _check_sql("freshness", "snapshot_date", "failure", age, 48, f"{age} <= 48"),
        _check_sql("volume", "total", "failure", "count(*)", least, f"count(*) >= {least}"),
        _check_sql("volume", "churned", "failure", "sum(is_churned)", half, f"sum(is_churned) >= {half}"),
        _check_sql("volume", "active", "failure", "count(*) - sum(is_churned)", least, f"count(*) - sum(is_churned) >= {least}"),
        _check_sql("target_low", "is_churned", "failure", "avg(is_churned)", 0.03, "avg(is_churned) >= 0.03"),
        _check_sql("target_high", "is_churned", "failure", "avg(is_churned)", 0.3, "avg(is_churned) <= 0.3"),
        _check_sql("duplicates", "customer_id", "failure", "(count(*) - count(DISTINCT customer_id)) / count(*)", 0.01,
                   "count(*) - count(DISTINCT customer_id) <= count(*) * 0.01"),
    ]
    for c in NUMERIC_FEATURES:
        rate = f"avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END)"
        parts.append(_check_sql("null_rate", c, "failure", rate, 0.5, f"{rate} <= 0.5"))
        parts.append(_check_sql("zero_variance", c, "warning", f"stddev_samp({c})", 0, f"coalesce(stddev_samp({c}) <> 0, TRUE)"))
    return "\nUNION ALL ".join(parts)


SUITE = _suite_sql()


def _suite(spark, sf):
    return V.validate(features(spark, sf), _now(), **LIMITS).drop("message")


def _part(*names):
    listed = ", ".join(f"'{n}'" for n in names)
    return with_sql(FEATURES_SQL, f'SELECT * FROM ({SUITE}) WHERE "check" IN ({listed})')


@query("val0_suite", with_sql(FEATURES_SQL, SUITE))
def _(spark, sf):
    return _suite(spark, sf)


@query("val0_verdict", with_sql(FEATURES_SQL, f"""
SELECT count(*) FILTER (WHERE severity = 'failure' AND NOT passed) = 0 AS passed,
       count(*) FILTER (WHERE severity = 'failure' AND NOT passed) AS failures,
       count(*) FILTER (WHERE severity = 'warning' AND NOT passed) AS warnings, count(*) AS evaluated FROM ({SUITE})"""))
def _(spark, sf):
    return V.verdict(_suite(spark, sf))


def _single(checks):
    def run(spark, sf):
        frame = features(spark, sf)
        return V.as_rows(V.metrics(frame, _now()), checks(frame)).drop("message")

    return run


query("val2_freshness", _part("freshness"))(_single(lambda f: [V.freshness_check(f, 48)]))
query("val3_volume", _part("volume"))(_single(lambda f: V.volume_checks(f, 100)))
query("val4_target_rate", _part("target_low", "target_high"))(_single(lambda f: V.target_checks(f, 0.03, 0.30)))
query("val5_null_rates", _part("null_rate"))(_single(lambda f: V.null_checks(f, 0.5)))
query("val6_zero_variance", _part("zero_variance"))(_single(V.variance_checks))
query("val7_duplicates", _part("duplicates"))(_single(lambda f: [V.duplicate_check()]))

EXPECTED = [
    ("not_null", "customer_id", {}), ("unique", "event_id", {}), ("in_set", "customer_state", {"values": ["healthy", "at_risk"]}),
    ("between", "session_duration", {"low": 0, "high": 86400}),
]


@query("val8_expectations", with_sql(RAW_SQL, """
SELECT 'not_null' AS expectation, 'customer_id' AS "column", count(*) FILTER (WHERE customer_id IS NULL) AS unexpected, count(*) FILTER (WHERE customer_id IS NULL) = 0 AS passed FROM raw
UNION ALL SELECT 'unique', 'event_id', CAST(sum(n) AS BIGINT), FALSE FROM (SELECT count(*) AS n FROM raw GROUP BY event_id HAVING count(*) > 1)
UNION ALL SELECT 'in_set', 'customer_state', count(*), FALSE FROM raw WHERE customer_state NOT IN ('healthy', 'at_risk')
UNION ALL SELECT 'between', 'session_duration', count(*), FALSE FROM raw WHERE session_duration NOT BETWEEN 0 AND 86400"""))
def _(spark, sf):
    return V.expectations(A.raw_events(spark, sf), EXPECTED)


@query("val8_expectation_summary", with_sql(FEATURES_SQL, """
SELECT count(customer_id) = count(*) AND count(DISTINCT customer_id) = count(*)
       AND bool_and(is_churned IN (0, 1)) AND bool_and(days_since_last_login BETWEEN 0 AND 1000) AS success,
       CAST(4 AS BIGINT) AS evaluated,
       CAST((count(customer_id) = count(*))::INT + (count(DISTINCT customer_id) = count(*))::INT
       + bool_and(is_churned IN (0, 1))::INT + bool_and(days_since_last_login BETWEEN 0 AND 1000)::INT AS BIGINT) AS successful
FROM features"""))
def _(spark, sf):
    return V.expectation_summary(V.expectations(features(spark, sf)))


def _raw_with_time(spark, sf):
    return A.raw_events(spark, sf).withColumn("timestamp", F.try_to_timestamp("timestamp"))


RAW_NOW = "2024-01-31 01:30:00"
RAW_CHECKS = f"""
SELECT 'raw_freshness' AS "check", '_ingest_timestamp' AS "column", 'failure' AS severity,
       {r(f"(epoch_us(TIMESTAMP '{RAW_NOW}') - epoch_us(max(_ingest_timestamp))) / 3600e6", "metric")},
       CAST(2 AS DOUBLE) AS threshold, (epoch_us(TIMESTAMP '{RAW_NOW}') - epoch_us(max(_ingest_timestamp))) / 3600e6 <= 2 AS passed FROM raw"""
ARRIVAL_NOW = "2024-01-16 00:00:00"
ARRIVAL_CHECKS = f"""
SELECT 'records_arriving' AS "check", '_ingest_timestamp' AS "column", 'failure' AS severity, CAST(count(*) AS DOUBLE) AS metric,
       CAST(0 AS DOUBLE) AS threshold, count(*) > 0 AS passed
FROM raw WHERE _ingest_timestamp BETWEEN TIMESTAMP '{ARRIVAL_NOW}' - INTERVAL 60 MINUTE AND TIMESTAMP '{ARRIVAL_NOW}'
UNION ALL
SELECT 'arrival_lag', '_ingest_timestamp', 'failure', {r("coalesce(max((epoch_us(_ingest_timestamp) - epoch_us(event_time)) / 1e6), 0)", "metric")},
       CAST(90 AS DOUBLE), coalesce(max((epoch_us(_ingest_timestamp) - epoch_us(event_time)) / 1e6), 0) <= 90
FROM raw WHERE _ingest_timestamp BETWEEN TIMESTAMP '{ARRIVAL_NOW}' - INTERVAL 60 MINUTE AND TIMESTAMP '{ARRIVAL_NOW}'"""


def _flow_checks(spark, sf):
    raw = _raw_with_time(spark, sf)
    return [
        V.raw_freshness(raw, F.lit(RAW_NOW).cast("timestamp")),
        V.arrival_health(raw, F.lit(ARRIVAL_NOW).cast("timestamp"), minutes=60, max_lag_s=90),
    ]


@query("val9_health_report", with_sql(RAW_SQL, f"""
SELECT count(*) AS checks, count(*) FILTER (WHERE NOT passed) AS issues, bool_and(passed) AS healthy,
       coalesce(string_agg("check", ',' ORDER BY "check") FILTER (WHERE NOT passed), '') AS failed
FROM ({RAW_CHECKS} UNION ALL {ARRIVAL_CHECKS})"""))
def _(spark, sf):
    return V.health_report(_flow_checks(spark, sf))


@query("val10_raw_freshness", with_sql(RAW_SQL, RAW_CHECKS))
def _(spark, sf):
    return _flow_checks(spark, sf)[0].drop("message")


@query("val11_arrival_health", with_sql(RAW_SQL, ARRIVAL_CHECKS))
def _(spark, sf):
    return _flow_checks(spark, sf)[1].drop("message")


PROFILED = ["session_duration", "transaction_amount", "device", "plan"]


def _profile_sql(source: str, columns: dict[str, str], extra: str = "") -> str:
    """Profile rows; `columns` maps a column to its inferred type."""
    parts = []
    for c, kind in columns.items():
        v = "CAST(NULL AS DOUBLE)" if kind == "String" else c
        parts.append(
            f"SELECT '{c}' AS feature, '{kind}' AS inferred_type, count(*) AS row_count, count({c}) AS num_present, "
            f"CAST(count({c}) AS DOUBLE) / count(*) AS completeness, avg({v}) AS mean, stddev_samp({v}) AS std_dev, "
            f"CAST(min({v}) AS DOUBLE) AS min, CAST(max({v}) AS DOUBLE) AS max FROM {source} {extra}")
    return " UNION ALL ".join(parts)


RAW_KINDS = {"session_duration": "Integral", "transaction_amount": "Fractional", "device": "String", "plan": "String"}
PROFILE_COLUMNS = "feature, inferred_type, row_count, num_present, " + ", ".join(
    r(c, c) for c in ("completeness", "mean", "std_dev", "min", "max"))


@query("prf1_profile", with_sql(RAW_SQL, f"SELECT {PROFILE_COLUMNS} FROM ({_profile_sql('raw', RAW_KINDS)})"))
def _(spark, sf):
    return P.profile(A.raw_events(spark, sf), PROFILED)


@query("prf1_categories", with_sql(RAW_SQL, f"""
SELECT feature, category, n AS "count", {r("n / sum(n) OVER (PARTITION BY feature)", "share")} FROM (
  SELECT 'device' AS feature, device AS category, count(*) AS n FROM raw GROUP BY ALL
  UNION ALL SELECT 'customer_id', customer_id, count(*) FROM raw GROUP BY ALL)"""))
def _(spark, sf):
    return P.categories(A.raw_events(spark, sf), ["device", "customer_id"])


@query("prf1_histogram", with_sql(CURATED_SQL, f"""
SELECT feature, bin, {r("lo + (hi - lo) * bin / 10", "lower")}, {r("lo + (hi - lo) * (bin + 1) / 10", "upper")}, count(*) AS "count"
FROM (SELECT feature, lo, hi, CAST(least(greatest(floor((v - lo) / (hi - lo) * 10), 0), 9) AS INTEGER) AS bin
      FROM (SELECT 'session_duration' AS feature, CAST(session_duration AS DOUBLE) AS v FROM curated
            UNION ALL SELECT 'transaction_amount', transaction_amount FROM curated)
      JOIN (SELECT 'session_duration' AS feature, CAST(min(session_duration) AS DOUBLE) AS lo, CAST(max(session_duration) AS DOUBLE) AS hi FROM curated
            UNION ALL SELECT 'transaction_amount', min(transaction_amount), max(transaction_amount) FROM curated) USING (feature))
GROUP BY feature, bin, lo, hi"""))
def _(spark, sf):
    names = ["session_duration", "transaction_amount"]
    events = A.curated_events(spark, sf)
    return P.histogram(events, cut_lineage(P.profile(events, names), "profile"), names)


# The baseline is the clean table; live is the raw one, whose damage shows as violations.
BASE_KINDS = {"session_duration": "Integral", "transaction_amount": "Fractional", "customer_id": "String", "plan": "String"}
LIVE_KINDS = {"session_duration": "Integral", "transaction_amount": "Fractional", "customer_id": "String", "hour": "Integral"}
DRIFT_SQL = RAW_SQL + f""",
base_profile AS ({_profile_sql("curated", BASE_KINDS)}),
live_rows AS (SELECT *, CAST(hour(sent_at) AS INTEGER) AS hour FROM raw),
live_profile AS ({_profile_sql("live_rows", LIVE_KINDS)}),
violations AS (
  SELECT coalesce(b.feature, l.feature) AS feature_name, unnest(list_filter([
      CASE WHEN l.feature IS NULL THEN 'missing_column_check' END, CASE WHEN b.feature IS NULL THEN 'extra_column_check' END,
      CASE WHEN l.inferred_type <> b.inferred_type THEN 'data_type_check' END,
      CASE WHEN l.completeness < CASE WHEN b.completeness = 0 THEN 0.95 ELSE least(b.completeness, 0.95) END THEN 'completeness_check' END,
      CASE WHEN b.min >= 0 AND l.min < 0 THEN 'non_negative_check' END,
      CASE WHEN b.inferred_type = 'Fractional' AND abs(l.mean - b.mean) > 3 * b.std_dev THEN 'baseline_drift_check' END
    ], lambda x: x IS NOT NULL)) AS constraint_check_type
  FROM base_profile b FULL JOIN live_profile l ON b.feature = l.feature
)"""


def _profiles(spark, sf):
    base = P.profile(A.curated_events(spark, sf), list(BASE_KINDS))
    return base, P.profile(A.raw_events(spark, sf), list(LIVE_KINDS))


def _violations(spark, sf):
    base, live = _profiles(spark, sf)
    return D.constraint_violations(live, P.suggest_constraints(base))


@query("prf2_constraints", with_sql(DRIFT_SQL, f"""
SELECT feature, inferred_type, {r("CASE WHEN completeness = 0 THEN 0.95 ELSE least(completeness, 0.95) END", "min_completeness")},
       coalesce(min >= 0, FALSE) AS non_negative,
       {r("CASE WHEN inferred_type = 'Fractional' THEN mean END", "mean")},
       {r("CASE WHEN inferred_type = 'Fractional' THEN std_dev END", "std_dev")} FROM base_profile"""))
def _(spark, sf):
    return P.suggest_constraints(_profiles(spark, sf)[0])


@query("prf3_schema_changes", with_sql(DRIFT_SQL, """
SELECT coalesce(b.feature, l.feature) AS feature, b.inferred_type AS old_type, l.inferred_type AS new_type,
       CASE WHEN b.feature IS NULL THEN 'added' WHEN l.feature IS NULL THEN 'removed' ELSE 'changed' END AS change
FROM base_profile b FULL JOIN live_profile l ON b.feature = l.feature
WHERE b.feature IS NULL OR l.feature IS NULL OR b.inferred_type <> l.inferred_type"""))
def _(spark, sf):
    return P.schema_changes(*_profiles(spark, sf))


# Distributions of the two halves of the clean table and of the raw one: numbers, categories, shares.
MOVED_NUMBERS, MOVED_TEXTS = ["session_duration", "transaction_amount"], ["plan", "customer_id"]
DISTRIBUTIONS_SQL = DRIFT_SQL + """,
numbers AS (
  SELECT feature, value, count(*) FILTER (WHERE live = 0) AS b, count(*) FILTER (WHERE live = 1) AS l FROM (
    SELECT 'session_duration' AS feature, CAST(session_duration AS DOUBLE) AS value, 0 AS live FROM curated
    UNION ALL SELECT 'transaction_amount', transaction_amount, 0 FROM curated
    UNION ALL SELECT 'session_duration', CAST(session_duration AS DOUBLE), 1 FROM raw
    UNION ALL SELECT 'transaction_amount', transaction_amount, 1 FROM raw) WHERE value IS NOT NULL GROUP BY feature, value
),
texts AS (
  SELECT feature, category, count(*) FILTER (WHERE live = 0) AS b, count(*) FILTER (WHERE live = 1) AS l FROM (
    SELECT 'plan' AS feature, plan AS category, 0 AS live FROM curated UNION ALL SELECT 'customer_id', customer_id, 0 FROM curated
    UNION ALL SELECT 'plan', plan, 1 FROM raw UNION ALL SELECT 'customer_id', customer_id, 1 FROM raw) GROUP BY feature, category
),
ks AS (
  SELECT feature, max(abs(cb / tb - cl / tl)) AS statistic, max(tb) * max(tl) / (max(tb) + max(tl)) AS e FROM (
    SELECT feature, value, CAST(sum(b) OVER (PARTITION BY feature ORDER BY value) AS DOUBLE) AS cb, CAST(sum(l) OVER (PARTITION BY feature ORDER BY value) AS DOUBLE) AS cl,
           CAST(sum(b) OVER (PARTITION BY feature) AS DOUBLE) AS tb, CAST(sum(l) OVER (PARTITION BY feature) AS DOUBLE) AS tl FROM numbers) GROUP BY feature
),
ks_p AS (
  SELECT feature, CASE WHEN lam < 0.2 THEN 1.0 ELSE least(greatest(2 * list_sum(list_transform(range(1, 101),
         lambda j: (CASE WHEN j % 2 = 1 THEN 1.0 ELSE -1.0 END) * exp(-2.0 * j * j * lam * lam))), 0), 1) END AS p
  FROM (SELECT feature, (sqrt(e) + 0.12 + 0.11 / sqrt(e)) * statistic AS lam FROM ks)
),
chi AS (
  SELECT feature, max(degrees) AS d, sum(pow(b - rt * tb / tt, 2) / (rt * tb / tt) + pow(l - rt * tl / tt, 2) / (rt * tl / tt)) AS statistic
  FROM (SELECT feature, b, l, CAST(b + l AS DOUBLE) AS rt, CAST(sum(b) OVER w AS DOUBLE) AS tb, CAST(sum(l) OVER w AS DOUBLE) AS tl,
               CAST(sum(b + l) OVER w AS DOUBLE) AS tt, count(*) OVER w - 1 AS degrees FROM texts WINDOW w AS (PARTITION BY feature)) GROUP BY feature
),
all_violations AS (
  SELECT feature_name, constraint_check_type FROM violations
  UNION ALL SELECT feature, 'numeric_distribution_check' FROM ks_p WHERE p < 0.05
  UNION ALL SELECT feature, 'categorical_distribution_check' FROM chi WHERE d > 0 AND 1 - list_sum(list_transform(range(0, 2000), lambda n: exp((d / 2.0 + n) * ln(statistic / 2) - statistic / 2 - lgamma(d / 2.0 + n + 1)))) < 0.05
  UNION ALL SELECT DISTINCT feature, 'categorical_share_check' FROM (
    SELECT feature, b / sum(b) OVER (PARTITION BY feature) AS bs, l / sum(l) OVER (PARTITION BY feature) AS ls FROM texts) WHERE abs(ls - bs) > 0.2 * bs
)"""


def _all_violations(spark, sf):
    base, live = A.curated_events(spark, sf), A.raw_events(spark, sf)
    moved = D.distribution_violations(
        P.value_counts(base, MOVED_NUMBERS), P.value_counts(live, MOVED_NUMBERS), P.category_counts(base, MOVED_TEXTS), P.category_counts(live, MOVED_TEXTS))
    return _violations(spark, sf).unionByName(moved)


@query("drf1_violations", with_sql(DISTRIBUTIONS_SQL, "SELECT * FROM all_violations"))
def _(spark, sf):
    return _all_violations(spark, sf)


@query("job_drift", with_sql(DISTRIBUTIONS_SQL, f"""
SELECT 'dev' AS environment, TIMESTAMP '{NOW}' AS timestamp, count(*) AS violation_count, {r(
    "least(sum(0.05 * (CASE WHEN feature_name = 'customer_id' THEN 3 ELSE 1 END) * (CASE WHEN constraint_check_type LIKE '%distribution%' OR constraint_check_type LIKE '%baseline%' THEN 1.5 ELSE 1 END)), 1.0)",
    "drift_score")},
       coalesce(string_agg(DISTINCT feature_name, ',' ORDER BY feature_name) FILTER (WHERE feature_name = 'customer_id'), '') AS critical_features
FROM all_violations"""))
def _(spark, sf):
    """The baseline is stored, live rows are checked against it twice for the same moment; one record is left."""
    path = scratch_dir(spark, "monitor")
    at = dt.datetime.fromisoformat(NOW)
    jobs.baseline(A.curated_events(spark, sf), list(BASE_KINDS), f"{path}/baseline", "7")
    for _ in range(2):
        jobs.drift(A.raw_events(spark, sf), list(LIVE_KINDS), f"{path}/baseline/7", f"{path}/summaries", "dev", "daily", at, ["customer_id"])
    schema = "timestamp timestamp, violation_count long, drift_score double, critical_features array<string>, environment string"
    return _flat(spark.read.schema(schema).json(f"{path}/summaries")).select(
        "environment", "timestamp", "violation_count", "drift_score", "critical_features")


@query("job_validate", with_sql(FEATURES_SQL, SUITE))
def _(spark, sf):
    """The suite recorded twice for the same moment; one set of results is left."""
    path = scratch_dir(spark, "validated")
    W.overwrite_partitions(features(spark, sf), f"{path}/features", ["snapshot_date"])
    for _ in range(2):
        jobs.validate(spark, f"{path}/features", f"{path}/checks", dt.datetime.fromisoformat(A.AS_OF), moment=dt.datetime.fromisoformat(NOW), **LIMITS)
    return spark.read.parquet(f"{path}/checks").select("check", "column", "severity", "metric", "threshold", "passed")


@query("jn6_baseline_vs_live", with_sql(DRIFT_SQL, f"""
SELECT coalesce(b.feature, l.feature) AS feature, {r("b.mean", "base_mean")}, {r("l.mean", "live_mean")},
       b.num_present AS base_present, l.num_present AS live_present
FROM base_profile b FULL JOIN live_profile l ON b.feature = l.feature"""))
def _(spark, sf):
    return P.baseline_vs_live(*_profiles(spark, sf))


HALVES = f"CASE WHEN event_timestamp < TIMESTAMP '{A.HALF_TIME}' THEN 0 ELSE 1 END AS live"


def _halves(spark, sf):
    events = A.curated_events(spark, sf)
    first = F.col("event_timestamp") < F.lit(A.HALF_TIME).cast("timestamp")
    return events.where(first), events.where(~first)


KS_SQL = f"""
SELECT feature, {r("max(abs(cb / tb - cl / tl))", "statistic")}, CAST(max(tb) AS BIGINT) AS n_base, CAST(max(tl) AS BIGINT) AS n_live
FROM (SELECT feature, value,
             CAST(sum(b) OVER (PARTITION BY feature ORDER BY value) AS DOUBLE) AS cb, CAST(sum(l) OVER (PARTITION BY feature ORDER BY value) AS DOUBLE) AS cl,
             CAST(sum(b) OVER (PARTITION BY feature) AS DOUBLE) AS tb, CAST(sum(l) OVER (PARTITION BY feature) AS DOUBLE) AS tl
      FROM (SELECT feature, value, count(*) FILTER (WHERE live = 0) AS b, count(*) FILTER (WHERE live = 1) AS l
            FROM (SELECT 'session_duration' AS feature, CAST(session_duration AS DOUBLE) AS value, {HALVES} FROM curated
                  UNION ALL SELECT 'transaction_amount', transaction_amount, {HALVES} FROM curated) GROUP BY feature, value))
GROUP BY feature"""


@query("drf2_ks_two_sample", with_sql(CURATED_SQL, KS_SQL))
def _(spark, sf):
    return D.ks_two_sample(*_halves(spark, sf), ["session_duration", "transaction_amount"]).drop("p_value", "drifted")


@query("drf2_ks_sketched", with_sql(CURATED_SQL, f"SELECT feature, n_base, n_live, TRUE AS within_error FROM ({KS_SQL})"))
def _(spark, sf):
    """The distance from two quantile sketches lies within its stated error of the exact one."""
    base, live = _halves(spark, sf)
    features = ["session_duration", "transaction_amount"]
    found = D.ks_of_sketches(P.value_sketches(base, features), P.value_sketches(live, features), P.SKETCH_K)
    exact = D.ks_two_sample(base, live, features).select("feature", F.col("statistic").alias("exact"))
    return found.join(exact, "feature").select("feature", "n_base", "n_live", (F.abs(F.col("statistic") - F.col("exact")) <= F.col("error")).alias("within_error"))


@query("drf2_ks_p_value", with_sql(CURATED_SQL, f"""
SELECT feature, {r('''CASE WHEN lam < 0.2 THEN 1.0 ELSE least(greatest(2 * list_sum(list_transform(range(1, 101),
       lambda j: (CASE WHEN j % 2 = 1 THEN 1.0 ELSE -1.0 END) * exp(-2.0 * j * j * lam * lam))), 0), 1) END''', "p_value", 5)}
FROM (SELECT feature, (sqrt(e) + 0.12 + 0.11 / sqrt(e)) * statistic AS lam
      FROM (SELECT feature, statistic, CAST(n_base AS DOUBLE) * n_live / (n_base + n_live) AS e
            FROM ({KS_SQL.replace(', 6)', ', 10)')}) ))"""))
def _(spark, sf):
    found = D.ks_two_sample(*_halves(spark, sf), ["session_duration", "transaction_amount"])
    return found.select("feature", F.round(F.col("p_value").cast("decimal(30,10)"), 5).cast("double").alias("p_value"))


CHI_SQL = f"""
SELECT feature, max(degrees) AS degrees, {r("sum(pow(b - rt * tb / tt, 2) / (rt * tb / tt) + pow(l - rt * tl / tt, 2) / (rt * tl / tt))", "statistic")}
FROM (SELECT feature, b, l, CAST(b + l AS DOUBLE) AS rt, CAST(sum(b) OVER w AS DOUBLE) AS tb, CAST(sum(l) OVER w AS DOUBLE) AS tl,
             CAST(sum(b + l) OVER w AS DOUBLE) AS tt, count(*) OVER w - 1 AS degrees
      FROM (SELECT feature, category, count(*) FILTER (WHERE live = 0) AS b, count(*) FILTER (WHERE live = 1) AS l
            FROM (SELECT 'device' AS feature, device AS category, {HALVES} FROM curated
                  UNION ALL SELECT 'event_type', event_type, {HALVES} FROM curated
                  UNION ALL SELECT 'plan', plan, {HALVES} FROM curated) GROUP BY ALL) WINDOW w AS (PARTITION BY feature))
GROUP BY feature"""


@query("drf3_chi_squared", with_sql(CURATED_SQL, CHI_SQL))
def _(spark, sf):
    return D.chi_squared(*_halves(spark, sf), ["device", "event_type", "plan"]).drop("p_value")


@query("drf3_p_value", with_sql(CURATED_SQL, f"""
SELECT feature, degrees, {r('''1 - list_sum(list_transform(range(0, 2000), lambda n: exp((degrees / 2.0 + n) * ln(statistic / 2) - statistic / 2 - lgamma(degrees / 2.0 + n + 1))))''', "p_value")}
FROM ({CHI_SQL.replace(', 6)', ', 12)')})"""))
def _(spark, sf):
    return D.chi_squared(*_halves(spark, sf), ["device", "event_type", "plan"]).drop("statistic")


@query("drf3_category_shift", with_sql(CURATED_SQL, f"""
SELECT category, {r("b / sum(b) OVER ()", "base_share")}, {r("l / sum(l) OVER ()", "live_share")},
       abs(l / sum(l) OVER () - b / sum(b) OVER ()) > 0.02 * (b / sum(b) OVER ()) AS violated
FROM (SELECT event_type AS category, count(*) FILTER (WHERE live = 0) AS b, count(*) FILTER (WHERE live = 1) AS l
      FROM (SELECT event_type, {HALVES} FROM curated) GROUP BY ALL)"""))
def _(spark, sf):
    return D.category_shift(*_halves(spark, sf), "event_type", tolerance=0.02)


# A log of violations: one per event, grouped by schedule and day.
PLAIN = ["login_count", "device_types", "cohort", "plan", "session_trend", "ticket_rate"]
CHECKS = ["completeness_check", "baseline_drift_check", "Categorical_Distribution_check", "data_type_check"]
NAMES = HIGH_IMPORTANCE_FEATURES + PLAIN
LOG_SQL = CURATED_SQL + f""",
log AS (
  SELECT 'sched_' || (user_id % 50) AS schedule, CASE id % 2 WHEN 0 THEN 'data_quality' ELSE 'model_quality' END AS monitoring_type, ts,
         date_trunc('hour', ts) AS hour, [{", ".join(f"'{n}'" for n in NAMES)}][k % {len(NAMES)} + 1] AS feature_name,
         [{", ".join(f"'{c}'" for c in CHECKS)}][id % 4 + 1] AS constraint_check_type
  FROM base
),
weighted AS (
  SELECT *, 0.05 * (CASE WHEN feature_name IN ({", ".join(f"'{n}'" for n in HIGH_IMPORTANCE_FEATURES)}) THEN 3 ELSE 1 END)
            * (CASE WHEN constraint_check_type ILIKE '%distribution%' OR constraint_check_type ILIKE '%baseline%' THEN 1.5 ELSE 1 END) AS w,
         feature_name IN ({", ".join(f"'{n}'" for n in HIGH_IMPORTANCE_FEATURES)}) AS critical
  FROM log
),
scores AS (
  SELECT schedule, hour, count(*) AS violation_count, least(sum(w), 1.0) AS drift_score,
         coalesce(array_to_string(list_sort(list_distinct(list(feature_name) FILTER (WHERE critical))), ','), '') AS critical_features,
         count(*) FILTER (WHERE constraint_check_type = 'completeness_check') AS completeness_count
  FROM weighted GROUP BY schedule, hour
)"""


def _log(spark, sf):
    base = A.events(spark, sf)
    names, checks = F.array(*[F.lit(n) for n in NAMES]), F.array(*[F.lit(c) for c in CHECKS])
    return base.select(
        F.concat(F.lit("sched_"), F.col("user_id") % 50).alias("schedule"),
        F.when(F.col("id") % 2 == 0, "data_quality").otherwise("model_quality").alias("monitoring_type"),
        "ts", F.date_trunc("hour", "ts").alias("hour"), F.get(names, F.col("k") % len(NAMES)).alias("feature_name"),
        F.get(checks, (F.col("id") % 4).cast("int")).alias("constraint_check_type"),
    )


def _scores(spark, sf):
    return D.drift_score(_log(spark, sf), HIGH_IMPORTANCE_FEATURES, by=["schedule", "hour"])


def _flat(scores):
    return scores.withColumn("critical_features", F.concat_ws(",", "critical_features"))


@query("drf4_drift_score", with_sql(LOG_SQL, f"""
SELECT schedule, hour, violation_count, {r("drift_score", "drift_score")}, critical_features FROM scores"""))
def _(spark, sf):
    return _flat(_scores(spark, sf))


RETRAIN = "(critical_features <> '' OR round(drift_score, 9) >= 0.3 OR violation_count >= 5)"


@query("drf5_retrain_decision", with_sql(LOG_SQL, f"SELECT schedule, hour, {RETRAIN} AS retrain FROM scores"))
def _(spark, sf):
    return D.with_decision(_scores(spark, sf)).select("schedule", "hour", "retrain")


@query("drf6_drift_class", with_sql(LOG_SQL, """
SELECT schedule, hour, CASE WHEN completeness_count >= 2 THEN 'data_issue'
  WHEN critical_features <> '' OR round(drift_score, 9) >= 0.3 THEN 'severe' WHEN round(drift_score, 9) >= 0.1 THEN 'minor' ELSE 'none' END AS drift_class
FROM scores"""))
def _(spark, sf):
    log = _log(spark, sf)
    gaps = log.groupBy("schedule", "hour").agg(F.count_if(F.col("constraint_check_type") == "completeness_check").alias("completeness_count"))
    scores = D.drift_score(log, HIGH_IMPORTANCE_FEATURES, by=["schedule", "hour"]).join(gaps, ["schedule", "hour"])
    return D.classify(scores, many=2).select("schedule", "hour", "drift_class")


@query("drf7_drift_alarms", with_sql(LOG_SQL, f"""
SELECT time_bucket(INTERVAL 6 HOUR, hour, TIMESTAMP '1970-01-01') AS period_start, monitoring_type, {r("max(s)", "max_score")}, max(n) AS max_violations,
       round(max(s), 9) > 0.3 AS score_alarm, monitoring_type = 'model_quality' AND max(n) > 3 AS violations_alarm
FROM (SELECT schedule, hour, monitoring_type, least(sum(w), 1.0) AS s, count(*) AS n FROM weighted GROUP BY schedule, hour, monitoring_type) GROUP BY 1, 2"""))
def _(spark, sf):
    summaries = D.drift_score(_log(spark, sf), HIGH_IMPORTANCE_FEATURES, by=["schedule", "hour", "monitoring_type"]).withColumnRenamed("hour", "timestamp")
    return D.drift_alarms(summaries)


@query("drf8_latest_execution", """
WITH executions AS (SELECT 'sched_' || (o_custkey % 50) AS schedule, o_orderkey AS execution_id, CAST(o_orderdate AS TIMESTAMP) AS created_at,
  CASE o_orderstatus WHEN 'F' THEN 'Failed' WHEN 'O' THEN 'Completed' ELSE 'CompletedWithViolations' END AS status FROM orders)
SELECT schedule, execution_id, created_at, status FROM (
  SELECT *, row_number() OVER (PARTITION BY schedule ORDER BY created_at DESC, execution_id DESC) AS rn FROM executions)
WHERE rn = 1 AND status <> 'Failed'""")
def _(spark, sf):
    o = A.table(spark, sf, "orders")
    status = F.when(F.col("o_orderstatus") == "F", "Failed").when(F.col("o_orderstatus") == "O", "Completed").otherwise("CompletedWithViolations")
    executions = o.select(
        F.concat(F.lit("sched_"), F.col("o_custkey") % 50).alias("schedule"), F.col("o_orderkey").alias("execution_id"),
        F.col("o_orderdate").cast("timestamp").alias("created_at"), status.alias("status"))
    return L.latest_complete_execution(executions)


MERGED_SQL = A.LABELS_SQL + f""",
merged AS (
  SELECT p.inference_id, p.churn_prediction AS prediction, CAST(o.churned AS INTEGER) AS label, p.churn_probability AS probability
  FROM (SELECT * FROM outcomes WHERE outcome_date BETWEEN TIMESTAMP '{A.AS_OF}' - INTERVAL 7 DAY AND TIMESTAMP '{A.AS_OF}') o
  ASOF JOIN (SELECT * FROM predictions WHERE inference_timestamp BETWEEN TIMESTAMP '{A.AS_OF}' - INTERVAL 97 DAY AND TIMESTAMP '{A.AS_OF}') p
  ON o.customer_id = p.customer_id AND o.outcome_date >= p.inference_timestamp
)"""


def _merged(spark, sf):
    return B.merged_labels(A.predictions(spark, sf), A.outcomes(spark, sf), A.as_of())


@query("jn2_predictions_outcomes", with_sql(A.LABELS_SQL, """
SELECT p.customer_id, p.inference_id, p.churn_prediction, o.churned, o.outcome_date FROM predictions p JOIN outcomes o ON p.customer_id = o.customer_id"""))
def _(spark, sf):
    return J.outcomes_joined(A.predictions(spark, sf), A.outcomes(spark, sf)).select(
        "customer_id", "inference_id", "churn_prediction", "churned", "outcome_date")


@query("jn3_asof_latest", with_sql(A.LABELS_SQL, """
SELECT o.customer_id, o.churned, o.outcome_date, p.inference_id, p.churn_prediction, p.inference_timestamp
FROM outcomes o ASOF JOIN predictions p ON o.customer_id = p.customer_id AND o.outcome_date >= p.inference_timestamp
WHERE p.inference_timestamp >= o.outcome_date - INTERVAL 2 DAY"""))
def _(spark, sf):
    found = J.asof_latest(A.predictions(spark, sf), A.outcomes(spark, sf), max_age_days=2)
    return found.select("customer_id", "churned", "outcome_date", "inference_id", "churn_prediction", "inference_timestamp")


@query("lbl1_merged_labels", with_sql(MERGED_SQL, f"SELECT inference_id, prediction, label, {r('probability', 'probability')} FROM merged"))
def _(spark, sf):
    return _merged(spark, sf)


@query("lbl2_merge_summary", with_sql(MERGED_SQL, f"""
SELECT count(*) AS merged_count, {r("avg(prediction)", "churn_rate_pred")}, {r("avg(label)", "churn_rate_actual")} FROM merged"""))
def _(spark, sf):
    return B.merge_summary(_merged(spark, sf))


AUC_OF_MERGED = """(SELECT sum(pos * (below + neg / 2)) / nullif(sum(pos) * sum(neg), 0) FROM (
  SELECT CAST(pos AS DOUBLE) AS pos, CAST(neg AS DOUBLE) AS neg, CAST(coalesce(sum(neg) OVER (ORDER BY probability ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) AS below
  FROM (SELECT probability, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg FROM merged GROUP BY probability)))"""


@query("mq1_model_quality", with_sql(MERGED_SQL, f"""
SELECT metric, {r("value", "value")}, minimum, coalesce(value < minimum, TRUE) AS violated FROM (
  SELECT unnest(['auc', 'precision', 'recall', 'f1', 'accuracy']) AS metric, unnest([0.82, 0.75, 0.70, 0.72, 0.30])::DOUBLE AS minimum,
         unnest([{AUC_OF_MERGED}, coalesce(tp / nullif(tp + fp, 0), 0), coalesce(tp / nullif(tp + fn, 0), 0), coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), (tp + tn) / (tp + tn + fp + fn)]) AS value
  FROM (SELECT CAST(count(*) FILTER (WHERE label = 1 AND prediction = 1) AS DOUBLE) AS tp, CAST(count(*) FILTER (WHERE label = 0 AND prediction = 1) AS DOUBLE) AS fp,
               CAST(count(*) FILTER (WHERE label = 0 AND prediction = 0) AS DOUBLE) AS tn, CAST(count(*) FILTER (WHERE label = 1 AND prediction = 0) AS DOUBLE) AS fn FROM merged))"""))
def _(spark, sf):
    limits = {"auc": 0.82, "precision": 0.75, "recall": 0.70, "f1": 0.72, "accuracy": 0.30}
    merged = cut_lineage(_merged(spark, sf), "merged")
    return E.against_baseline(E.binary_metrics(merged).withColumn("auc", E.roc_auc(merged).scalar()), limits)



