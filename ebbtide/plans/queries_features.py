"""Window features, snapshots, reports, selections."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from ..constants import NUMERIC_FEATURES
from ..functions import running as R, scalars as S
from ..operators import features as X, reports as P, selection as L
from ..session import cut_lineage
from ..sources import snapshots as N
from . import adapter as A
from .adapter import CURATED_SQL, r, with_sql
from .registry import query

# name, aggregate; every window measure of a filtered group, in DuckDB's words
MEASURES = [
    ("total_events", "count(*) FILTER ({w})"),
    ("unique_sessions", "count(DISTINCT session_id) FILTER ({w})"),
    ("avg_session_duration", "avg(session_duration) FILTER ({w})"),
    ("std_session_duration", "stddev_samp(session_duration) FILTER ({w})"),
    ("max_session_duration", "CAST(max(session_duration) FILTER ({w}) AS DOUBLE)"),
    ("total_transaction_amount", "sum(transaction_amount) FILTER ({w})"),
    ("transaction_count", "count(*) FILTER ({w} AND transaction_amount > 0)"),
    ("avg_transaction_amount", "avg(transaction_amount) FILTER ({w})"),
    ("login_count", "count(*) FILTER ({w} AND event_type = 'login')"),
    ("feature_usage_count", "count(*) FILTER ({w} AND event_type = 'feature_usage')"),
    ("support_tickets", "count(*) FILTER ({w} AND event_type = 'support_ticket')"),
    ("plan_downgrades", "count(*) FILTER ({w} AND event_type = 'plan_downgrade')"),
    ("last_event_timestamp", "max(event_timestamp) FILTER ({w})"),
    ("first_event_timestamp", "min(event_timestamp) FILTER ({w})"),
    ("device_types", "count(DISTINCT device) FILTER ({w})"),
]
ROUNDED = {"avg_session_duration", "std_session_duration", "max_session_duration", "total_transaction_amount", "avg_transaction_amount"}


def windows_sql(as_of: str, days: tuple[int, ...], source: int, name: str = "windows") -> str:
    """All measures of all windows per customer; NULL where the window is empty."""
    columns = []
    for n in days:
        inside = f"WHERE event_timestamp >= TIMESTAMP '{as_of}' - INTERVAL {n} DAY"
        for measure, text in MEASURES:
            value = text.replace("({w}", f"({inside}")
            columns.append(f"CASE WHEN count(*) FILTER ({inside}) > 0 THEN {value} END AS {measure}_{n}d")
    return f"""
{name} AS (
  SELECT customer_id, {', '.join(columns)},
         arg_max(cohort, event_timestamp) AS cohort, arg_max(plan, event_timestamp) AS current_plan,
         arg_max(customer_state, event_timestamp) AS customer_state, max(event_timestamp) AS last_seen_at,
         min(event_timestamp) AS first_seen_at, count(*) AS total_events_all_time
  FROM curated WHERE event_timestamp < TIMESTAMP '{as_of}' AND event_timestamp >= TIMESTAMP '{as_of}' - INTERVAL {source} DAY
  GROUP BY customer_id
)"""


def window_columns(days: tuple[int, ...]) -> str:
    return ", ".join(
        r(f"{m}_{n}d", f"{m}_{n}d") if m in ROUNDED else f"{m}_{n}d" for n in days for m, _ in MEASURES
    )


def features_sql(as_of: str, name: str = "features") -> str:
    """The feature snapshot as unrounded rows."""
    return windows_sql(as_of, (7, 30, 90), 91, f"w_{name}") + f""",
{name} AS (
  SELECT *, DATE '{as_of[:10]}' AS snapshot_date,
         CASE WHEN customer_state = 'churned' THEN 1 ELSE 0 END AS is_churned,
         CAST(date_diff('day', CAST(last_seen_at AS DATE), DATE '{as_of[:10]}') AS INTEGER) AS days_since_last_login,
         (avg_session_duration_7d - avg_session_duration_30d) / greatest(avg_session_duration_30d, 1.0) AS session_duration_trend,
         transaction_count_7d / 7.0 - transaction_count_30d / 30.0 AS transaction_trend,
         CASE WHEN total_events_7d IS NOT NULL THEN feature_usage_count_7d / greatest(total_events_7d, 1) END AS feature_engagement_ratio_7d,
         CASE WHEN total_events_30d IS NOT NULL THEN support_tickets_30d / greatest(total_events_30d, 1) END AS support_ticket_rate_30d,
         '1.0' AS _feature_version, TIMESTAMP '{as_of}' AS _computed_at
  FROM w_{name}
)"""


DOUBLES = {
    "avg_session_duration_7d", "std_session_duration_7d", "max_session_duration_7d", "total_transaction_amount_7d",
    "avg_session_duration_30d", "total_transaction_amount_30d", "total_transaction_amount_90d",
    "session_duration_trend", "transaction_trend", "feature_engagement_ratio_7d", "support_ticket_rate_30d",
}


def pick(columns: list[str]) -> str:
    return ", ".join(r(c, c) if c in DOUBLES else c for c in columns)


FEATURES_SQL = CURATED_SQL + "," + features_sql(A.AS_OF)
# Two snapshots, as a table that has been written on two days.
SNAPSHOTS_SQL = (
    CURATED_SQL + "," + features_sql(A.HALF_TIME, "early") + "," + features_sql(A.AS_OF, "late")
    + ", snapshots AS (SELECT * FROM early UNION ALL BY NAME SELECT * FROM late)"
)


def features(spark, sf, as_of: str = A.AS_OF):
    return X.build_features(A.curated_events(spark, sf), F.lit(as_of).cast("timestamp"))


def snapshots(spark, sf):
    return features(spark, sf, A.HALF_TIME).unionByName(features(spark, sf))


@query("agg1_window_features", with_sql(CURATED_SQL + "," + windows_sql(A.AS_OF, (7, 30, 90), 90), f"""
SELECT customer_id, {window_columns((7, 30, 90))} FROM windows"""))
def _(spark, sf):
    return X.window_features(A.curated_events(spark, sf), A.as_of())


@query("agg1_window_features_early", with_sql(CURATED_SQL + "," + windows_sql("2024-01-09 12:00:00", (1, 3, 14), 14), f"""
SELECT customer_id, {window_columns((1, 3, 14))} FROM windows"""))
def _(spark, sf):
    return X.window_features(A.curated_events(spark, sf), F.lit("2024-01-09 12:00:00").cast("timestamp"), (1, 3, 14))


@query("agg2_static_features", with_sql(CURATED_SQL + "," + windows_sql("2030-01-01 00:00:00", (7,), 9999), """
SELECT customer_id, cohort, current_plan, customer_state, last_seen_at, first_seen_at, total_events_all_time FROM windows"""))
def _(spark, sf):
    return X.static_features(A.curated_events(spark, sf))


@query("jn1_joined_features", with_sql(CURATED_SQL + "," + windows_sql(A.AS_OF, (7, 30, 90), 91), f"""
SELECT customer_id, cohort, current_plan, customer_state, last_seen_at, first_seen_at, total_events_all_time,
       {window_columns((7, 30, 90))} FROM windows"""))
def _(spark, sf):
    return X.joined_features(A.curated_events(spark, sf), A.as_of(), (7, 30, 90))


@query("fea0_build_features", with_sql(FEATURES_SQL, f"SELECT {pick(X.SNAPSHOT_COLUMNS)} FROM features"))
def _(spark, sf):
    return features(spark, sf)


@query("fea1_last_login_age", with_sql(CURATED_SQL, f"""
SELECT customer_id, max(event_timestamp) AS last_login_at,
       CAST(date_diff('day', CAST(max(event_timestamp) AS DATE), DATE '{A.AS_OF[:10]}') AS INTEGER) AS days_since_true_login
FROM curated WHERE event_type = 'login' AND event_timestamp < TIMESTAMP '{A.AS_OF}' GROUP BY customer_id"""))
def _(spark, sf):
    return X.last_login_age(A.curated_events(spark, sf), A.as_of())


@query("fea2_trends_and_ratios", with_sql(CURATED_SQL + "," + features_sql("2024-01-09 12:00:00"), f"""
SELECT customer_id, days_since_last_login, {pick(["session_duration_trend", "transaction_trend", "feature_engagement_ratio_7d", "support_ticket_rate_30d"])}, is_churned
FROM features"""))
def _(spark, sf):
    return features(spark, sf, "2024-01-09 12:00:00").select(
        "customer_id", "days_since_last_login", "session_duration_trend", "transaction_trend",
        "feature_engagement_ratio_7d", "support_ticket_rate_30d", "is_churned")


@query("fea7_valid_cohorts", with_sql(CURATED_SQL, """
SELECT customer_id, max(CASE CAST(substr(cohort, 8) AS INTEGER) % 5 WHEN 0 THEN '2023-Q5' ELSE '2023-Q' || (CAST(substr(cohort, 8) AS INTEGER) % 5) END) AS quarter,
       max(CASE WHEN CAST(substr(cohort, 8) AS INTEGER) % 5 = 0 THEN 0 ELSE 1 END) = 1 AS valid
FROM curated GROUP BY customer_id"""))
def _(spark, sf):
    number = F.substring("cohort", 8, 10).cast("int") % 5
    quarter = F.concat(F.lit("2023-Q"), F.when(number == 0, 5).otherwise(number))
    per_customer = A.curated_events(spark, sf).groupBy("customer_id").agg(F.max(quarter).alias("quarter"))
    return per_customer.withColumn("valid", S.valid_cohort(F.col("quarter")))


@query("agg3_daily_event_counts", with_sql(CURATED_SQL, f"""
SELECT CAST(event_timestamp AS DATE) AS event_date, event_type, count(*) AS event_count,
       count(DISTINCT customer_id) AS unique_customers, {r("avg(session_duration)", "avg_session_duration_secs")},
       count(*) FILTER (WHERE transaction_amount > 0) AS transaction_events,
       {r("sum(coalesce(transaction_amount, 0.0))", "total_transaction_amount")}
FROM curated WHERE event_timestamp >= DATE '2024-01-31' - 30 AND event_timestamp < TIMESTAMP '{A.AS_OF}'
GROUP BY 1, 2 ORDER BY event_date DESC, event_count DESC, event_type"""))
def _(spark, sf):
    return P.daily_event_counts(A.curated_events(spark, sf), A.as_of(), days=30)


@query("agg3_month_to_date_days", with_sql(CURATED_SQL, """
SELECT CAST(event_timestamp AS DATE) AS event_date, count(*) AS event_count FROM curated
WHERE year(event_timestamp) = 2024 AND month(event_timestamp) = 1 AND day(event_timestamp) >= 16 - 7 GROUP BY 1"""))
def _(spark, sf):
    return P.month_to_date_event_days(A.curated_events(spark, sf), F.lit(A.HALF_TIME).cast("timestamp"))


CHURN_RISK = f"""
SELECT cohort, current_plan, total_customers, healthy_count, at_risk_count, churning_count, churned_count,
       {r("100.0 * churned_count / total_customers", "churn_rate_pct", 2)},
       {r("100.0 * (at_risk_count + churning_count) / total_customers", "at_risk_rate_pct", 2)},
       {r("trend", "session_duration_trend", 4)}, {r("recency", "avg_days_since_login", 1)},
       {r("transactions", "avg_monthly_transactions", 2)}, {r("revenue", "avg_monthly_revenue_usd", 2)},
       {r("tickets * 100", "support_ticket_rate_pct", 2)}, {r("engagement * 100", "feature_engagement_pct", 2)}
FROM (SELECT cohort, current_plan, count(*) AS total_customers,
             count(*) FILTER (WHERE customer_state = 'healthy') AS healthy_count,
             count(*) FILTER (WHERE customer_state = 'at_risk') AS at_risk_count,
             count(*) FILTER (WHERE customer_state = 'churning') AS churning_count,
             count(*) FILTER (WHERE customer_state = 'churned') AS churned_count,
             avg(session_duration_trend) AS trend, avg(days_since_last_login) AS recency,
             avg(transaction_count_30d) AS transactions, avg(total_transaction_amount_30d) AS revenue,
             avg(support_ticket_rate_30d) AS tickets, avg(feature_engagement_ratio_7d) AS engagement
      FROM features WHERE cohort IS NOT NULL GROUP BY cohort, current_plan)
ORDER BY churn_rate_pct DESC, cohort, current_plan"""


def stored_features(spark, sf):
    """The snapshot as a stored table, which is what every step after the feature job reads."""
    return cut_lineage(features(spark, sf), "features")


@query("agg4_churn_risk_by_cohort", with_sql(FEATURES_SQL, CHURN_RISK))
def _(spark, sf):
    return P.churn_risk_by_cohort(stored_features(spark, sf))


@query("srt1_churn_risk_order", with_sql(FEATURES_SQL, f"""
SELECT CAST(row_number() OVER (ORDER BY churn_rate_pct DESC, cohort, current_plan) AS INTEGER) AS place, cohort, current_plan, churn_rate_pct
FROM ({CHURN_RISK.replace("ORDER BY churn_rate_pct DESC, cohort, current_plan", "")})"""))
def _(spark, sf):
    """The order of the report itself: places are counted along its rows as they come."""
    rows = P.churn_risk_by_cohort(stored_features(spark, sf)).select("cohort", "current_plan", "churn_rate_pct")
    written = cut_lineage(rows.coalesce(1).withColumn("no", F.monotonically_increasing_id()), "report")
    return written.select((F.row_number().over(Window.orderBy("no"))).alias("place"), "cohort", "current_plan", "churn_rate_pct")


@query("srt1_daily_counts_order", with_sql(CURATED_SQL, f"""
SELECT CAST(row_number() OVER (ORDER BY event_date DESC, n DESC, event_type) AS INTEGER) AS place, event_date, event_type, n AS event_count
FROM (SELECT CAST(event_timestamp AS DATE) AS event_date, event_type, count(*) AS n FROM curated
      WHERE event_timestamp >= CAST(CAST(TIMESTAMP '{A.AS_OF}' AS DATE) - 7 AS TIMESTAMP) AND event_timestamp < TIMESTAMP '{A.AS_OF}' GROUP BY ALL)"""))
def _(spark, sf):
    rows = P.daily_event_counts(A.curated_events(spark, sf), A.as_of()).select("event_date", "event_type", "event_count")
    written = cut_lineage(rows.coalesce(1).withColumn("no", F.monotonically_increasing_id()), "report")
    return written.select((F.row_number().over(Window.orderBy("no"))).alias("place"), "event_date", "event_type", "event_count")


@query("agg5_conditional_counts", with_sql(CURATED_SQL, """
SELECT customer_id, count(*) FILTER (WHERE transaction_amount > 0) AS transactions,
       count(*) FILTER (WHERE event_type = 'support_ticket') AS tickets,
       sum(CASE WHEN session_duration >= 60 THEN 1 ELSE 0 END)::BIGINT AS long_sessions FROM curated GROUP BY customer_id"""))
def _(spark, sf):
    return A.curated_events(spark, sf).groupBy("customer_id").agg(
        F.count_if(F.col("transaction_amount") > 0).alias("transactions"),
        F.count_if(F.col("event_type") == "support_ticket").alias("tickets"),
        F.sum(F.when(F.col("session_duration") >= 60, 1).otherwise(0)).alias("long_sessions"))


@query("agg6_spot_check", with_sql(CURATED_SQL, f"""
SELECT count(*) AS total_events, count(DISTINCT customer_id) AS unique_customers, max(event_timestamp) AS latest_event
FROM curated WHERE event_timestamp BETWEEN TIMESTAMP '{A.HALF_TIME}' - INTERVAL 2 HOUR AND TIMESTAMP '{A.HALF_TIME}'"""))
def _(spark, sf):
    return P.spot_check(A.curated_events(spark, sf), F.lit(A.HALF_TIME).cast("timestamp"))


@query("agg7_label_rate", with_sql(FEATURES_SQL, f"""
SELECT count(*) AS rows, {r("avg(is_churned)", "churn_rate")} FROM features"""))
def _(spark, sf):
    return P.label_rate(features(spark, sf))


@query("agg8_class_weight", with_sql(A.SCORED_SQL, f"""
SELECT count(*) FILTER (WHERE label = 0) AS negatives, count(*) FILTER (WHERE label = 1) AS positives,
       {r("count(*) FILTER (WHERE label = 0) / count(*) FILTER (WHERE label = 1)", "positive_weight")} FROM scored"""))
def _(spark, sf):
    return P.class_weight(A.scored(spark, sf), "label")


@query("agg10_latency_percentiles", with_sql(A.REQUESTS_SQL, f"""
SELECT model_type, {r("quantile_cont(latency_ms, 0.5)", "p50")}, {r("quantile_cont(latency_ms, 0.95)", "p95")},
       {r("quantile_cont(latency_ms, 0.99)", "p99")} FROM requests GROUP BY model_type"""))
def _(spark, sf):
    return R.exact_percentiles(A.request_log(spark, sf), ["model_type"], "latency_ms", {"p50": 0.5, "p95": 0.95, "p99": 0.99})


@query("agg10_overall_percentiles", with_sql(A.REQUESTS_SQL, f"""
SELECT {r("quantile_cont(latency_ms, 0.5)", "p50")}, {r("quantile_cont(latency_ms, 0.99)", "p99")} FROM requests"""))
def _(spark, sf):
    return R.exact_percentiles(A.request_log(spark, sf), [], "latency_ms", {"p50": 0.5, "p99": 0.99})


@query("agg11_runs_by_state", with_sql(A.RUNS_SQL, """
SELECT dag_id, state, count(*) AS runs FROM runs
WHERE start BETWEEN TIMESTAMP '1998-06-02' - INTERVAL 24 HOUR AND TIMESTAMP '1998-06-02' GROUP BY dag_id, state"""))
def _(spark, sf):
    return P.runs_by_state(A.run_log(spark, sf), F.lit("1998-06-02").cast("timestamp"))


@query("src6_load_features", with_sql(SNAPSHOTS_SQL, f"""
SELECT customer_id, is_churned, cohort, current_plan, {pick(NUMERIC_FEATURES)}
FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY snapshot_date DESC) AS rn FROM snapshots
      WHERE snapshot_date >= DATE '2024-01-31' - 90 AND total_events_7d IS NOT NULL) WHERE rn = 1"""))
def _(spark, sf):
    return N.load_features(snapshots(spark, sf), as_of=F.to_date(A.as_of()))


@query("src7_read_parquet", "SELECT count(*) AS customers, count(DISTINCT c_mktsegment) AS segments FROM customer")
def _(spark, sf):
    return N.read_features(spark, f"{sf}/customer.parquet").agg(
        F.count(F.lit(1)).alias("customers"), F.count_distinct("c_mktsegment").alias("segments"))


@query("src8_latest_partition", with_sql(CURATED_SQL, "SELECT max(strftime(event_timestamp, '%Y-%m-%d')) AS latest FROM curated"))
def _(spark, sf):
    days = A.curated_events(spark, sf).withColumn("day", F.to_date("event_timestamp").cast("string"))
    return N.latest_partition(days, "day")


@query("win1_latest_snapshot_per_customer", with_sql(SNAPSHOTS_SQL, """
SELECT customer_id, max(snapshot_date) AS snapshot_date, arg_max(total_events_7d, snapshot_date) AS total_events_7d
FROM snapshots WHERE total_events_7d IS NOT NULL GROUP BY customer_id"""))
def _(spark, sf):
    return N.latest_per_customer(snapshots(spark, sf)).select("customer_id", "snapshot_date", "total_events_7d")


@query("win2_latest_prediction_per_customer", with_sql(A.LABELS_SQL, """
SELECT customer_id, arg_max(inference_id, inference_timestamp) AS inference_id, max(inference_timestamp) AS inference_timestamp,
       arg_max(churn_prediction, inference_timestamp) AS churn_prediction FROM predictions GROUP BY customer_id"""))
def _(spark, sf):
    return L.latest_row(A.predictions(spark, sf), "customer_id", "inference_timestamp", tie="inference_id").select(
        "customer_id", "inference_id", "inference_timestamp", "churn_prediction")


@query("srt2_top_features", with_sql(CURATED_SQL, f"""
SELECT event_type || '/' || cohort AS feature, {r("sum(session_duration) / 1000.0", "importance")} FROM curated
GROUP BY 1 ORDER BY importance DESC, feature LIMIT 20"""))
def _(spark, sf):
    weights = A.curated_events(spark, sf).groupBy(F.concat_ws("/", "event_type", "cohort").alias("feature")).agg(
        (F.sum("session_duration") / F.lit(1000.0)).alias("importance"))
    return P.top_features(weights, 20)


# Suppliers stand for candidate models: a score, a gate result and a creation time each.
MODELS_SQL = """
models AS (
  SELECT CASE s_suppkey % 2 WHEN 0 THEN 'boosted' ELSE 'mlp' END AS model_type, 'v' || s_suppkey AS model_version,
         s_nationkey AS family, round((s_acctbal + 1000) / 11000.0, 6) AS auc, s_acctbal > 500 AS passed,
         CASE s_suppkey % 3 WHEN 0 THEN 'Production' WHEN 1 THEN 'Staging' ELSE 'Archived' END AS stage,
         TIMESTAMP '2024-01-01' + to_hours(CAST(s_suppkey * 7 AS INTEGER)) AS created_at
  FROM supplier
)"""


def models(spark, sf):
    key = F.col("s_suppkey")
    return A.table(spark, sf, "supplier").select(
        F.when(key % 2 == 0, "boosted").otherwise("mlp").alias("model_type"),
        F.concat(F.lit("v"), key).alias("model_version"), F.col("s_nationkey").alias("family"),
        F.round((F.col("s_acctbal") + 1000) / 11000.0, 6).alias("auc"), (F.col("s_acctbal") > 500).alias("passed"),
        F.when(key % 3 == 0, "Production").when(key % 3 == 1, "Staging").otherwise("Archived").alias("stage"),
        (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(hours=(key * 7).cast("int"))).alias("created_at"),
    )


@query("srt4_winner", with_sql(MODELS_SQL, """
SELECT family, arg_max(model_version, auc) FILTER (WHERE passed) AS winner FROM models GROUP BY family"""))
def _(spark, sf):
    return L.pick_winner(models(spark, sf), ["family"], name="model_version")


@query("srt4_forced_winner", with_sql(MODELS_SQL, """
SELECT family, coalesce(max(model_version) FILTER (WHERE passed AND model_version = 'v7'),
                        arg_max(model_version, auc) FILTER (WHERE passed)) AS winner FROM models GROUP BY family"""))
def _(spark, sf):
    return L.pick_winner(models(spark, sf), ["family"], name="model_version", forced="v7")


@query("srt5_previous_version", with_sql(MODELS_SQL, """
SELECT model_type, arg_max(model_version, created_at) AS model_version, max(created_at) AS deployed_at FROM models
WHERE model_version NOT IN (SELECT arg_max(model_version, created_at) FROM models) GROUP BY model_type"""))
def _(spark, sf):
    history = models(spark, sf).withColumnRenamed("created_at", "deployed_at")
    failed = history.agg(F.max_by("model_version", "deployed_at")).scalar()
    return L.previous_version(history, failed, ["model_type"])


@query("srt6_needs_baseline", with_sql(MODELS_SQL, """
SELECT model_version, created_at FROM models WHERE stage = 'Production'
AND created_at > (SELECT max(created_at) FROM models) - INTERVAL 7 DAY"""))
def _(spark, sf):
    all_models = models(spark, sf)
    now = all_models.agg(F.max("created_at")).scalar()
    return L.needs_baseline(all_models, now).select("model_version", "created_at")


@query("set1_union", with_sql(CURATED_SQL, """
SELECT 'curated' AS origin, event_id, event_type, NULL AS status FROM curated
UNION ALL SELECT 'orders', CAST(o_orderkey AS VARCHAR), NULL, o_orderstatus FROM orders"""))
def _(spark, sf):
    events = A.curated_events(spark, sf).select(F.lit("curated").alias("origin"), "event_id", "event_type")
    orders = A.table(spark, sf, "orders").select(
        F.lit("orders").alias("origin"), F.col("o_orderkey").cast("string").alias("event_id"), F.col("o_orderstatus").alias("status"))
    return events.unionByName(orders, allowMissingColumns=True)


@query("set2_distinct", with_sql(CURATED_SQL, "SELECT DISTINCT customer_id, device, event_type FROM curated"))
def _(spark, sf):
    return A.curated_events(spark, sf).select("customer_id", "device", "event_type").distinct()


@query("set3_unseen_categories", with_sql(CURATED_SQL, """
SELECT DISTINCT n_name AS cohort FROM nation WHERE n_name NOT IN (SELECT cohort FROM curated WHERE plan = 'HOUSEHOLD' AND cohort IS NOT NULL)"""))
def _(spark, sf):
    known = A.curated_events(spark, sf).where(F.col("plan") == "HOUSEHOLD")
    live = A.table(spark, sf, "nation").select(F.col("n_name").alias("cohort"))
    return L.unseen_categories(known, live, "cohort")
