"""Views of the driver tables in this package's data model, as Spark frames and as SQL text.

The given tables know nothing about customer lifecycles, so each entity of the data model is
derived from them by rule: every row of a table becomes one row (or several) of the entity, none
is left out. Irregular values (bad timestamps, negative amounts, re-deliveries) are assigned by
remainders of the event id, so that the branches of the operators are all taken. The SQL text
states the same rules for the comparison engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import prepare

AS_OF = "2024-01-31 00:00:00"
HALF_TIME = "2024-01-16 00:00:00"
ETL_TS = "2024-01-31 01:00:00"
EPOCH_START = 1704067200000000  # 2024-01-01 00:00:00 UTC in microseconds


def as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _cases(column: Column, pairs: dict, default) -> Column:
    """A lookup with a default, as one CASE."""
    result = None
    for key, value in pairs.items():
        result = F.when(column == key, value) if result is None else result.when(column == key, value)
    return result.otherwise(default)


EVENT_TYPES = {"click": "feature_usage", "view": "session_start", "signup": "login", "purchase": "transaction"}
DEVICES = {0: "mobile", 1: "desktop"}


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events under short names, with the number `k` out of `props`."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), F.col("ts").cast("timestamp").alias("ts"), "user_id",
        F.col("event_type").alias("kind"), "value", F.get_json_object("props", "$.k").cast("int").alias("k"),
    )


def with_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their customer's attributes. How to join is left to the planner, which knows the sizes.

    The nation's name is joined last: the size of customers joined to nations first would be
    overestimated, and the events taken for the smaller side.
    """
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", F.col("c_mktsegment").alias("plan"))
    nation = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("cohort"))
    bucket = F.col("user_id") % 20
    state = F.when(bucket == 0, "churned").when(bucket <= 2, "churning").when(bucket <= 7, "at_risk").otherwise("healthy")
    joined = events(spark, sf_dir).join(customer, F.col("user_id") == F.col("c_custkey")).join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    return joined.select(
        "id", "ts", "user_id", "kind", "value", "k", "cohort", "plan", state.alias("customer_state"),
    )


def _event_type() -> Column:
    downgrade = (F.col("kind") == "error") & (F.col("k") >= 90)
    return F.when(downgrade, "plan_downgrade").otherwise(_cases(F.col("kind"), EVENT_TYPES, "support_ticket"))


def _session_id() -> Column:
    return F.concat(F.lit("sess_"), F.col("user_id"), F.lit("_"), F.to_date("ts").cast("string"))


def curated_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean curated events: one per row of `events`."""
    return with_customer(spark, sf_dir).select(
        F.col("id").cast("string").alias("event_id"),
        F.concat(F.lit("cust_"), F.col("user_id")).alias("customer_id"),
        _event_type().alias("event_type"),
        F.col("ts").alias("event_timestamp"),
        _cases(F.col("id") % 3, DEVICES, "tablet").alias("device"),
        _session_id().alias("session_id"),
        F.floor("value").cast("int").alias("session_duration"),
        F.when(F.col("kind") == "purchase", F.col("value")).otherwise(0.0).alias("transaction_amount"),
        F.create_map(F.lit("beta"), F.col("k") % 2 == 0, F.lit("wide"), F.col("k") >= 50).alias("feature_flags"),
        "cohort", "plan", "customer_state",
        F.year("ts").alias("event_year"), F.month("ts").alias("event_month"),
        F.dayofmonth("ts").alias("event_day"), F.hour("ts").alias("event_hour"),
        F.lit(ETL_TS).cast("timestamp").alias("_etl_timestamp"), F.lit("adapter").alias("_etl_job"),
    )


CURATED_SQL = """
base AS (
  SELECT e.event_id AS id, e.ts, e.user_id, e.event_type AS kind, e.value,
         CAST(regexp_extract(e.props, '[0-9]+') AS INTEGER) AS k, n.n_name AS cohort, c.c_mktsegment AS plan,
         CASE WHEN e.user_id % 20 = 0 THEN 'churned' WHEN e.user_id % 20 <= 2 THEN 'churning'
              WHEN e.user_id % 20 <= 7 THEN 'at_risk' ELSE 'healthy' END AS customer_state
  FROM events e JOIN customer c ON e.user_id = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
),
curated AS (
  SELECT CAST(id AS VARCHAR) AS event_id, 'cust_' || user_id AS customer_id,
         CASE WHEN kind = 'error' AND k >= 90 THEN 'plan_downgrade' WHEN kind = 'click' THEN 'feature_usage'
              WHEN kind = 'view' THEN 'session_start' WHEN kind = 'signup' THEN 'login'
              WHEN kind = 'purchase' THEN 'transaction' ELSE 'support_ticket' END AS event_type,
         ts AS event_timestamp,
         CASE id % 3 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop' ELSE 'tablet' END AS device,
         'sess_' || user_id || '_' || strftime(ts, '%Y-%m-%d') AS session_id,
         CAST(floor(value) AS INTEGER) AS session_duration,
         CASE WHEN kind = 'purchase' THEN value ELSE 0.0 END AS transaction_amount,
         k, cohort, plan, customer_state
  FROM base
)"""


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events with irregular values; every tenth one is delivered twice."""
    i = F.col("id")
    deliveries = F.explode(F.sequence(F.lit(1), F.when(i % 10 == 0, 2).otherwise(1)))
    source = with_customer(spark, sf_dir).select("*", deliveries.alias("copy"))
    shouted = i % 7 == 0
    duration = F.floor("value").cast("int")
    return source.select(
        i.cast("string").alias("event_id"),
        F.when(i % 29 == 0, F.lit(None)).when(i % 23 == 0, "").when(i % 19 == 0, "anonymous")
        .otherwise(F.concat(F.lit("cust_"), F.col("user_id"))).alias("customer_id"),
        F.when(shouted, F.concat(F.lit(" "), F.upper(_event_type()), F.lit(" ")))
        .otherwise(_event_type()).alias("event_type"),
        F.when(i % 43 == 0, "not-a-time")
        .when(i % 2 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
        .otherwise(F.date_format(F.col("ts") + F.expr("INTERVAL 2 HOURS"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+02:00'"))
        .alias("timestamp"),
        F.when(i % 11 == 0, " Mobile ").otherwise(_cases(i % 3, DEVICES, "tablet")).alias("device"),
        _session_id().alias("session_id"),
        F.when(i % 47 == 0, F.lit(None)).when(i % 17 == 0, -duration - 1).when(i % 31 == 0, duration + 90000)
        .otherwise(duration + F.col("copy") - 1).cast("int").alias("session_duration"),
        F.when(i % 41 == 0, F.lit(None)).when(i % 13 == 0, -F.col("value") - 1).when(i % 37 == 0, F.col("value") + 100000)
        .when(F.col("kind") == "purchase", F.col("value")).otherwise(0.0).alias("transaction_amount"),
        F.when(i % 53 == 0, "not json").when(i % 59 == 0, '{"beta": "yes"}')
        .otherwise(F.format_string('{"beta": %s}', F.when(F.col("k") % 2 == 0, "true").otherwise("false")))
        .alias("feature_flags"),
        "cohort", "plan",
        F.when(shouted, F.upper("customer_state")).otherwise(F.col("customer_state")).alias("customer_state"),
        F.year("ts").alias("year"), F.month("ts").alias("month"), F.dayofmonth("ts").alias("day"), F.hour("ts").alias("hour"),
        (F.col("ts") + F.make_dt_interval(mins=F.col("copy"))).alias("_ingest_timestamp"),
        F.lit("1.0").alias("_schema_version"),
    )


RAW_SQL = CURATED_SQL + """,
raw AS (
  SELECT CAST(id AS VARCHAR) AS event_id,
         CASE WHEN id % 29 = 0 THEN NULL WHEN id % 23 = 0 THEN '' WHEN id % 19 = 0 THEN 'anonymous'
              ELSE 'cust_' || user_id END AS customer_id,
         CASE WHEN id % 7 = 0 THEN ' ' || upper(event_type) || ' ' ELSE event_type END AS event_type,
         CASE WHEN id % 43 = 0 THEN NULL ELSE ts END AS event_time,
         CASE WHEN id % 11 = 0 THEN ' Mobile ' ELSE device END AS device, session_id,
         CASE WHEN id % 47 = 0 THEN NULL WHEN id % 17 = 0 THEN -session_duration - 1
              WHEN id % 31 = 0 THEN session_duration + 90000
              ELSE CAST(session_duration + copy - 1 AS INTEGER) END AS session_duration,
         CASE WHEN id % 41 = 0 THEN NULL WHEN id % 13 = 0 THEN -value - 1 WHEN id % 37 = 0 THEN value + 100000
              ELSE transaction_amount END AS transaction_amount,
         CASE WHEN id % 53 = 0 THEN 'not json' WHEN id % 59 = 0 THEN '{"beta": "yes"}'
              WHEN k % 2 = 0 THEN '{"beta": true}' ELSE '{"beta": false}' END AS feature_flags,
         cohort, plan, CASE WHEN id % 7 = 0 THEN upper(customer_state) ELSE customer_state END AS customer_state,
         ts AS sent_at, ts + to_minutes(CAST(copy AS INTEGER)) AS _ingest_timestamp, copy, id, k
  FROM (SELECT b.id, b.ts, b.user_id, b.value, c.*, unnest(generate_series(1, CASE WHEN b.id % 10 = 0 THEN 2 ELSE 1 END)) AS copy
        FROM base b JOIN curated c ON CAST(b.id AS VARCHAR) = c.event_id)
)"""


def wire_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON text lines (column `value`), with the damage a wire can do."""
    i = F.col("id")
    source = with_customer(spark, sf_dir)
    record = F.struct(
        F.when(i % 61 != 0, i.cast("string")).alias("event_id"),
        F.when(i % 29 == 0, "").when(i % 61 != 0, F.concat(F.lit("cust_"), F.col("user_id"))).alias("customer_id"),
        _event_type().alias("event_type"),
        F.when(i % 43 == 0, "not-a-time").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")).alias("timestamp"),
        _cases(i % 3, DEVICES, "tablet").alias("device"),
        _session_id().alias("session_id"),
        F.when(i % 47 == 0, "abc").otherwise(F.floor("value").cast("string")).alias("session_duration"),
        F.when(F.col("kind") == "purchase", F.col("value")).alias("transaction_amount"),
        F.when(i % 5 != 0, F.create_map(F.lit("beta"), F.col("k") % 2 == 0)).alias("feature_flags"),
        "cohort", "plan", "customer_state",
        F.when(i % 3 != 0, F.struct(
            F.when(i % 37 == 0, "smoke-test").otherwise("web").alias("source"),
            F.when(i % 2 == 0, "1.1").alias("schema_version"),
        )).alias("metadata"),
    )
    text = F.to_json(record)
    return source.select(
        F.when(i % 53 == 0, F.substring(text, 1, 20)).when(i % 59 == 0, F.concat(F.lit("["), text, F.lit("]")))
        .otherwise(text).alias("value"),
        "ts",
    )


WIRE_SQL = CURATED_SQL + """,
wire AS (
  SELECT b.id, b.ts, b.k, b.value,
         CASE WHEN b.id % 61 <> 0 THEN CAST(b.id AS VARCHAR) END AS event_id,
         CASE WHEN b.id % 29 = 0 THEN '' WHEN b.id % 61 <> 0 THEN 'cust_' || b.user_id END AS customer_id,
         c.event_type, CASE WHEN b.id % 43 = 0 THEN NULL ELSE b.ts END AS event_time, c.device, c.session_id,
         CASE WHEN b.id % 47 = 0 THEN NULL ELSE c.session_duration END AS session_duration,
         CASE WHEN b.kind = 'purchase' THEN b.value END AS transaction_amount,
         CASE WHEN b.id % 5 = 0 THEN '{}' WHEN b.k % 2 = 0 THEN '{"beta":true}' ELSE '{"beta":false}' END AS feature_flags,
         b.cohort, b.plan, b.customer_state,
         CASE WHEN b.id % 3 <> 0 AND b.id % 2 = 0 THEN '1.1' ELSE '1.0' END AS schema_version,
         CASE WHEN b.id % 53 = 0 OR b.id % 59 = 0 THEN 'ProcessingFailed'
              WHEN b.id % 61 = 0 OR b.id % 29 = 0 THEN 'ProcessingFailed'
              WHEN b.id % 3 <> 0 AND b.id % 37 = 0 THEN 'Dropped'
              WHEN b.id % 43 = 0 OR b.id % 47 = 0 THEN 'ProcessingFailed' ELSE 'Ok' END AS result,
         CASE WHEN b.id % 53 = 0 OR b.id % 59 = 0 THEN 'invalid_json'
              WHEN b.id % 61 = 0 AND b.id % 29 <> 0 THEN 'missing_fields: event_id, customer_id'
              WHEN b.id % 61 = 0 THEN 'missing_fields: event_id, customer_id'
              WHEN b.id % 29 = 0 THEN 'missing_fields: customer_id'
              WHEN b.id % 3 <> 0 AND b.id % 37 = 0 THEN 'smoke_test'
              WHEN b.id % 43 = 0 THEN 'invalid_timestamp'
              WHEN b.id % 47 = 0 THEN 'invalid_value: session_duration' END AS reason
  FROM base b JOIN curated c ON CAST(b.id AS VARCHAR) = c.event_id
)"""


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scoring request per event, a month squeezed into half a day."""
    k, user = F.col("k"), F.col("user_id")
    squeezed = F.floor((F.unix_micros("ts") - EPOCH_START) / 60).cast("long") + F.lit(EPOCH_START)
    return events(spark, sf_dir).select(
        F.col("id").alias("request_id"),
        F.timestamp_micros(squeezed).alias("ts"),
        F.when(F.col("id") % 10 < 8, "prod").otherwise("dev").alias("env"),
        F.when(user % 10 == 0, "canary").otherwise("stable").alias("variant"),
        F.concat(F.lit("cust_"), user).alias("customer_id"),
        F.when(F.col("kind") != "error", 200).when(k < 15, 500).when(k < 25, 403).when(k < 30, 401)
        .when(k < 50, 404).otherwise(200).alias("status_code"),
        (F.col("value") * 3.0).alias("latency_ms"),
        (k % 3 == 0).alias("cached"),
        F.when(F.col("id") % 2 == 0, "boosted").otherwise("mlp").alias("model_type"),
        F.when(k < 12, 1).otherwise(0).alias("churn_prediction"),
        (F.col("kind") == "purchase").alias("batch"),
        F.concat(F.lit("10.0."), user % 7, F.lit("."), user % 50).alias("ip"),
        F.concat(F.lit("key_"), user % 5).alias("api_key_id"),
    )


REQUESTS_SQL = CURATED_SQL + f""",
requests AS (
  SELECT id AS request_id,
         make_timestamp({EPOCH_START} + (epoch_us(ts) - {EPOCH_START}) // 60) AS ts,
         CASE WHEN id % 10 < 8 THEN 'prod' ELSE 'dev' END AS env,
         CASE WHEN user_id % 10 = 0 THEN 'canary' ELSE 'stable' END AS variant, 'cust_' || user_id AS customer_id,
         CASE WHEN kind <> 'error' THEN 200 WHEN k < 15 THEN 500 WHEN k < 25 THEN 403 WHEN k < 30 THEN 401
              WHEN k < 50 THEN 404 ELSE 200 END AS status_code,
         value * 3.0 AS latency_ms, k % 3 = 0 AS cached,
         CASE WHEN id % 2 = 0 THEN 'boosted' ELSE 'mlp' END AS model_type,
         CASE WHEN k < 12 THEN 1 ELSE 0 END AS churn_prediction, kind = 'purchase' AS batch,
         '10.0.' || (user_id % 7) || '.' || (user_id % 50) AS ip, 'key_' || (user_id % 5) AS api_key_id
  FROM base
)"""


IAM_EVENTS = [
    "PutUserPolicy", "PutRolePolicy", "PutGroupPolicy", "CreatePolicy", "DeletePolicy", "AttachRolePolicy",
    "DetachRolePolicy",
]
OTHER_EVENTS = {
    7: "ConsoleLogin", 8: "ConsoleLogin", 9: "GetObject", 10: "GetObject", 11: "PutBucketPolicy",
    12: "PutBucketPolicy", 13: "ScheduleKeyDeletion", 14: "AuthorizeSecurityGroupIngress",
}


def audit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One audit record per event."""
    k = F.col("k")
    names = F.array(*[F.lit(n) for n in IAM_EVENTS])
    return events(spark, sf_dir).select(
        F.col("ts").alias("eventTime"),
        F.when(k < 7, F.get(names, k)).otherwise(_cases(k, OTHER_EVENTS, "DescribeInstances")).alias("eventName"),
        F.when(k < 7, "iam.amazonaws.com").when(k == 11, "s3.amazonaws.com").when(k == 13, "kms.amazonaws.com")
        .otherwise("ec2.amazonaws.com").alias("eventSource"),
        F.when(k == 16, "AwsServiceEvent").otherwise("AwsApiCall").alias("eventType"),
        F.when(k == 9, "AccessDenied").when(k == 10, "Client.UnauthorizedAccess").alias("errorCode"),
        F.when(k == 7, "Failed authentication").alias("errorMessage"),
        F.struct(F.when(k.isin(15, 16), "Root").otherwise("IAMUser").alias("type")).alias("userIdentity"),
    )


AUDIT_SQL = CURATED_SQL + """,
audit AS (
  SELECT ts AS event_time, unnest(
      (CASE WHEN k < 7 THEN ['iam_policy_changes'] WHEN k = 7 THEN ['console_login_failures']
            WHEN k = 9 OR k = 10 THEN ['unauthorized_api_calls'] WHEN k = 11 THEN ['s3_bucket_policy_changes']
            WHEN k = 13 THEN ['kms_key_deletion'] WHEN k = 14 THEN ['security_group_changes']
            WHEN k = 15 THEN ['root_account_usage'] ELSE [] END)) AS rule
  FROM base
)"""


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One job run per order."""
    o = table(spark, sf_dir, "orders")
    job = _cases(F.col("o_custkey") % 4, {0: "churn_features", 1: "churn_training", 2: "churn_monitoring"}, "billing")
    return o.select(
        F.concat(F.lit("run_"), F.col("o_orderkey")).alias("run_id"), job.alias("dag_id"),
        F.concat(F.lit("task_"), F.col("o_custkey") % 3).alias("task_id"),
        _cases(F.col("o_orderstatus"), {"F": "failed", "O": "success"}, "running").alias("state"),
        F.col("o_orderdate").cast("timestamp").alias("start"),
        F.floor(F.col("o_totalprice") / 50).cast("long").alias("duration_s"),
        F.when(F.col("o_orderpriority").startswith("1"), F.concat(F.lit("ERROR task of "), job))
        .when(F.col("o_orderpriority").startswith("2"), F.concat(F.lit("run FAILED in "), job))
        .otherwise(F.concat(F.lit("done "), job)).alias("message"),
    )


RUNS_SQL = """
runs AS (
  SELECT 'run_' || o_orderkey AS run_id, job AS dag_id, 'task_' || (o_custkey % 3) AS task_id,
         CASE o_orderstatus WHEN 'F' THEN 'failed' WHEN 'O' THEN 'success' ELSE 'running' END AS state,
         CAST(o_orderdate AS TIMESTAMP) AS start, CAST(floor(o_totalprice / 50) AS BIGINT) AS duration_s,
         CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'ERROR task of ' || job WHEN '2' THEN 'run FAILED in ' || job
              ELSE 'done ' || job END AS message
  FROM (SELECT *, CASE o_custkey % 4 WHEN 0 THEN 'churn_features' WHEN 1 THEN 'churn_training'
                       WHEN 2 THEN 'churn_monitoring' ELSE 'billing' END AS job FROM orders)
)"""


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One logged prediction per event."""
    p = F.col("value") / (F.col("value") + 50.0)
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("inf_"), F.col("event_id")).alias("inference_id"),
        F.concat(F.lit("cust_"), F.col("user_id")).alias("customer_id"),
        F.round(p, 6).alias("churn_probability"),
        F.when(p >= 0.5, 1).otherwise(0).alias("churn_prediction"),
        F.col("ts").cast("timestamp").alias("inference_timestamp"),
    )


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One confirmed outcome per customer, two for every fifth."""
    c = F.col("c_custkey")
    copies = F.explode(F.sequence(F.lit(1), F.when(c % 5 == 0, 2).otherwise(1)))
    day = F.lit("2024-01-31").cast("timestamp")
    return table(spark, sf_dir, "customer").select("*", copies.alias("copy")).select(
        F.concat(F.lit("cust_"), c).alias("customer_id"),
        (F.col("c_acctbal") < 0).alias("churned"),
        (day - F.make_dt_interval(days=((c % 30) + F.col("copy") - 1).cast("int"))).alias("outcome_date"),
    )


LABELS_SQL = """
predictions AS (
  SELECT 'inf_' || event_id AS inference_id, 'cust_' || user_id AS customer_id,
         round(value / (value + 50.0), 6) AS churn_probability,
         CASE WHEN value / (value + 50.0) >= 0.5 THEN 1 ELSE 0 END AS churn_prediction, ts AS inference_timestamp
  FROM events
),
outcomes AS (
  SELECT 'cust_' || c_custkey AS customer_id, c_acctbal < 0 AS churned,
         TIMESTAMP '2024-01-31' - to_days(CAST(c_custkey % 30 + copy - 1 AS INTEGER)) AS outcome_date
  FROM (SELECT *, unnest(generate_series(1, CASE WHEN c_custkey % 5 = 0 THEN 2 ELSE 1 END)) AS copy FROM customer)
)"""


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scored and labelled row per event, for the evaluation operators."""
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("row_id"),
        F.round(F.col("value") / (F.col("value") + 50.0), 4).alias("probability"),
        F.when(F.col("value") + k > 120, 1).otherwise(0).alias("label"),
    )


SCORED_SQL = """
scored AS (
  SELECT event_id AS row_id, round(value / (value + 50.0), 4) AS probability,
         CASE WHEN value + CAST(regexp_extract(props, '[0-9]+') AS INTEGER) > 120 THEN 1 ELSE 0 END AS label
  FROM events
)"""


def with_sql(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()}\n{body.strip()}"


def r(expr: str, name: str, digits: int = 6) -> str:
    """SQL twin of `half_up`."""
    return f"CAST(round(CAST({expr} AS DECIMAL(30,10)), {digits}) AS DOUBLE) AS {name}"
