"""Ingest, curation, merge and scalar-function queries."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from ..constants import LOOKBACK_HOURS
from ..functions import scalars as S
from ..schemas import FLAGS
from ..session import cut_lineage
from ..operators import curate as C, ingest as I, merge as M
from . import adapter as A
from .adapter import CURATED_SQL, RAW_SQL, WIRE_SQL, r, with_sql
from .registry import query


def _routed(spark, sf):
    return I.route_events(A.wire_lines(spark, sf))


@query("ing1_route_events", with_sql(WIRE_SQL, """
SELECT result, coalesce(reason, 'none') AS reason, count(*) AS records FROM wire GROUP BY ALL"""))
def _(spark, sf):
    return _routed(spark, sf).groupBy("result", F.coalesce("reason", F.lit("none")).alias("reason")).agg(
        F.count(F.lit(1)).alias("records"))


@query("ing2_missing_fields", with_sql(RAW_SQL, """
SELECT event_id, _ingest_timestamp,
       concat_ws(',', CASE WHEN coalesce(customer_id, '') = '' THEN 'customer_id' END,
                 CASE WHEN coalesce(session_id, '') = '' THEN 'session_id' END) AS missing
FROM raw"""))
def _(spark, sf):
    found = I.missing_fields(A.raw_events(spark, sf), ["event_id", "customer_id", "session_id"])
    return found.select("event_id", "_ingest_timestamp", F.concat_ws(",", "missing").alias("missing"))


@query("ing3_event_time", with_sql(RAW_SQL, """
SELECT event_id, _ingest_timestamp, event_time AS event_timestamp FROM raw"""))
def _(spark, sf):
    return C.with_event_time(A.raw_events(spark, sf)).select("event_id", "_ingest_timestamp", "event_timestamp")


@query("ing4_typed_rows", with_sql(WIRE_SQL, """
SELECT event_id, customer_id, event_type, event_time AS "timestamp", device, session_id, session_duration,
       transaction_amount, cohort, plan, customer_state FROM wire WHERE result = 'Ok'"""))
def _(spark, sf):
    return _routed(spark, sf).where(F.col("result") == I.OK).select(
        "event_id", "customer_id", "event_type", "timestamp", "device", "session_id", "session_duration",
        "transaction_amount", "cohort", "plan", "customer_state")


@query("ing5_defaults", with_sql(WIRE_SQL, """
SELECT feature_flags, schema_version AS _schema_version, count(*) AS records
FROM wire WHERE result = 'Ok' GROUP BY ALL"""))
def _(spark, sf):
    ok = _routed(spark, sf).where(F.col("result") == I.OK)
    return ok.groupBy("feature_flags", "_schema_version").agg(F.count(F.lit(1)).alias("records"))


@query("ing6_flags_round_trip", with_sql(CURATED_SQL, """
SELECT event_id, '{"beta":' || CASE WHEN k % 2 = 0 THEN 'true' ELSE 'false' END || ',"wide":'
       || CASE WHEN k >= 50 THEN 'true' ELSE 'false' END || '}' AS flags_text,
       k % 2 = 0 AS beta, k >= 50 AS wide FROM curated"""))
def _(spark, sf):
    text = A.curated_events(spark, sf).select("event_id", F.to_json("feature_flags").alias("flags_text"))
    flags = text.withColumn("flags", F.from_json("flags_text", FLAGS))
    return flags.select("event_id", "flags_text", F.col("flags.beta").alias("beta"), F.col("flags.wide").alias("wide"))


@query("ing7_raw_partitions", with_sql(WIRE_SQL, """
SELECT CAST(year(event_time) AS INTEGER) AS year, CAST(month(event_time) AS INTEGER) AS month,
       CAST(day(event_time) AS INTEGER) AS day, CAST(hour(event_time) AS INTEGER) AS hour, count(*) AS records
FROM wire WHERE result = 'Ok' GROUP BY ALL"""))
def _(spark, sf):
    rows = I.accepted(_routed(spark, sf), F.lit(A.ETL_TS).cast("timestamp"))
    return rows.groupBy("year", "month", "day", "hour").agg(F.count(F.lit(1)).alias("records"))


@query("ing8_outcome_counts", with_sql(WIRE_SQL, "SELECT result, count(*) AS records FROM wire GROUP BY result"))
def _(spark, sf):
    return I.outcome_counts(_routed(spark, sf))


@query("ing12_keyed_by_customer", with_sql(CURATED_SQL, """
SELECT customer_id, count(*) AS events, TRUE AS together, TRUE AS in_order FROM curated GROUP BY customer_id"""))
def _(spark, sf):
    """All events of a customer lie in one partition, one behind the other, in time order."""
    keyed = I.keyed_by_customer(A.curated_events(spark, sf)).select(
        "customer_id", "event_timestamp", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("no"))
    before = F.lag("event_timestamp").over(Window.partitionBy("customer_id").orderBy("no"))
    placed = cut_lineage(keyed, "keyed").withColumn("ok", F.coalesce(F.col("event_timestamp") >= before, F.lit(True)))
    return placed.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("events"), ((F.count_distinct("part") == 1) & (F.max("no") - F.min("no") == F.count(F.lit(1)) - 1)).alias("together"),
        F.bool_and("ok").alias("in_order"))


@query("ing12_keyed_by_customer_and_day", with_sql(CURATED_SQL, """
SELECT customer_id, count(*) AS events, count(DISTINCT CAST(event_timestamp AS DATE)) AS day_slices
FROM curated GROUP BY customer_id"""))
def _(spark, sf):
    keyed = I.keyed_by_customer(A.curated_events(spark, sf), slices=64).withColumn("_part", F.spark_partition_id())
    per_day = keyed.groupBy("customer_id", F.to_date("event_timestamp").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("_part").alias("parts"))
    return per_day.groupBy("customer_id").agg(F.sum("n").alias("events"), F.sum("parts").alias("day_slices"))


CURATED_ROWS = RAW_SQL + f""",
survivors AS (
  SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY _ingest_timestamp DESC) AS rank FROM raw
  WHERE event_time BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '{A.AS_OF}'
),
cur AS (
  SELECT event_id, customer_id, lower(trim(event_type)) AS event_type, event_time AS event_timestamp,
         lower(trim(device)) AS device, session_id,
         CASE WHEN session_duration < 0 THEN 0 WHEN session_duration > 86400 THEN 86400 ELSE session_duration END AS session_duration,
         CASE WHEN transaction_amount < 0 THEN 0.0 WHEN transaction_amount > 100000 THEN NULL ELSE transaction_amount END AS transaction_amount,
         CASE WHEN id % 53 = 0 OR id % 59 = 0 THEN NULL ELSE k % 2 = 0 END AS beta,
         cohort, lower(trim(plan)) AS plan, lower(trim(customer_state)) AS customer_state
  FROM survivors WHERE rank = 1 AND customer_id NOT IN ('', 'anonymous')
)"""


def _curated(spark, sf):
    start = F.lit("2024-01-01").cast("timestamp")
    return C.curate(A.raw_events(spark, sf), start, A.as_of(), F.lit(A.ETL_TS), "curate")


@query("cur0_curate", with_sql(CURATED_ROWS, f"""
SELECT event_id, customer_id, event_type, event_timestamp, device, session_id, session_duration, transaction_amount,
       beta, cohort, plan, customer_state, CAST(year(event_timestamp) AS INTEGER) AS event_year,
       CAST(month(event_timestamp) AS INTEGER) AS event_month, CAST(day(event_timestamp) AS INTEGER) AS event_day,
       CAST(hour(event_timestamp) AS INTEGER) AS event_hour, TIMESTAMP '{A.ETL_TS}' AS _etl_timestamp,
       'curate' AS _etl_job
FROM cur"""))
def _(spark, sf):
    return _curated(spark, sf).withColumn("beta", F.col("feature_flags.beta")).drop("feature_flags")


@query("cur1_deduplicated", with_sql(RAW_SQL, """
SELECT event_id, max(_ingest_timestamp) AS _ingest_timestamp, max_by(session_duration, _ingest_timestamp) AS session_duration
FROM (SELECT event_id, _ingest_timestamp, coalesce(session_duration, -999999) AS session_duration FROM raw) GROUP BY event_id"""))
def _(spark, sf):
    unique = C.deduplicated(A.raw_events(spark, sf))
    return unique.select("event_id", "_ingest_timestamp", F.coalesce("session_duration", F.lit(-999999)).alias("session_duration"))


@query("cur3_last_25_hours", with_sql(RAW_SQL, f"""
SELECT event_id, _ingest_timestamp, event_time AS event_timestamp FROM raw
WHERE event_time BETWEEN TIMESTAMP '{A.HALF_TIME}' - INTERVAL 25 HOUR AND TIMESTAMP '{A.HALF_TIME}'"""))
def _(spark, sf):
    end = F.lit(A.HALF_TIME).cast("timestamp")
    events = C.with_event_time(A.raw_events(spark, sf))
    return events.where(F.col("event_timestamp").between(end - F.make_dt_interval(hours=F.lit(LOOKBACK_HOURS)), end)).select(
        "event_id", "_ingest_timestamp", "event_timestamp")


@query("cur4_normalised_text", with_sql(RAW_SQL, """
SELECT lower(trim(event_type)) AS event_type, lower(trim(device)) AS device, lower(trim(plan)) AS plan,
       lower(trim(customer_state)) AS customer_state, count(*) AS records FROM raw GROUP BY ALL"""))
def _(spark, sf):
    return C.cleaned(A.raw_events(spark, sf)).groupBy("event_type", "device", "plan", "customer_state").agg(
        F.count(F.lit(1)).alias("records"))


@query("cur5_known_customers", with_sql(RAW_SQL, """
SELECT customer_id, count(*) AS records FROM raw WHERE customer_id NOT IN ('', 'anonymous') GROUP BY customer_id"""))
def _(spark, sf):
    known = C.cleaned(A.raw_events(spark, sf)).where(F.col("customer_id").isNotNull())
    return known.groupBy("customer_id").agg(F.count(F.lit(1)).alias("records"))


@query("cur6_clamp_duration", with_sql(RAW_SQL, """
SELECT event_id, _ingest_timestamp,
       CASE WHEN session_duration < 0 THEN 0 WHEN session_duration > 86400 THEN 86400 ELSE session_duration END AS session_duration
FROM raw"""))
def _(spark, sf):
    return C.cleaned(A.raw_events(spark, sf)).select("event_id", "_ingest_timestamp", "session_duration")


@query("cur7_clamp_amount", with_sql(RAW_SQL, f"""
SELECT event_id, _ingest_timestamp,
       {r("CASE WHEN transaction_amount < 0 THEN 0.0 WHEN transaction_amount > 100000 THEN NULL ELSE transaction_amount END", "transaction_amount")}
FROM raw"""))
def _(spark, sf):
    return C.cleaned(A.raw_events(spark, sf)).select("event_id", "_ingest_timestamp", "transaction_amount")


@query("cur8_feature_flags", with_sql(RAW_SQL, """
SELECT CASE WHEN id % 53 = 0 OR id % 59 = 0 THEN NULL ELSE k % 2 = 0 END AS beta, count(*) AS records FROM raw GROUP BY ALL"""))
def _(spark, sf):
    return C.cleaned(A.raw_events(spark, sf)).groupBy(F.col("feature_flags.beta").alias("beta")).agg(
        F.count(F.lit(1)).alias("records"))


@query("cur11_load_metrics", with_sql(CURATED_ROWS, f"""
SELECT (SELECT count(*) FROM raw) AS raw_records, (SELECT count(*) FROM cur) AS curated_records,
       {r("(SELECT avg(CASE WHEN customer_id IS NULL THEN 1.0 ELSE 0.0 END) FROM raw)", "null_customer_rate")}"""))
def _(spark, sf):
    return C.load_metrics(A.raw_events(spark, sf), _curated(spark, sf))


# A merge needs a target and a delivery. The target holds the events up to the middle of the month
# at version one; the delivery holds all events from the tenth on, some newer, some older.
MERGE_SQL = CURATED_SQL + """,
merge_target AS (
  SELECT event_id, customer_id, event_timestamp, session_duration, TIMESTAMP '2024-02-01' AS _etl_timestamp
  FROM curated WHERE event_timestamp < TIMESTAMP '2024-01-16'
),
merge_incoming AS (
  SELECT event_id, customer_id, event_timestamp, session_duration + 1000 AS session_duration,
         CASE CAST(event_id AS BIGINT) % 3 WHEN 0 THEN TIMESTAMP '2024-01-31' WHEN 1 THEN TIMESTAMP '2024-02-01'
              ELSE TIMESTAMP '2024-02-02' END AS _etl_timestamp
  FROM curated WHERE event_timestamp >= TIMESTAMP '2024-01-10'
)"""


def _merge_sides(spark, sf):
    rows = A.curated_events(spark, sf).select("event_id", "customer_id", "event_timestamp", "session_duration")
    version = F.col("event_id").cast("long") % 3
    target = rows.where(F.col("event_timestamp") < "2024-01-16").withColumn(
        "_etl_timestamp", F.lit("2024-02-01").cast("timestamp"))
    incoming = rows.where(F.col("event_timestamp") >= "2024-01-10").withColumns({
        "session_duration": F.col("session_duration") + 1000,
        "_etl_timestamp": F.when(version == 0, F.lit("2024-01-31")).when(version == 1, F.lit("2024-02-01"))
        .otherwise(F.lit("2024-02-02")).cast("timestamp"),
    })
    return target, incoming


@query("snk3_merge_events", with_sql(MERGE_SQL, """
SELECT coalesce(t.event_id, s.event_id) AS event_id, coalesce(t.customer_id, s.customer_id) AS customer_id,
       coalesce(t.event_timestamp, s.event_timestamp) AS event_timestamp,
       CASE WHEN t.event_id IS NULL OR t._etl_timestamp < s._etl_timestamp THEN s.session_duration ELSE t.session_duration END AS session_duration,
       CASE WHEN t.event_id IS NULL OR t._etl_timestamp < s._etl_timestamp THEN s._etl_timestamp ELSE t._etl_timestamp END AS _etl_timestamp
FROM merge_target t FULL JOIN merge_incoming s ON t.event_id = s.event_id"""))
def _(spark, sf):
    return M.merge_events(*_merge_sides(spark, sf))


@query("jn4_merge_actions", with_sql(MERGE_SQL, """
SELECT CASE WHEN t.event_id IS NULL THEN 'insert' WHEN t._etl_timestamp < s._etl_timestamp THEN 'update' ELSE 'keep' END AS action,
       count(*) AS records
FROM merge_incoming s LEFT JOIN merge_target t ON t.event_id = s.event_id GROUP BY ALL"""))
def _(spark, sf):
    return M.merge_plan(*_merge_sides(spark, sf)).groupBy("action").agg(F.count(F.lit(1)).alias("records"))


@query("fn1_text", with_sql(CURATED_SQL, """
SELECT event_id, lower(trim('  ' || upper(event_type) || ' ')) AS lowered, replace(event_type, '_', ' ') AS spaced,
       substr(customer_id, 6) AS customer_no, concat_ws('/', cohort, plan) AS segment,
       'customer ' || customer_id || ' on ' || device AS label FROM curated"""))
def _(spark, sf):
    e = A.curated_events(spark, sf)
    return e.select(
        "event_id",
        S.normalised(F.concat(F.lit("  "), F.upper("event_type"), F.lit(" "))).alias("lowered"),
        F.replace("event_type", F.lit("_"), F.lit(" ")).alias("spaced"),
        F.substring("customer_id", 6, 100).alias("customer_no"),
        F.concat_ws("/", "cohort", "plan").alias("segment"),
        F.format_string("customer %s on %s", "customer_id", "device").alias("label"),
    )


@query("fn2_patterns", with_sql(A.RUNS_SQL, """
SELECT dag_id, regexp_matches(message, 'ERROR|FAILED') AS is_error, suffix(message, 'features') AS about_features, count(*) AS records
FROM runs GROUP BY ALL"""))
def _(spark, sf):
    return A.run_log(spark, sf).groupBy(
        "dag_id", F.col("message").rlike("ERROR|FAILED").alias("is_error"),
        F.col("message").endswith("features").alias("about_features"),
    ).agg(F.count(F.lit(1)).alias("records"))


@query("fn3_dates", with_sql(CURATED_SQL, f"""
SELECT event_id, CAST(event_timestamp AS DATE) AS event_date, CAST(year(event_timestamp) AS INTEGER) AS y,
       CAST(month(event_timestamp) AS INTEGER) AS m, CAST(day(event_timestamp) AS INTEGER) AS d,
       CAST(hour(event_timestamp) AS INTEGER) AS h, CAST(CAST(event_timestamp AS DATE) + 7 AS DATE) AS due_date,
       CAST(date_diff('day', CAST(event_timestamp AS DATE), DATE '2024-01-31') AS INTEGER) AS age_days,
       event_timestamp - INTERVAL 25 HOUR AS lookback FROM curated"""))
def _(spark, sf):
    t = F.col("event_timestamp")
    return A.curated_events(spark, sf).select(
        "event_id", F.to_date(t).alias("event_date"), F.year(t).alias("y"), F.month(t).alias("m"),
        F.dayofmonth(t).alias("d"), F.hour(t).alias("h"), F.date_add(F.to_date(t), 7).alias("due_date"),
        F.datediff(F.to_date(A.as_of()), F.to_date(t)).alias("age_days"),
        (t - F.make_dt_interval(hours=F.lit(25))).alias("lookback"),
    )


@query("fn4_timestamps", with_sql(CURATED_SQL, """
SELECT event_id, event_timestamp AS parsed, date_trunc('millisecond', event_timestamp) AS from_millis,
       time_bucket(INTERVAL 5 MINUTE, event_timestamp, TIMESTAMP '1970-01-01') AS slot FROM curated"""))
def _(spark, sf):
    e = A.curated_events(spark, sf)
    text = F.date_format("event_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return e.select(
        "event_id", S.event_time(text).alias("parsed"),
        S.epoch_millis(F.unix_millis("event_timestamp")).alias("from_millis"),
        S.time_slot(F.col("event_timestamp"), 300).alias("slot"),
    )


@query("fn5_math", with_sql(CURATED_SQL, f"""
SELECT event_id, {r("transaction_amount", "rounded", 1)}, CAST(abs(session_duration - 50) AS INTEGER) AS distance,
       CAST(greatest(session_duration, 10) AS INTEGER) AS at_least, CAST(least(session_duration, 60) AS INTEGER) AS at_most,
       {r("transaction_amount / nullif(session_duration, 0)", "per_second")} FROM curated"""))
def _(spark, sf):
    d = F.col("session_duration")
    return A.curated_events(spark, sf).select(
        "event_id", S.half_up(F.col("transaction_amount"), 1).alias("rounded"), F.abs(d - 50).alias("distance"),
        F.greatest(d, F.lit(10)).alias("at_least"), F.least(d, F.lit(60)).alias("at_most"),
        S.ratio(F.col("transaction_amount"), d).alias("per_second"),
    )


@query("fn6_conditionals", with_sql(RAW_SQL, """
SELECT event_id, _ingest_timestamp, coalesce(nullif(customer_id, ''), session_id) AS actor,
       CASE WHEN session_duration IS NULL THEN 'unknown' WHEN session_duration < 0 THEN 'negative'
            WHEN session_duration > 86400 THEN 'too long' ELSE 'fine' END AS quality FROM raw"""))
def _(spark, sf):
    d = F.col("session_duration")
    return A.raw_events(spark, sf).select(
        "event_id", "_ingest_timestamp",
        F.coalesce(S.present(F.col("customer_id")), F.col("session_id")).alias("actor"),
        F.when(d.isNull(), "unknown").when(d < 0, "negative").when(d > 86400, "too long").otherwise("fine").alias("quality"),
    )


@query("fn7_try_cast", with_sql(RAW_SQL, """
SELECT event_id, _ingest_timestamp, TRY_CAST(event_id AS BIGINT) AS id_number, TRY_CAST(device AS INTEGER) AS device_number FROM raw"""))
def _(spark, sf):
    return A.raw_events(spark, sf).select(
        "event_id", "_ingest_timestamp", F.col("event_id").try_cast("bigint").alias("id_number"),
        F.col("device").try_cast("int").alias("device_number"))


@query("fn8_json", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, coalesce(json_extract_string(props, '$.absent'), 'none') AS absent,
       CAST(json_extract_string(json_extract_string('{"body": "' || replace(props, '"', '\\"') || '"}', '$.body'), '$.k') AS INTEGER) AS inner_k
FROM events""")
def _(spark, sf):
    wrapped = F.to_json(F.struct(F.col("props").alias("body")))
    inner = F.get_json_object(F.get_json_object(wrapped, "$.body"), "$.k")
    return A.table(spark, sf, "events").select(
        "event_id", F.from_json("props", "k INT")["k"].alias("k"),
        F.coalesce(F.get_json_object("props", "$.absent"), F.lit("none")).alias("absent"),
        inner.cast("int").alias("inner_k"))


@query("fn9_flag_maps", with_sql(CURATED_SQL, """
SELECT event_id, k % 2 = 0 AS beta, CAST((k % 2 = 0)::INT + (k >= 50)::INT AS INTEGER) AS flags_on FROM curated"""))
def _(spark, sf):
    return A.curated_events(spark, sf).select(
        "event_id", F.try_element_at("feature_flags", F.lit("beta")).alias("beta"), S.flag_count(F.col("feature_flags")).alias("flags_on"))


@query("fn10_arrays", with_sql(CURATED_SQL, """
SELECT customer_id, array_to_string(list_sort(list_distinct(list(event_type))), ',') AS event_types,
       CAST(count(DISTINCT event_type) AS INTEGER) AS n_types FROM curated GROUP BY customer_id"""))
def _(spark, sf):
    # Distinct types first: the set of a customer holds names of event types, not events.
    pairs = A.curated_events(spark, sf).select("customer_id", "event_type").distinct()
    types = F.array_sort(F.collect_set("event_type"))
    return pairs.groupBy("customer_id").agg(types.alias("t")).select(
        "customer_id", F.concat_ws(",", "t").alias("event_types"), F.size("t").alias("n_types"))


@query("fn11_prediction_key", """
SELECT CAST(event_id AS VARCHAR) AS event_id, 'churn:pred:' || substr(sha256(
  '{"customer_id":"cust_' || user_id || '","features":{"event_type":"' || event_type || '","user_id":' || user_id || '}}'), 1, 32) AS prediction_key
FROM events""")
def _(spark, sf):
    e = A.table(spark, sf, "events")
    return e.select(
        F.col("event_id").cast("string").alias("event_id"),
        S.prediction_key(F.concat(F.lit("cust_"), F.col("user_id")), ["user_id", "event_type"]).alias("prediction_key"))


@query("fn12_base64_frames", with_sql(WIRE_SQL, "SELECT result, count(*) AS records FROM wire GROUP BY result"))
def _(spark, sf):
    frames = A.wire_lines(spark, sf).select(F.base64(F.encode("value", "UTF-8")).alias("data"))
    return I.outcome_counts(I.route_events(I.decode_frames(frames)))


@query("fn13_sigmoid", with_sql(CURATED_SQL, f"""
SELECT event_id, {r("1.0 / (1.0 + exp(-(session_duration - 50) / 25.0))", "probability")} FROM curated"""))
def _(spark, sf):
    return A.curated_events(spark, sf).select(
        "event_id", S.sigmoid((F.col("session_duration") - 50) / F.lit(25.0)).alias("probability"))
