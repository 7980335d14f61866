"""Sources, sinks, webhooks and streams: each query writes the whole entity and reads it back."""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import Window, functions as F

from .. import schemas
from ..operators import curate as C, features as X, ingest as I, validate as V, webhooks as K
from ..session import cut_lineage, dealt, scratch_dir
from ..sinks import tables as T, writers as W
from ..sources import labels as L, raw as R, snapshots as N
from ..streaming import ingest as S, stateful as Y
from . import adapter as A, jobs
from .adapter import CURATED_SQL, LABELS_SQL, RAW_SQL, WIRE_SQL, r, with_sql
from .queries_features import SNAPSHOTS_SQL, snapshots
from .queries_ingest import CURATED_ROWS, MERGE_SQL
from .queries_quality import LOG_SQL, MERGED_SQL, _flat, _merged, _scores
from .registry import query

ETL = dt.datetime(2024, 1, 31, 1)



def _etl():
    return F.lit(A.ETL_TS).cast("timestamp")


def _written_raw(spark, sf):
    path = scratch_dir(spark, "raw")
    W.write_raw(I.accepted(I.route_events(A.wire_lines(spark, sf)), _etl()), path)
    return path


DAY_COUNTS = """SELECT CAST(year(event_time) AS INTEGER) AS year, CAST(month(event_time) AS INTEGER) AS month, CAST(day(event_time) AS INTEGER) AS day,
  CAST(hour(event_time) AS INTEGER) AS hour, count(*) AS records, CAST(sum(session_duration) AS BIGINT) AS seconds FROM wire WHERE result = 'Ok'"""


def _per_hour(raw):
    return raw.groupBy("year", "month", "day", "hour").agg(F.count(F.lit(1)).alias("records"), F.sum("session_duration").alias("seconds"))


@query("snk1_write_raw", with_sql(WIRE_SQL, DAY_COUNTS + " GROUP BY ALL"))
def _(spark, sf):
    return _per_hour(spark.read.schema(schemas.RAW_EVENT).parquet(_written_raw(spark, sf)))


@query("src1_read_raw", with_sql(WIRE_SQL, DAY_COUNTS + " AND event_time >= TIMESTAMP '2024-01-09' AND event_time < TIMESTAMP '2024-01-13' GROUP BY ALL"))
def _(spark, sf):
    start, end = (F.lit(d).cast("timestamp") for d in ("2024-01-09 10:00:00", "2024-01-12 10:00:00"))
    return _per_hour(R.read_raw(spark, _written_raw(spark, sf), start, end))


@query("src2_incremental_raw", with_sql(WIRE_SQL, DAY_COUNTS + " GROUP BY ALL"))
def _(spark, sf):
    path, out, mark = _written_raw(spark, sf), scratch_dir(spark, "copy"), scratch_dir(spark, "mark")
    # The second run finds nothing new: its checkpoint knows all files.
    for _ in range(2):
        S.start_append(R.incremental_raw(spark, path), out, mark, available_now=True).awaitTermination()
    return _per_hour(spark.read.schema(schemas.RAW_EVENT).parquet(out))


# Fixed value: lines of a wire file.
FILE_LINES = 1 << 18


def _written_wire(spark, sf, files=4):
    """Wire text in `files` files, more of them for more lines."""
    path = scratch_dir(spark, "wire")
    lines = A.wire_lines(spark, sf).select("value")
    lines.repartition(max(files, math.ceil(lines.count() / FILE_LINES))).write.text(path)
    return path


@query("src3_read_events_json", with_sql(WIRE_SQL, "SELECT result, count(*) AS records FROM wire GROUP BY result"))
def _(spark, sf):
    return I.outcome_counts(I.route_events(R.read_events_json(spark, _written_wire(spark, sf))))


def _written_capture(spark, sf):
    """Capture files per day; every seventeenth line is cut short."""
    path = scratch_dir(spark, "capture")
    p = A.predictions(spark, sf)
    no = F.substring("inference_id", 5, 20).cast("bigint")
    output = F.to_json(F.struct("churn_probability", (F.col("churn_prediction") == 1).alias("churn_prediction")))
    answer = F.struct(F.when(no % 2 == 0, output).alias("data"), F.when(no % 2 != 0, output).alias("body"))
    line = F.to_json(F.struct(
        F.col("inference_id").alias("inferenceId"),
        F.struct(
            F.date_format("inference_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("inferenceTime"),
            F.struct("customer_id").alias("customAttributes"),
        ).alias("eventMetadata"),
        F.struct(answer.alias("endpointOutput")).alias("captureData"),
    ))
    day = F.date_format("inference_timestamp", "yyyy/MM/dd")
    rows = p.select(F.when(no % 17 == 0, F.substring(line, 1, 40)).otherwise(line).alias("value"), day.alias("day"))
    staged = scratch_dir(spark, "staged")
    rows.repartition("day").write.partitionBy("day").text(staged)
    for row in rows.select("day").distinct().collect():
        spark.read.text(f"{staged}/day={row['day'].replace('/', '%2F')}").select("value").write.text(f"{path}/{row['day']}")
    return path


@query("src4_read_capture", with_sql(LABELS_SQL, f"""
SELECT inference_id, customer_id, {r("churn_probability", "churn_probability")}, churn_prediction, inference_timestamp FROM predictions
WHERE CAST(substr(inference_id, 5) AS BIGINT) % 17 <> 0 AND inference_timestamp >= TIMESTAMP '2024-01-08' AND inference_timestamp < TIMESTAMP '2024-01-11'"""))
def _(spark, sf):
    return L.read_capture(spark, _written_capture(spark, sf), dt.date(2024, 1, 8), dt.date(2024, 1, 10))


@query("src5_read_outcomes", with_sql(LABELS_SQL, """
SELECT customer_id, churned, outcome_date FROM outcomes WHERE outcome_date BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-14'"""))
def _(spark, sf):
    path, rows = scratch_dir(spark, "outcomes"), cut_lineage(A.outcomes(spark, sf), "outcomes")
    for row in rows.select(F.to_date("outcome_date").alias("day")).distinct().collect():
        rows.where(F.to_date("outcome_date") == F.lit(row["day"])).write.parquet(f"{path}/{row['day']:%Y/%m/%d}")
    return L.read_outcomes(spark, path, dt.date(2024, 1, 10), dt.date(2024, 1, 14))


@query("src9_partition_exists", with_sql(WIRE_SQL, """
SELECT 5 AS day, count(*) FILTER (WHERE day(event_time) = 5) > 0 AS present FROM wire WHERE result = 'Ok'
UNION ALL SELECT 31, count(*) FILTER (WHERE day(event_time) = 31) > 0 FROM wire WHERE result = 'Ok'"""))
def _(spark, sf):
    raw = spark.read.schema(schemas.RAW_EVENT).parquet(_written_raw(spark, sf))
    return spark.createDataFrame([(d, N.has_partition(raw, F.col("day") == d)) for d in (5, 31)], "day int, present boolean")


@query("snk2_write_quarantine", with_sql(WIRE_SQL, """
SELECT regexp_extract(reason, '^[a-z_]+') AS error_type, reason, DATE '2024-01-31' AS date, count(*) AS records
FROM wire WHERE result = 'ProcessingFailed' GROUP BY ALL"""))
def _(spark, sf):
    path = scratch_dir(spark, "quarantine")
    W.write_quarantine(I.rejected(I.route_events(A.wire_lines(spark, sf)), _etl()), path)
    return spark.read.parquet(path).groupBy("error_type", "reason", "date").agg(F.count(F.lit(1)).alias("records"))


def _event_table(spark, path=None):
    fields = [f for f in schemas.CURATED_EVENT.fields if f.name != "feature_flags"]
    return T.VersionedTable(
        spark, path or scratch_dir(spark, "events"), schemas.T.StructType(fields), ["event_year", "event_month", "event_day"])


def _table_sides(spark, sf):
    """The two sides of the merge queries, as whole curated rows; in the delivery every fifth event has moved a day."""
    rows = A.curated_events(spark, sf).drop("feature_flags")
    no = F.col("event_id").cast("long")
    target = rows.where(F.col("event_timestamp") < "2024-01-16").withColumn("_etl_timestamp", F.lit("2024-02-01").cast("timestamp"))
    moved = F.when(no % 5 == 0, F.col("event_timestamp") + F.make_dt_interval(days=F.lit(1))).otherwise(F.col("event_timestamp"))
    incoming = rows.where(F.col("event_timestamp") >= "2024-01-10").withColumns({
        "event_timestamp": moved, "session_duration": F.col("session_duration") + 1000,
        "_etl_timestamp": F.when(no % 3 == 0, F.lit("2024-01-31")).when(no % 3 == 1, F.lit("2024-02-01"))
        .otherwise(F.lit("2024-02-02")).cast("timestamp"),
    })
    time = "event_timestamp"
    return target, incoming.withColumns({"event_year": F.year(time), "event_month": F.month(time), "event_day": F.dayofmonth(time), "event_hour": F.hour(time)})


UPSERTED = """
SELECT coalesce(t.event_id, s.event_id) AS event_id,
       CASE WHEN t.event_id IS NULL OR t._etl_timestamp < s._etl_timestamp THEN s.session_duration ELSE t.session_duration END AS session_duration,
       CAST(day(CASE WHEN t.event_id IS NULL OR t._etl_timestamp < s._etl_timestamp
                THEN s.event_timestamp + to_days(CASE WHEN CAST(s.event_id AS BIGINT) % 5 = 0 THEN 1 ELSE 0 END) ELSE t.event_timestamp END) AS INTEGER) AS event_day
FROM merge_target t FULL JOIN merge_incoming s ON t.event_id = s.event_id"""


def _upserted(spark, sf):
    table, (target, incoming) = _event_table(spark), _table_sides(spark, sf)
    table.upsert(target, "event_id", "_etl_timestamp", dt.datetime(2024, 2, 1), "first")
    table.upsert(incoming, "event_id", "_etl_timestamp", dt.datetime(2024, 2, 2), "second")
    # Delivered again: nothing may change.
    table.upsert(incoming, "event_id", "_etl_timestamp", dt.datetime(2024, 2, 3), "third")
    return table


@query("snk3_table_upsert", with_sql(MERGE_SQL, UPSERTED))
def _(spark, sf):
    return _upserted(spark, sf).read().select("event_id", "session_duration", "event_day")


@query("snk9_compact", with_sql(MERGE_SQL, "SELECT *, TRUE AS in_order, TRUE AS one_file FROM (" + UPSERTED + ")"))
def _(spark, sf):
    """Content as before; inside a file the rows are in order, and a partition that fits into a file is one file."""
    table = _upserted(spark, sf)
    table.compact(["customer_id", "event_timestamp"], dt.datetime(2024, 2, 4))
    placed = cut_lineage(table.read().select("*", F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("no")), "placed")
    at = F.struct("customer_id", "event_timestamp")
    ordered = F.coalesce(at >= F.lag(at).over(Window.partitionBy("file").orderBy("no")), F.lit(True))
    files = placed.groupBy("event_year", "event_month", "event_day").agg(F.count_distinct("file").alias("files"))
    return placed.withColumn("in_order", ordered).join(files, ["event_year", "event_month", "event_day"]).select(
        "event_id", "session_duration", "event_day", "in_order", (F.col("files") == 1).alias("one_file"))


@query("snk11_read_as_of", with_sql(MERGE_SQL, "SELECT event_id, session_duration FROM merge_target"))
def _(spark, sf):
    return _upserted(spark, sf).read(at=dt.datetime(2024, 2, 1, 12)).select("event_id", "session_duration")


@query("snk4_overwrite_partitions", with_sql(SNAPSHOTS_SQL, """
SELECT snapshot_date, count(*) AS customers, CAST(sum(total_events_all_time) AS BIGINT) AS events, max(CASE snapshot_date WHEN DATE '2024-01-31' THEN '2.0' ELSE '1.0' END) AS version
FROM snapshots GROUP BY snapshot_date"""))
def _(spark, sf):
    path = scratch_dir(spark, "snapshots")
    W.overwrite_partitions(snapshots(spark, sf), path, ["snapshot_date"])
    again = X.build_features(A.curated_events(spark, sf), A.as_of(), version="2.0")
    W.overwrite_partitions(again, path, ["snapshot_date"])
    return N.read_features(spark, path).groupBy("snapshot_date").agg(
        F.count(F.lit(1)).alias("customers"), F.sum("total_events_all_time").alias("events"), F.max("_feature_version").alias("version"))


@query("snk5_write_splits", """
SELECT split, count(*) AS rows, """ + r("avg(is_churned)", "churn_rate") + """ FROM (
  SELECT is_churned, CASE WHEN place <= floor(size * 0.2 + 0.5) THEN 'test' WHEN place <= floor(size * 0.2 + 0.5) + floor(size * 0.1 + 0.5) THEN 'validation' ELSE 'train' END AS split
  FROM (SELECT is_churned, row_number() OVER (PARTITION BY is_churned ORDER BY h, c_custkey) AS place, count(*) OVER (PARTITION BY is_churned) AS size
        FROM (SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS is_churned, CAST('0x' || substr(md5(c_custkey || ':42'), 1, 15) AS BIGINT) AS h FROM customer)))
GROUP BY split""")
def _(spark, sf):
    from ..operators.prep import stratified_split

    rows = A.table(spark, sf, "customer").select("c_custkey", (F.col("c_acctbal") < 0).cast("int").alias("is_churned"))
    return W.write_splits(stratified_split(rows, key="c_custkey"), scratch_dir(spark, "splits"), "2024-01-31")


@query("snk6_write_merged_labels", with_sql(MERGED_SQL, f"SELECT inference_id, prediction, label, {r('probability', 'probability')} FROM merged"))
def _(spark, sf):
    path = W.write_merged_labels(_merged(spark, sf), scratch_dir(spark, "labels"), "2024-01-31")
    return spark.read.option("header", True).schema(schemas.MERGED_LABEL).csv(path)


@query("snk7_append_drift_summaries", with_sql(LOG_SQL, f"""
SELECT 'dev' AS environment, CAST(hour AS DATE) AS date, schedule, violation_count, {r("drift_score", "drift_score")}, critical_features FROM scores"""))
def _(spark, sf):
    path = scratch_dir(spark, "drift")
    # Recorded twice: the second time replaces the first.
    for _ in range(2):
        W.append_drift_summaries(_scores(spark, sf).withColumnRenamed("hour", "timestamp"), path, "dev")
    schema = "timestamp timestamp, schedule string, violation_count long, drift_score double, critical_features array<string>, environment string, date date"
    return _flat(spark.read.schema(schema).json(path)).select(
        "environment", "date", "schedule", "violation_count", "drift_score", "critical_features")


@query("snk8_append_check_results", with_sql(RAW_SQL, """
SELECT 'raw' AS suite, DATE '2024-01-31' AS date, 'not_null' AS expectation, count(*) FILTER (WHERE customer_id IS NULL) AS unexpected FROM raw
UNION ALL SELECT 'raw', DATE '2024-01-31', 'unique', CAST(sum(n) AS BIGINT) FROM (SELECT count(*) AS n FROM raw GROUP BY event_id HAVING count(*) > 1)"""))
def _(spark, sf):
    path = scratch_dir(spark, "checks")
    results = V.expectations(A.raw_events(spark, sf), [("not_null", "customer_id", {}), ("unique", "event_id", {})])
    for _ in range(2):
        W.append_check_results(results, path, "raw", _etl())
    return spark.read.parquet(path).select("suite", "date", "expectation", "unexpected")


@query("snk10_expirable_versions", """
WITH commits AS (SELECT o_orderkey AS version, CAST(o_orderdate AS TIMESTAMP) AS committed_at FROM orders)
SELECT version, committed_at FROM (SELECT *, row_number() OVER (ORDER BY version DESC) AS place FROM commits)
WHERE place > 10 AND committed_at < TIMESTAMP '1998-06-02' - INTERVAL 7 DAY""")
def _(spark, sf):
    commits = A.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("version"), F.col("o_orderdate").cast("timestamp").alias("committed_at"))
    return T.expirable_versions(commits, F.lit("1998-06-02").cast("timestamp"))


@query("snk12_partition_age_report", """
SELECT DISTINCT CAST(o_orderdate AS DATE) AS date, CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-08-02') AS INTEGER) AS age_days,
       CASE WHEN DATE '2001-08-02' - CAST(o_orderdate AS DATE) >= 2555 THEN 'delete' WHEN DATE '2001-08-02' - CAST(o_orderdate AS DATE) >= 365 THEN 'archive'
            WHEN DATE '2001-08-02' - CAST(o_orderdate AS DATE) >= 90 THEN 'cold' ELSE 'hot' END AS tier FROM orders""")
def _(spark, sf):
    days = A.table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("date")).distinct()
    return T.partition_age_report(days, F.lit("2001-08-02").cast("timestamp"))


def _segment_calls(spark, sf):
    base, k = dealt(A.with_customer(spark, sf)), F.col("k")
    types = F.array(*[F.lit(t) for t in ("track", "identify", "page", "screen", "group", "alias")])
    kind = F.get(types, k % 7)
    return base.select("id", F.to_json(F.struct(
        kind.alias("type"), F.when(k % 2 == 0, F.concat(F.lit("ev_"), F.col("kind"))).alias("event"),
        F.col("id").cast("string").alias("messageId"),
        F.when(F.col("id") % 4 == 0, "").when(F.col("id") % 4 != 1, F.concat(F.lit("cust_"), F.col("user_id"))).alias("userId"),
        F.when(F.col("id") % 8 != 0, F.concat(F.lit("anon_"), F.col("user_id"))).alias("anonymousId"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
        F.struct(
            F.when(k % 3 == 0, F.struct(F.lit("mobile").alias("type"))).alias("device"),
            F.struct("cohort", "plan").alias("traits")).alias("context"),
        F.struct(
            # Numbers and the same numbers as text; durations whole, cut short, as text, and text that is no whole number.
            _json(F.when(k % 5 == 0, F.when(F.col("id") % 2 == 0, _quoted(F.col("value"))).otherwise(F.col("value").cast("string")))).alias("revenue"),
            F.when(k % 5 <= 1, F.lit(7.5)).alias("transaction_amount"), _json(_durations(k)).alias("session_duration"),
            _json(F.when(k % 3 == 0, '{"a":true,"b":"x"}')).alias("feature_flags"),
        ).alias("properties"),
    )).alias("value"))


def _quoted(value):
    return F.concat(F.lit('"'), value.cast("string"), F.lit('"'))


def _json(text):
    """JSON text as the value it stands for."""
    return F.parse_json(text)


def _durations(k):
    return F.when(k % 4 == 0, "30.7").when(k % 4 == 1, '"45"').when(k % 4 == 3, '"12.7"')


DURATION_SQL = "CAST(CASE k % 4 WHEN 0 THEN 30 WHEN 1 THEN 45 WHEN 2 THEN 0 END AS INTEGER) AS session_duration, CASE WHEN k % 4 = 3 THEN 'ProcessingFailed' ELSE 'Ok' END AS result"


SEGMENT = """
SELECT CAST(id AS VARCHAR) AS event_id,
       CASE WHEN id % 4 NOT IN (0, 1) THEN 'cust_' || user_id WHEN id % 8 <> 0 THEN 'anon_' || user_id ELSE 'anonymous' END AS customer_id,
       CASE k % 7 WHEN 1 THEN 'profile_update' WHEN 4 THEN 'profile_update' WHEN 2 THEN 'session_start' WHEN 3 THEN 'session_start' WHEN 5 THEN 'feature_usage'
            ELSE CASE WHEN k % 2 = 0 THEN 'ev_' || kind ELSE 'feature_usage' END END AS event_type,
       CASE WHEN k % 3 = 0 THEN 'mobile' ELSE 'unknown' END AS device, """ + DURATION_SQL + """, CASE WHEN k % 3 = 0 THEN '{"a":true,"b":"x"}' ELSE '{}' END AS feature_flags,
       CAST(round(CAST(CASE WHEN k % 5 = 0 THEN value WHEN k % 5 = 1 THEN 7.5 ELSE 0.0 END AS DECIMAL(30,10)), 6) AS DOUBLE) AS transaction_amount,
       cohort, plan FROM base"""
NORMALISED = ["event_id", "customer_id", "event_type", "device", "session_duration", "result", "feature_flags", "transaction_amount", "cohort", "plan"]


def _routed(events):
    """Normalised events on the route of all others, which converts or rejects their values."""
    return I.route_events(K.as_wire(events))


@query("ing9_normalize_segment", with_sql(CURATED_SQL, SEGMENT))
def _(spark, sf):
    return _routed(K.normalize_segment(_segment_calls(spark, sf), _etl())).select(*NORMALISED)


def _amplitude_calls(spark, sf):
    """Calls with one to three events each."""
    base, k = dealt(A.with_customer(spark, sf)), F.col("k")

    def event(i):
        return F.struct(
            F.concat_ws("-", F.col("id").cast("string"), i.cast("string")).alias("event_id"),
            F.when(k % 4 != 0, F.concat(F.lit("cust_"), F.col("user_id"))).alias("user_id"),
            F.concat(F.lit("dev_"), F.col("user_id")).alias("device_id"),
            F.when(k % 5 == 0, "[Amplitude] Start Session").when(k % 5 == 1, F.concat(F.lit("Did "), F.initcap("kind"))).alias("event_type"),
            F.when(k % 9 != 0, F.unix_millis("ts")).alias("time"), F.when(k % 2 == 0, "IOS").alias("platform"),
            F.struct(
                _json(F.when(k % 2 == 0, _quoted(F.col("value"))).otherwise(F.col("value").cast("string"))).alias("revenue"),
                _json(_durations(k)).alias("session_duration"), _json(F.when(k % 3 == 0, '{"a":true,"b":"x"}')).alias("feature_flags"),
            ).alias("event_properties"), F.struct("cohort", "plan").alias("user_properties"))

    return base.select("id", F.to_json(F.struct(F.transform(F.sequence(F.lit(0), k % 3), event).alias("events"))).alias("value"))


AMPLITUDE = """
SELECT id || '-' || i AS event_id, CASE WHEN k % 4 <> 0 THEN 'cust_' || user_id ELSE 'dev_' || user_id END AS customer_id,
       CASE k % 5 WHEN 0 THEN 'session_start' WHEN 1 THEN 'did_' || kind ELSE 'feature_usage' END AS event_type,
       CASE WHEN k % 2 = 0 THEN 'ios' ELSE 'unknown' END AS device, """ + DURATION_SQL + """, CASE WHEN k % 3 = 0 THEN '{"a":true,"b":"x"}' ELSE '{}' END AS feature_flags,
       CAST(round(CAST(value AS DECIMAL(30,10)), 6) AS DOUBLE) AS transaction_amount, cohort, plan,
       CASE WHEN k % 9 <> 0 THEN date_trunc('millisecond', ts) ELSE TIMESTAMP '1970-01-01' END AS event_timestamp
FROM (SELECT *, unnest(range(0, k % 3 + 1)) AS i FROM base)"""


@query("ing10_normalize_amplitude", with_sql(CURATED_SQL, AMPLITUDE))
def _(spark, sf):
    return _routed(K.normalize_amplitude(_amplitude_calls(spark, sf))).select(*NORMALISED, F.col("timestamp").alias("event_timestamp"))


@query("ing11_dispatch", with_sql(CURATED_SQL, f"""
SELECT 'segment' AS outcome, count(*) AS records FROM base UNION ALL SELECT 'amplitude', count(*) FROM ({AMPLITUDE})
UNION ALL SELECT 'unknown_source', count(*) FROM base UNION ALL SELECT 'invalid_json', count(*) FROM base"""))
def _(spark, sf):
    segment = _segment_calls(spark, sf).withColumn("source", F.lit("segment"))
    amplitude = _amplitude_calls(spark, sf).withColumn("source", F.lit("amplitude"))
    other = segment.withColumn("source", F.lit("mixpanel"))
    torn = segment.withColumn("value", F.substring("value", 1, 10))
    events, rejected = K.dispatch(segment.unionByName(amplitude).unionByName(other).unionByName(torn), _etl())
    counted = events.groupBy(F.col("metadata.source").alias("outcome")).agg(F.count(F.lit(1)).alias("records"))
    return counted.unionByName(rejected.groupBy(F.col("error_type").alias("outcome")).agg(F.count(F.lit(1)).alias("records")))


@query("ing11_webhooks_to_raw", with_sql(CURATED_SQL, f"""
SELECT customer_id, event_type, count(*) AS records FROM ({SEGMENT}) WHERE result = 'Ok' GROUP BY ALL"""))
def _(spark, sf):
    rows = I.accepted(_routed(K.normalize_segment(_segment_calls(spark, sf), _etl())), _etl())
    return rows.groupBy("customer_id", "event_type").agg(F.count(F.lit(1)).alias("records"))


@query("str1_stream_ingest", with_sql(WIRE_SQL, "SELECT result, count(*) AS records FROM wire WHERE result <> 'Dropped' GROUP BY result"))
def _(spark, sf):
    raw, bad, mark = (scratch_dir(spark, n) for n in ("raw", "quarantine", "mark"))
    wire = _written_wire(spark, sf)
    moments = iter([dt.datetime(2024, 1, 31, 23, 59), dt.datetime(2024, 2, 1, 0, 1)])

    def ingest(checkpoint):
        """All files as one batch; the clock is only asked for a batch that is seen for the first time."""
        lines = R.read_events_json(spark, wire, streaming=True)
        S.start_ingest(lines, raw, bad, checkpoint, available_now=True, clock=lambda: next(moments)).awaitTermination()

    ingest(mark)
    # The batch is repeated after midnight, as after a failure before its commit: nothing may count twice.
    lines = spark.read.text(wire)
    moment = S.batch_moment(spark, f"{mark}-moments", 0, lambda: next(moments))
    S.write_batch(lines, 0, raw, bad, F.lit(moment).cast("timestamp"))

    def counted(df, result):
        return df.agg(F.count(F.lit(1)).alias("records")).select(F.lit(result).alias("result"), "records")

    return counted(spark.read.schema(schemas.RAW_EVENT).parquet(raw), "Ok").unionByName(
        counted(spark.read.parquet(bad), "ProcessingFailed"))


@query("str2_stream_dedup", with_sql(RAW_SQL, "SELECT event_id, count(DISTINCT event_id) AS copies FROM raw WHERE event_time IS NOT NULL GROUP BY event_id"))
def _(spark, sf):
    source, out, mark = (scratch_dir(spark, n) for n in ("deliveries", "unique", "mark"))
    timed = C.with_event_time(A.raw_events(spark, sf)).where(F.col("event_timestamp").isNotNull())
    timed.select("event_id", "event_timestamp", "session_duration").repartition(4).write.parquet(source)
    stream = spark.readStream.schema("event_id string, event_timestamp timestamp, session_duration int").parquet(source)
    S.start_append(S.deduplicated_stream(stream), out, mark, available_now=True).awaitTermination()
    return spark.read.parquet(out).groupBy("event_id").agg(F.count(F.lit(1)).alias("copies"))


@query("str3_lateness", with_sql(CURATED_SQL, """
SELECT event_timestamp < (SELECT max(event_timestamp) FROM curated) - INTERVAL 25 HOUR AS late, count(*) AS records FROM curated GROUP BY 1"""))
def _(spark, sf):
    events = A.curated_events(spark, sf)
    marked = S.with_lateness(events, events.agg(F.max("event_timestamp")).scalar())
    return marked.groupBy("late").agg(F.count(F.lit(1)).alias("records"))


@query("str3_late_rows", with_sql(CURATED_SQL, f"""
SELECT CASE WHEN event_timestamp < TIMESTAMP '{A.HALF_TIME}' AND event_timestamp < (SELECT max(event_timestamp) FROM curated) - INTERVAL 25 HOUR THEN 'late' ELSE 'first' END AS fate,
       count(*) AS records FROM curated GROUP BY 1"""))
def _(spark, sf):
    """The newer half of the events arrives first, then the older half: what is behind the watermark goes to a table of its own."""
    source, out, late, mark = (scratch_dir(spark, n) for n in ("events", "taken", "late", "mark"))
    events = A.curated_events(spark, sf).select("event_id", "event_timestamp")
    newer = F.col("event_timestamp") >= F.lit(A.HALF_TIME).cast("timestamp")
    for half in (newer, ~newer):
        events.where(half).write.mode("append").parquet(source)
        stream = spark.readStream.schema(events.schema).parquet(source)
        Y.start_with_late_table(stream, out, late, mark, available_now=True).awaitTermination()
    fates = [spark.read.parquet(path).select(F.lit(fate).alias("fate")) for path, fate in ((out, "first"), (late, "late"))]
    return fates[0].unionByName(fates[1]).groupBy("fate").agg(F.count(F.lit(1)).alias("records"))


@query("str4_stream_upsert", with_sql(CURATED_ROWS, "SELECT event_id, customer_id, session_duration FROM cur"))
def _(spark, sf):
    source, mark, table = scratch_dir(spark, "curated"), scratch_dir(spark, "mark"), _event_table(spark)
    rows = C.curate(A.raw_events(spark, sf), F.lit("2024-01-01").cast("timestamp"), A.as_of(), F.lit(A.ETL_TS), "curate").drop("feature_flags")
    rows.repartition(3).write.parquet(source)
    stream = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 2).parquet(source)
    S.start_upsert(stream, table, "events", mark, at=ETL, available_now=True).awaitTermination()
    return table.read().select("event_id", "customer_id", "session_duration")


@query("str5_stream_arrivals", with_sql(CURATED_SQL, """
SELECT time_bucket(INTERVAL 15 MINUTE, event_timestamp, TIMESTAMP '1970-01-01') AS window_start, count(*) AS records FROM curated GROUP BY 1
HAVING window_start + INTERVAL 15 MINUTE <= (SELECT max(event_timestamp) FROM curated) - INTERVAL 25 HOUR"""))
def _(spark, sf):
    source, out, mark = (scratch_dir(spark, n) for n in ("curated", "arrivals", "mark"))
    A.curated_events(spark, sf).select("event_id", "event_timestamp").write.parquet(source)
    stream = spark.readStream.schema("event_id string, event_timestamp timestamp").parquet(source)
    S.start_append(S.arrival_counts(stream), out, mark, available_now=True).awaitTermination()
    return spark.read.parquet(out)


@query("str8_observed_outcomes", with_sql(WIRE_SQL, """
SELECT count(*) FILTER (WHERE result = 'Ok') AS ok, count(*) FILTER (WHERE result = 'Dropped') AS dropped, count(*) FILTER (WHERE result = 'ProcessingFailed') AS failed FROM wire"""))
def _(spark, sf):
    out, mark, listener = scratch_dir(spark, "routed"), scratch_dir(spark, "mark"), S.OutcomeListener()
    lines = R.read_events_json(spark, _written_wire(spark, sf), streaming=True, files_per_batch=2)
    routed = S.observed(I.route_events(lines))
    spark.streams.addListener(listener)
    try:
        stream = S.start_append(routed.select("result", "reason", "value"), out, mark, available_now=True)
        listener.watch(stream)
        stream.awaitTermination()
        totals = listener.wait()
    finally:
        spark.streams.removeListener(listener)
    return spark.createDataFrame([tuple(totals[c] for c in ("ok", "dropped", "failed"))], "ok long, dropped long, failed long")




@query("job_curate", with_sql(CURATED_ROWS, """
SELECT CAST(day(event_timestamp) AS INTEGER) AS event_day, count(*) AS events, count(DISTINCT event_id) AS ids FROM cur GROUP BY 1"""))
def _(spark, sf):
    """Two ranges with the same load time, the first of them twice: all of both is in the table, once."""
    path, table = scratch_dir(spark, "raw"), scratch_dir(spark, "curated")
    rows = A.raw_events(spark, sf)
    W.write_raw(_raw_table_rows(rows), path)
    at = dt.datetime.fromisoformat(A.ETL_TS)
    first, second = (dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 16)), (dt.datetime(2024, 1, 16), dt.datetime.fromisoformat(A.AS_OF))
    for start, end in (first, second, first):
        jobs.curate(spark, path, table, start, end, at)
    return jobs.events_table(spark, table).read().groupBy("event_day").agg(
        F.count(F.lit(1)).alias("events"), F.count_distinct("event_id").alias("ids"))


def _raw_table_rows(rows):
    """Raw events in the shape of the raw table; a time that cannot be read has no partition and is left out."""
    timed = C.with_event_time(rows).where(F.col("event_timestamp").isNotNull())
    shaped = timed.withColumn("timestamp", F.col("event_timestamp")).drop("event_timestamp")
    partitions = dict(zip(W.HOURLY, I.partition_columns("timestamp")))
    return shaped.withColumns(partitions).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.RAW_EVENT.fields])
