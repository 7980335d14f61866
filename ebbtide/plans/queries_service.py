"""Service health, alerts and log analytics."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from ..constants import LATENCY_BUCKETS
from ..operators import alerts as K, service as H
from ..session import scratch_dir
from ..sources.paths import exists
from ..streaming import ingest as S, silence as Q, stateful as Y
from . import adapter as A
from .adapter import CURATED_SQL, REQUESTS_SQL, RUNS_SQL, r, with_sql
from .registry import query


def slots_sql(window_s: int = 300, step_s: int = 30, name: str = "rates") -> str:
    us = step_s * 1_000_000
    return f"""
{name} AS (
  SELECT env, slot_end + to_seconds(i * {step_s}) AS ts, CAST(sum(requests) AS BIGINT) AS requests, CAST(sum(errors) AS BIGINT) AS errors,
         CAST(sum(hits) AS BIGINT) AS hits, CAST(sum(positives) AS BIGINT) AS positives
  FROM (SELECT env, make_timestamp((epoch_us(ts) // {us} + 1) * {us}) AS slot_end, count(*) AS requests, count(*) FILTER (WHERE status_code >= 500) AS errors,
               count(*) FILTER (WHERE cached) AS hits, sum(churn_prediction) AS positives FROM requests GROUP BY ALL),
       range(0, {window_s // step_s}) g(i) GROUP BY ALL
)"""


def held(condition: str, by: str, ts: str, for_s: int, step_s: int) -> str:
    """True when the condition held at every step of the last for_s seconds."""
    return (f"({condition}) AND count(*) FILTER (WHERE {condition}) OVER (PARTITION BY {by} ORDER BY {ts} "
            f"RANGE BETWEEN INTERVAL {for_s} SECOND PRECEDING AND CURRENT ROW) = {for_s // step_s + 1}")


RATES_SQL = REQUESTS_SQL + "," + slots_sql()


@query("str6_sliding_rates", with_sql(RATES_SQL, f"""
SELECT env, ts, requests, errors, hits, positives, {r("requests / 300.0", "request_rate")}, {r("errors / requests", "error_ratio")},
       {r("hits / requests", "hit_ratio")}, {r("positives / requests", "positive_ratio")} FROM rates"""))
def _(spark, sf):
    return H.sliding_rates(A.request_log(spark, sf))


@query("obs1_high_error_rate", with_sql(RATES_SQL, f"""
SELECT env, ts, {r("errors / requests", "error_ratio")}, {held("errors / requests > 0.05", "env", "ts", 300, 30)} AS firing FROM rates"""))
def _(spark, sf):
    return H.high_error_rate(A.request_log(spark, sf))


@query("win5_sustained_errors", with_sql(RATES_SQL, f"""
SELECT env, ts, {held("errors > 0", "env", "ts", 120, 30)} AS firing FROM rates"""))
def _(spark, sf):
    rates = H.sliding_rates(A.request_log(spark, sf))
    return K.sustained(rates, ["env"], "ts", F.col("errors") > 0, 120, 30).select("env", "ts", "firing")


SLOTTED = "time_bucket(INTERVAL 5 MINUTE, ts, TIMESTAMP '1970-01-01')"


@query("obs2_latency_percentiles", with_sql(REQUESTS_SQL, f"""
SELECT env, {SLOTTED} AS slot, {r("quantile_cont(latency_ms, 0.5)", "p50")}, {r("quantile_cont(latency_ms, 0.95)", "p95")}, {r("quantile_cont(latency_ms, 0.99)", "p99")}
FROM requests GROUP BY 1, 2"""))
def _(spark, sf):
    return H.latency_percentiles(A.request_log(spark, sf))


GROWTH = "ln(1.01 / 0.99)"
# The bucket of the value of that rank; windows of five minutes end every half minute.
SLIDING_SQL = REQUESTS_SQL + f""",
ends AS (SELECT env, latency_ms, make_timestamp((epoch_us(ts) // 30000000 + 1) * 30000000) + to_seconds(i * 30) AS ts FROM requests, range(0, 10) g(i) WHERE latency_ms IS NOT NULL),
ordered AS (SELECT env, ts, count(*) AS n, list_sort(list(latency_ms)) AS xs FROM ends GROUP BY env, ts),
sliding AS (SELECT env, ts, n, exp(ceil(ln(xs[CAST(floor(0.99 * (n - 1)) AS BIGINT) + 1]) / {GROWTH}) * {GROWTH}) * 0.99 AS p99 FROM ordered)"""


@query("obs2_sliding_quantiles", with_sql(SLIDING_SQL, f"SELECT env, ts, n, {r('p99', 'p99')} FROM sliding"))
def _(spark, sf):
    return H.sliding_quantiles(A.request_log(spark, sf), {"p99": 0.99})


@query("obs16_shipped_latency", with_sql(SLIDING_SQL, f"""
SELECT 'InferenceHighLatency' AS alert, 'warning' AS severity, env AS series, ts, {r("p99 / 1000", "value")}, p99 / 1000 > 0.3 AS met, {held("p99 / 1000 > 0.3", "env", "ts", 600, 30)} AS firing FROM sliding"""))
def _(spark, sf):
    """The shipped rule of latency on sliding windows, as its wording asks."""
    found = H.sliding_quantiles(A.request_log(spark, sf), {"p99": 0.99})
    metrics = found.select(F.lit("p99_seconds").alias("metric"), F.col("env").alias("series"), "ts", (F.col("p99") / 1000).alias("value"))
    return K.evaluate_alerts(metrics, K.rule_table(spark, K.SHIPPED_RULES))


@query("obs2_high_latency", with_sql(REQUESTS_SQL, f"""
SELECT env, slot, {r("p99", "p99")}, {held("p99 > 300", "env", "slot", 300, 300)} AS firing
FROM (SELECT env, {SLOTTED} AS slot, quantile_cont(latency_ms, 0.99) AS p99 FROM requests GROUP BY 1, 2)"""))
def _(spark, sf):
    return H.high_latency(A.request_log(spark, sf))


BOUNDS = ", ".join(str(b) for b in LATENCY_BUCKETS)
HISTOGRAM_SQL = REQUESTS_SQL + f""",
buckets AS (SELECT unnest([{BOUNDS}, 1e9]) AS bound, unnest(range(1, {len(LATENCY_BUCKETS) + 2})) AS i),
histogram AS (
  SELECT env, i, bound, count(*) FILTER (WHERE latency_ms / 1000.0 <= bound) AS cum, count(*) AS total FROM requests, buckets GROUP BY env, i, bound
),
steps AS (
  SELECT *, coalesce(lag(cum) OVER w, 0) AS below, coalesce(lag(bound) OVER w, 0.0) AS low FROM histogram WINDOW w AS (PARTITION BY env ORDER BY i)
)"""


def _quantile_sql(q):
    return f"""(SELECT CASE WHEN s.i > {len(LATENCY_BUCKETS)} THEN {LATENCY_BUCKETS[-1]} ELSE s.low + (s.bound - s.low) * (s.total * {q} - s.below) / nullif(s.cum - s.below, 0) END
        FROM steps s WHERE s.env = e.env AND s.cum >= s.total * {q} ORDER BY s.i LIMIT 1)"""


@query("obs3_histogram_quantiles", with_sql(HISTOGRAM_SQL, f"""
SELECT env, {r(_quantile_sql(0.5), "p50")}, {r(_quantile_sql(0.99), "p99")} FROM (SELECT DISTINCT env FROM requests) e"""))
def _(spark, sf):
    histogram = H.latency_histogram(A.request_log(spark, sf))
    return H.histogram_quantile(H.histogram_quantile(histogram, 0.5, "p50"), 0.99, "p99").drop("cumulative")


@query("obs3_latency_histogram", with_sql(HISTOGRAM_SQL, """
SELECT env, CAST(i AS INTEGER) AS bucket, cum AS cumulative FROM histogram"""))
def _(spark, sf):
    histogram = H.latency_histogram(A.request_log(spark, sf))
    return histogram.select("env", F.posexplode("cumulative").alias("pos", "cumulative")).select(
        "env", (F.col("pos") + 1).alias("bucket"), "cumulative")


@query("obs4_low_hit_ratio", with_sql(RATES_SQL, f"""
SELECT env, ts, {r("hits / requests", "hit_ratio")}, {held("hits / requests < 0.30", "env", "ts", 900, 30)} AS firing FROM rates"""))
def _(spark, sf):
    return H.low_hit_ratio(A.request_log(spark, sf))


@query("obs5_prediction_rate_anomaly", with_sql(REQUESTS_SQL + "," + slots_sql(1800, 300), f"""
SELECT env, ts, {r("positives / requests", "positive_ratio")}, {held("positives / requests > 0.1", "env", "ts", 1800, 300)} AS firing FROM rates"""))
def _(spark, sf):
    return H.prediction_rate_anomaly(A.request_log(spark, sf), limit=0.1)


CANARY_SQL = REQUESTS_SQL + """,
variants AS (
  SELECT variant, avg(CASE WHEN status_code >= 500 THEN 1.0 ELSE 0.0 END) AS error_rate, avg(churn_prediction) AS positive_rate, quantile_cont(latency_ms, 0.99) AS p99
  FROM requests GROUP BY variant
),
comparison AS (
  SELECT c.error_rate AS canary_error_rate, c.positive_rate AS canary_positive_rate, s.positive_rate AS stable_positive_rate, c.p99 AS canary_p99_ms
  FROM variants c, variants s WHERE c.variant = 'canary' AND s.variant = 'stable'
)"""
RATES = ", ".join(r(c, c) for c in ("canary_error_rate", "canary_positive_rate", "stable_positive_rate", "canary_p99_ms"))


@query("jn7_canary_comparison", with_sql(CANARY_SQL, f"SELECT {RATES} FROM comparison"))
def _(spark, sf):
    return H.canary_comparison(A.request_log(spark, sf))


@query("obs6_canary_verdict", with_sql(CANARY_SQL, f"""
SELECT {RATES}, {r("abs(canary_positive_rate - stable_positive_rate) / stable_positive_rate", "rate_deviation")},
       CASE WHEN canary_error_rate > 0.05 OR canary_p99_ms > 500 THEN 'rollback' ELSE 'pass' END AS verdict,
       abs(canary_positive_rate - stable_positive_rate) / stable_positive_rate > 0.5 AS alert FROM comparison"""))
def _(spark, sf):
    return H.canary_verdict(H.canary_comparison(A.request_log(spark, sf)))


@query("obs7_recent_errors", with_sql(REQUESTS_SQL, """
SELECT request_id, ts, customer_id, status_code FROM requests WHERE status_code >= 400 ORDER BY ts DESC, request_id DESC LIMIT 100"""))
def _(spark, sf):
    return H.recent_errors(A.request_log(spark, sf)).select("request_id", "ts", "customer_id", "status_code")


@query("obs8_slow_requests", with_sql(REQUESTS_SQL, f"""
SELECT {SLOTTED} AS slot, count(*) AS "count", {r("avg(latency_ms)", "avg_ms")}, {r("quantile_cont(latency_ms, 0.99)", "p99_ms")}
FROM requests WHERE latency_ms > 200 GROUP BY 1"""))
def _(spark, sf):
    return H.slow_requests(A.request_log(spark, sf))


@query("obs9_auth_failures", with_sql(REQUESTS_SQL, """
SELECT ip, api_key_id, count(*) AS auth_failures FROM requests WHERE status_code IN (401, 403) GROUP BY ip, api_key_id
ORDER BY auth_failures DESC, ip, api_key_id LIMIT 20"""))
def _(spark, sf):
    return H.auth_failures(A.request_log(spark, sf))


@query("obs10_failed_tasks", with_sql(RUNS_SQL, """
SELECT run_id, dag_id, task_id, start, message FROM runs WHERE (message LIKE '%ERROR%' OR message LIKE '%FAILED%') AND dag_id LIKE '%churn%'
ORDER BY start DESC, run_id DESC LIMIT 50"""))
def _(spark, sf):
    return H.failed_tasks(A.run_log(spark, sf)).select("run_id", "dag_id", "task_id", "start", "message")


@query("srt3_top_offenders", with_sql(REQUESTS_SQL, """
SELECT customer_id, count(*) AS errors FROM requests WHERE status_code >= 400 GROUP BY customer_id ORDER BY errors DESC, customer_id LIMIT 20"""))
def _(spark, sf):
    log = A.request_log(spark, sf).where(F.col("status_code") >= 400)
    return log.groupBy("customer_id").agg(F.count(F.lit(1)).alias("errors")).orderBy(F.desc("errors"), "customer_id").limit(20)


@query("obs11_audit_rules", with_sql(A.AUDIT_SQL, """
SELECT time_bucket(INTERVAL 5 MINUTE, event_time, TIMESTAMP '1970-01-01') AS period_start, rule, count(*) AS matches, TRUE AS alarm FROM audit GROUP BY 1, 2"""))
def _(spark, sf):
    return K.apply_rules(A.audit_log(spark, sf), K.audit_rules())


@query("obs12_late_runs", with_sql(RUNS_SQL, """
SELECT run_id, duration_s FROM runs WHERE dag_id = 'churn_features' AND state = 'success' AND duration_s > 7200"""))
def _(spark, sf):
    return H.late_runs(A.run_log(spark, sf), "churn_features").select("run_id", "duration_s")


SAMPLES_SQL = REQUESTS_SQL + """,
samples AS (SELECT q.request_id, 'node_' || (b.user_id % 5) AS node, q.ts, b.k AS restarts, b.k / 100.0 AS idle FROM requests q JOIN base b ON q.request_id = b.id)"""


def _samples(spark, sf):
    log, base = A.request_log(spark, sf).select("request_id", "ts"), A.events(spark, sf).select("id", "user_id", "k")
    return log.join(base, F.col("request_id") == F.col("id")).select(
        "request_id", F.concat(F.lit("node_"), F.col("user_id") % 5).alias("node"), "ts", F.col("k").alias("restarts"),
        (F.col("k") / 100.0).alias("idle"))


@query("obs13_restarts", with_sql(SAMPLES_SQL, """
SELECT request_id, CAST(sum(step) OVER w - first_value(step) OVER w AS BIGINT) AS increase, sum(step) OVER w - first_value(step) OVER w > 3 AS looping
FROM (SELECT *, coalesce(CASE WHEN restarts < lag(restarts) OVER s THEN restarts ELSE restarts - lag(restarts) OVER s END, 0) AS step
      FROM samples WINDOW s AS (PARTITION BY node ORDER BY ts))
WINDOW w AS (PARTITION BY node ORDER BY ts RANGE BETWEEN INTERVAL '899.999999 seconds' PRECEDING AND CURRENT ROW)"""))
def _(spark, sf):
    risen = K.counter_increase(_samples(spark, sf), ["node"], "ts", "restarts", 900, ["request_id"])
    return risen.select("request_id", "increase", (F.col("increase") > 3).alias("looping"))


@query("obs14_busy_nodes", with_sql(SAMPLES_SQL, f"""
SELECT node, slot, {r("utilisation", "utilisation")}, {held("utilisation > 0.51234", "node", "slot", 900, 300)} AS firing
FROM (SELECT node, {SLOTTED} AS slot, avg(1 - idle) AS utilisation FROM samples GROUP BY 1, 2)"""))
def _(spark, sf):
    return H.busy_nodes(_samples(spark, sf), limit=0.51234)


@query("obs15_gateway_alarms", with_sql(REQUESTS_SQL, f"""
SELECT minute, errors_5xx, {r("p99", "p99_ms")}, {held("errors_5xx > 0", "1", "minute", 60, 60)} AS errors_alarm, {held("p99 > 500", "1", "minute", 120, 60)} AS latency_alarm
FROM (SELECT date_trunc('minute', ts) AS minute, count(*) FILTER (WHERE status_code >= 500) AS errors_5xx, quantile_cont(latency_ms, 0.99) AS p99 FROM requests GROUP BY 1)"""))
def _(spark, sf):
    return H.gateway_alarms(A.request_log(spark, sf), max_5xx=0)


RULES = [
    ("HighErrorRate", "error_ratio", ">", 0.05, 300, 30, "critical"),
    ("LowCacheHitRatio", "hit_ratio", "<", 0.30, 900, 30, "warning"),
    ("Quiet", "requests", "<=", 50.0, 0, 30, "info"),
]


def _rule_sql(alert, metric, op, threshold, for_s, step_s, severity):
    value = {"error_ratio": "errors / requests", "hit_ratio": "hits / requests", "requests": "CAST(requests AS DOUBLE)"}[metric]
    met = f"{value} {op} {threshold}"
    return (f"SELECT '{alert}' AS alert, '{severity}' AS severity, env AS series, ts, {r(value, 'value')}, {met} AS met, "
            f"{held(met, 'env', 'ts', for_s, step_s)} AS firing FROM rates")


EVALUATED = " UNION ALL ".join(_rule_sql(*rule) for rule in RULES)


def _evaluated(spark, sf):
    rates = H.sliding_rates(A.request_log(spark, sf)).withColumn("requests", F.col("requests").cast("double"))
    metrics = rates.unpivot(["env", "ts"], ["error_ratio", "hit_ratio", "requests"], "metric", "value").withColumnRenamed("env", "series")
    return K.evaluate_alerts(metrics, K.rule_table(spark, RULES))


@query("obs16_evaluate_alerts", with_sql(RATES_SQL, EVALUATED))
def _(spark, sf):
    return _evaluated(spark, sf)


@query("obs16_firing_alerts", with_sql(RATES_SQL, f"""
SELECT alert, severity, series, min(ts) AS first_fired, max(ts) AS last_fired, count(*) AS steps FROM ({EVALUATED}) WHERE firing GROUP BY ALL"""))
def _(spark, sf):
    return K.firing_alerts(_evaluated(spark, sf))


DELAY_S = 615  # no sample lies on the watermark


@query("obs16_stream_states", with_sql(RATES_SQL, f"""
SELECT * FROM ({EVALUATED}) WHERE ts < (SELECT max(ts) FROM rates) - INTERVAL {DELAY_S} SECOND"""))
def _(spark, sf):
    """The rules as state machines on the stream of rates: the rows that the watermark has passed are those of the batch form."""
    source, out, mark = (scratch_dir(spark, n) for n in ("metrics", "states", "mark"))
    rates = H.sliding_rates(A.request_log(spark, sf)).withColumn("requests", F.col("requests").cast("double"))
    metrics = rates.unpivot(["env", "ts"], ["error_ratio", "hit_ratio", "requests"], "metric", "value")
    metrics.select("metric", F.col("env").alias("series"), "ts", "value").write.parquet(source)
    stream = spark.readStream.schema("metric string, series string, ts timestamp, value double").parquet(source)
    S.start_append(Y.alert_states(stream, K.rule_table(spark, RULES), f"{DELAY_S} seconds"), out, mark, available_now=True).awaitTermination()
    return spark.read.parquet(out).where(F.col("met").isNotNull()).drop("state")


@query("str5_arrivals", with_sql(CURATED_SQL, """
SELECT time_bucket(INTERVAL 15 MINUTE, event_timestamp, TIMESTAMP '1970-01-01') AS window_start, count(*) AS records FROM curated GROUP BY 1"""))
def _(spark, sf):
    return H.arrivals(A.curated_events(spark, sf), "event_timestamp")


@query("str7_silent_windows", with_sql(CURATED_SQL, f"""
SELECT w AS window_start FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '{A.AS_OF}' - INTERVAL 15 MINUTE, INTERVAL 15 MINUTE)) AS w)
WHERE w NOT IN (SELECT time_bucket(INTERVAL 15 MINUTE, event_timestamp, TIMESTAMP '1970-01-01') FROM curated)"""))
def _(spark, sf):
    start = F.lit("2024-01-01").cast("timestamp")
    return H.silent_windows(A.curated_events(spark, sf), "event_timestamp", start, A.as_of())


STREAM_SLIDING = """
SELECT env, ts, requests, errors FROM rates WHERE ts <= (SELECT max(ts) FROM requests) - INTERVAL 10 MINUTE"""


@query("str6_stream_sliding", with_sql(RATES_SQL, STREAM_SLIDING))
def _(spark, sf):
    """The stream's windows that the watermark has passed are those of the batch form."""
    source, out, mark = (scratch_dir(spark, n) for n in ("requests", "sliding", "mark"))
    A.request_log(spark, sf).select("env", "ts", "status_code").write.parquet(source)
    stream = spark.readStream.schema("env string, ts timestamp, status_code int").parquet(source)
    S.start_append(S.sliding_counts(stream), out, mark, available_now=True).awaitTermination()
    return spark.read.parquet(out)


@query("str7_stream_silence", with_sql(CURATED_SQL, """
SELECT device AS source, event_timestamp AS last_seen FROM (
  SELECT device, event_timestamp, lead(event_timestamp) OVER (PARTITION BY device ORDER BY event_timestamp) AS next FROM curated WHERE device IS NOT NULL)
WHERE coalesce(next >= event_timestamp + INTERVAL 2 MINUTE, TRUE)
  AND event_timestamp + INTERVAL 2 MINUTE <= (SELECT max(event_timestamp) FROM curated WHERE device IS NOT NULL) - INTERVAL 1 MINUTE"""))
def _(spark, sf):
    """Ends of the sessions per source that the watermark has passed."""
    source, out, mark = (scratch_dir(spark, n) for n in ("heard", "silent", "mark"))
    A.curated_events(spark, sf).where(F.col("device").isNotNull()).select("device", "event_timestamp").write.parquet(source)
    stream = spark.readStream.schema("device string, event_timestamp timestamp").parquet(source)
    S.start_append(Q.silent_sources(stream, "device", minutes=2), out, mark, available_now=True).awaitTermination()
    return spark.read.parquet(out)


@query("str7_silence_of_all", with_sql(CURATED_SQL, """
SELECT device AS source, max(event_timestamp) AS last_seen FROM curated WHERE device IS NOT NULL GROUP BY 1"""))
def _(spark, sf):
    """All events arrive, then nothing does: every source falls silent by the stream's own clock, once."""
    source, out, mark = (scratch_dir(spark, n) for n in ("heard", "silent", "mark"))
    A.curated_events(spark, sf).where(F.col("device").isNotNull()).select("device", "event_timestamp").write.parquet(source)
    heard = spark.read.parquet(source).select("device").distinct().count()
    stream = spark.readStream.schema("device string, event_timestamp timestamp").parquet(source)
    found = Y.silent_by_timer(stream, "device", seconds=1).writeStream.format("parquet").option("path", out).option("checkpointLocation", mark)
    running = found.trigger(processingTime="500 milliseconds").start()
    try:
        until = time.monotonic() + 120
        while time.monotonic() < until and not (exists(spark, f"{out}/_spark_metadata") and spark.read.schema("source string").parquet(out).count() >= heard):
            if running.exception():
                raise running.exception()
            time.sleep(0.5)
    finally:
        running.stop()
    return spark.read.parquet(out).select("source", "last_seen")


def _shipped_sql():
    parts = []
    for alert, metric, op, threshold, for_s, step_s, severity in K.SHIPPED_RULES:
        if metric in ("error_ratio", "hit_ratio"):
            value = {"error_ratio": "errors / requests", "hit_ratio": "hits / requests"}[metric]
            met = f"({value} {op} {threshold})"
            firing = held(met, "env", "ts", for_s, step_s)
            parts.append(f"SELECT '{alert}' AS alert, '{severity}' AS severity, env AS series, ts, {r(value, 'value')}, {met} AS met, {firing} AS firing FROM rates")
    return " UNION ALL ".join(parts)


@query("obs16_shipped_rules", with_sql(RATES_SQL, _shipped_sql()))
def _(spark, sf):
    """The shipped rules on the rates of the request log; rules whose metric is not there raise nothing."""
    rates = H.sliding_rates(A.request_log(spark, sf))
    pairs = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in ("error_ratio", "hit_ratio")])).alias("p")
    metrics = rates.select(F.col("env").alias("series"), "ts", pairs).select("p.metric", "series", "ts", "p.value")
    return K.evaluate_alerts(metrics, K.rule_table(spark, K.SHIPPED_RULES))
