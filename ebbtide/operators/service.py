"""Health of the scoring service and of the jobs, from request, run and metric logs.

Rates over sliding windows are built from per-slot sums: the log is reduced to one row per key
and slot with partial aggregation before anything is multiplied by the overlap of the windows.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..constants import CANARY_MAX_ERROR_RATE, CANARY_MAX_P99_MS, CANARY_MAX_RATE_DEVIATION, LATENCY_BUCKETS
from ..functions.running import exact_percentiles
from ..functions.scalars import ratio, time_slot
from .alerts import sustained

SLOT_S, WINDOW_S = 30, 300


def _failed() -> Column:
    return F.col("status_code") >= 500


def slot_sums(log: DataFrame, by: Sequence[str] = ("env",), slot_s: int = SLOT_S) -> DataFrame:
    """Requests, errors, cache hits and positives per key and slot; `slot_end` closes the slot."""
    end = time_slot(F.col("ts"), slot_s) + F.make_dt_interval(secs=F.lit(slot_s))
    return log.groupBy(*by, end.alias("slot_end")).agg(
        F.count(F.lit(1)).alias("requests"), F.count_if(_failed()).alias("errors"), F.count_if(F.col("cached")).alias("hits"),
        F.sum(F.col("churn_prediction").cast("long")).alias("positives"),
    )


def sliding_rates(log: DataFrame, by: Sequence[str] = ("env",), window_s: int = WINDOW_S, step_s: int = SLOT_S) -> DataFrame:
    """Sums and ratios over the window ending at each step."""
    slots = slot_sums(log, by, step_s)
    ends = F.transform(
        F.sequence(F.lit(0), F.lit(window_s // step_s - 1)), lambda i: F.col("slot_end") + F.make_dt_interval(secs=i * step_s)
    )
    summed = slots.withColumn("ts", F.explode(ends)).groupBy(*by, "ts").agg(
        *[F.sum(c).alias(c) for c in ("requests", "errors", "hits", "positives")]
    )
    total = F.col("requests")
    return summed.withColumns({
        "request_rate": total / F.lit(float(window_s)), "error_ratio": ratio(F.col("errors"), total),
        "hit_ratio": ratio(F.col("hits"), total), "positive_ratio": ratio(F.col("positives"), total),
    })


def high_error_rate(log: DataFrame, limit: float = 0.05, for_s: int = 300) -> DataFrame:
    rates = sliding_rates(log)
    return sustained(rates, ["env"], "ts", F.col("error_ratio") > limit, for_s, SLOT_S).select("env", "ts", "error_ratio", "firing")


def low_hit_ratio(log: DataFrame, limit: float = 0.30, for_s: int = 900) -> DataFrame:
    rates = sliding_rates(log)
    return sustained(rates, ["env"], "ts", F.col("hit_ratio") < limit, for_s, SLOT_S).select("env", "ts", "hit_ratio", "firing")


def prediction_rate_anomaly(log: DataFrame, limit: float = 0.50, window_s: int = 1800, step_s: int = 300, for_s: int = 1800) -> DataFrame:
    """Share of positive predictions over half an hour, too high for half an hour."""
    rates = sliding_rates(log, window_s=window_s, step_s=step_s)
    return sustained(rates, ["env"], "ts", F.col("positive_ratio") > limit, for_s, step_s).select("env", "ts", "positive_ratio", "firing")


# Bucket of values that have no logarithm.
LEAST_BUCKET = -(1 << 31)


def latency_percentiles(log: DataFrame, by: Sequence[str] = ("env",), slot_s: int = WINDOW_S) -> DataFrame:
    slotted = log.withColumn("slot", time_slot(F.col("ts"), slot_s))
    return exact_percentiles(slotted, [*by, "slot"], "latency_ms", {"p50": 0.5, "p95": 0.95, "p99": 0.99})


def sliding_quantiles(
    log: DataFrame, probabilities: Mapping[str, float], value: str = "latency_ms", by: Sequence[str] = ("env",), window_s: int = WINDOW_S, step_s: int = SLOT_S,
    error: float = 0.01,
) -> DataFrame:
    """Quantiles of overlapping windows (by, ts = end of the window, n, one column per probability), without counting a row twice.

    Rows are counted once per slot and bucket; buckets grow by (1 + error) / (1 - error), so that a bucket's middle is within
    `error` of every value in it. Windows add the counts of their slots. A quantile is the middle of the bucket that holds the
    value of rank floor(p (n - 1)), counted from 0, and so within `error` of that value. Values of 0 or less count as 0; NULL
    and NaN are left out. A window has at most as many rows as there are buckets.
    """
    growth = math.log((1 + error) / (1 - error))
    x = F.col(value).cast("double")
    bucket = F.when(x > 0, F.ceil(F.log(x) / growth).cast("int")).otherwise(F.lit(LEAST_BUCKET))
    slots = log.where(x.isNotNull() & ~F.isnan(x)).groupBy(*by, (time_slot(F.col("ts"), step_s) + F.make_dt_interval(secs=F.lit(step_s))).alias("_end"), bucket.alias("_bucket"))
    counts = slots.agg(F.count(F.lit(1)).alias("_n"))
    ends = F.transform(F.sequence(F.lit(0), F.lit(window_s // step_s - 1)), lambda i: F.col("_end") + F.make_dt_interval(secs=i * step_s))
    merged = counts.withColumn("ts", F.explode(ends)).groupBy(*by, "ts", "_bucket").agg(F.sum("_n").alias("_n"))
    series = W.partitionBy(*by, "ts").orderBy("_bucket")
    ranked = merged.withColumns({
        "_upto": F.sum("_n").over(series.rowsBetween(W.unboundedPreceding, W.currentRow)), "_all": F.sum("_n").over(W.partitionBy(*by, "ts"))})
    middle = F.when(F.col("_bucket") == LEAST_BUCKET, F.lit(0.0)).otherwise(F.exp(F.col("_bucket") * growth) * (1 - error))

    def at(p: float) -> Column:
        rank = F.floor(F.lit(float(p)) * (F.col("_all") - 1))
        return F.max(F.when((rank >= F.col("_upto") - F.col("_n")) & (rank < F.col("_upto")), middle))

    return ranked.groupBy(*by, "ts").agg(F.max("_all").alias("n"), *[at(p).alias(name) for name, p in probabilities.items()])


def high_latency(log: DataFrame, limit_ms: float = 300.0, for_s: int = 600) -> DataFrame:
    found = latency_percentiles(log)
    # Two neighbouring slots cover ten minutes.
    wait = for_s - WINDOW_S
    return sustained(found, ["env"], "slot", F.col("p99") > limit_ms, wait, WINDOW_S).select("env", "slot", "p99", "firing")


def latency_histogram(log: DataFrame, by: Sequence[str] = ("env",), buckets: Sequence[float] = tuple(LATENCY_BUCKETS)) -> DataFrame:
    """Cumulative request counts per upper bound in seconds, the last one unbounded."""
    seconds = F.col("latency_ms") / 1000.0
    counts = F.array(*[F.count_if(seconds <= b) for b in buckets], F.count("latency_ms"))
    return log.groupBy(*by).agg(counts.alias("cumulative"))


def histogram_quantile(histogram: DataFrame, q: float, name: str = "quantile", buckets: Sequence[float] = tuple(LATENCY_BUCKETS)) -> DataFrame:
    """Quantile by linear interpolation inside the bucket; above the last bound, that bound."""
    bounds = F.array(*[F.lit(float(b)) for b in buckets])
    counts = F.col("cumulative")
    total = F.element_at(counts, -1)
    rank = total * F.lit(q)
    places = F.filter(F.sequence(F.lit(1), F.size(counts)), lambda i: F.element_at(counts, i) >= rank)
    at = F.element_at(places, 1)
    below = F.when(at > 1, F.element_at(counts, F.greatest(at - 1, F.lit(1)))).otherwise(0)
    low = F.when(at > 1, F.element_at(bounds, F.greatest(at - 1, F.lit(1)))).otherwise(0.0)
    high = F.element_at(bounds, F.least(at, F.lit(len(buckets))))
    inside = low + (high - low) * F.coalesce(F.try_divide(rank - below, F.element_at(counts, at) - below), F.lit(0.0))
    value = F.when(total == 0, F.lit(None)).when(at > len(buckets), F.lit(float(buckets[-1]))).otherwise(inside)
    return histogram.withColumn(name, value)


def canary_comparison(log: DataFrame) -> DataFrame:
    """Both variants' rates in one row."""
    canary, stable = F.col("variant") == "canary", F.col("variant") == "stable"
    positive = F.col("churn_prediction").cast("double")
    sums = log.agg(
        F.avg(F.when(canary, _failed().cast("double"))).alias("canary_error_rate"),
        F.avg(F.when(canary, positive)).alias("canary_positive_rate"),
        F.avg(F.when(stable, positive)).alias("stable_positive_rate"),
    )
    p99 = exact_percentiles(log.where(canary), [], "latency_ms", {"p99": 0.99}).scalar()
    return sums.withColumn("canary_p99_ms", p99)


def canary_verdict(comparison: DataFrame) -> DataFrame:
    """Rollback on errors or latency; a deviating rate of positives only alerts. Absent numbers count as zero."""
    error = F.coalesce("canary_error_rate", F.lit(0.0))
    p99 = F.coalesce("canary_p99_ms", F.lit(0.0))
    mine, other = F.coalesce("canary_positive_rate", F.lit(0.0)), F.coalesce("stable_positive_rate", F.lit(0.0))
    deviation = F.when((mine > 0) & (other > 0), F.abs(mine - other) / other)
    verdict = F.when((error > CANARY_MAX_ERROR_RATE) | (p99 > CANARY_MAX_P99_MS), "rollback").otherwise("pass")
    return comparison.withColumns({
        "rate_deviation": deviation, "verdict": verdict,
        "alert": F.coalesce(deviation > CANARY_MAX_RATE_DEVIATION, F.lit(False)),
    })


def recent_errors(log: DataFrame, k: int = 100) -> DataFrame:
    return log.where(F.col("status_code") >= 400).orderBy(F.desc("ts"), F.desc("request_id")).limit(k)


def slow_requests(log: DataFrame, limit_ms: float = 200.0, slot_s: int = WINDOW_S) -> DataFrame:
    """Slow requests per slot: count, mean and 99th percentile."""
    slow = log.where(F.col("latency_ms") > limit_ms).withColumn("slot", time_slot(F.col("ts"), slot_s))
    means = slow.groupBy("slot").agg(F.count(F.lit(1)).alias("count"), F.avg("latency_ms").alias("avg_ms"))
    return means.join(exact_percentiles(slow, ["slot"], "latency_ms", {"p99_ms": 0.99}), "slot").orderBy(F.desc("slot"))


def auth_failures(log: DataFrame, k: int = 20) -> DataFrame:
    counts = log.where(F.col("status_code").isin(401, 403)).groupBy("ip", "api_key_id").agg(F.count(F.lit(1)).alias("auth_failures"))
    return counts.orderBy(F.desc("auth_failures"), "ip", "api_key_id").limit(k)


def failed_tasks(runs: DataFrame, job_like: str = "churn", k: int = 50) -> DataFrame:
    """Newest log lines of our jobs that speak of an error."""
    hit = F.col("message").rlike("ERROR|FAILED") & F.col("dag_id").contains(job_like)
    return runs.where(hit).orderBy(F.desc("start"), F.desc("run_id")).limit(k)


def late_runs(runs: DataFrame, job: str, limit_s: int = 7200) -> DataFrame:
    return runs.where((F.col("dag_id") == job) & (F.col("state") == "success") & (F.col("duration_s") > limit_s))


def arrivals(events: DataFrame, ts: str, minutes: int = 15) -> DataFrame:
    """Records per tumbling window."""
    return events.groupBy(F.window(ts, f"{minutes} minutes").alias("w")).agg(F.count(F.lit(1)).alias("records")).select(
        F.col("w.start").alias("window_start"), "records"
    )


def silent_windows(events: DataFrame, ts: str, start: Column, end: Column, minutes: int = 15) -> DataFrame:
    """Windows between start and end without any record."""
    step = F.make_dt_interval(mins=F.lit(minutes))
    grid = events.sparkSession.range(1).select(F.explode(F.sequence(start, end - step, step)).alias("window_start"))
    return grid.join(arrivals(events.where(F.col(ts).between(start, end)), ts, minutes), "window_start", "left_anti")


def busy_nodes(samples: DataFrame, limit: float = 0.85, slot_s: int = WINDOW_S, for_s: int = 900) -> DataFrame:
    """Mean utilisation per node and slot, and whether it stayed above the limit."""
    used = samples.groupBy("node", time_slot(F.col("ts"), slot_s).alias("slot")).agg(F.avg(1 - F.col("idle")).alias("utilisation"))
    return sustained(used, ["node"], "slot", F.col("utilisation") > limit, for_s, slot_s)


def gateway_alarms(log: DataFrame, max_5xx: int = 10, periods_5xx: int = 2, max_p99_ms: float = 500.0, periods_p99: int = 3) -> DataFrame:
    """Per minute: many server errors in consecutive minutes, slow requests in consecutive minutes."""
    minute = log.withColumn("minute", time_slot(F.col("ts"), 60))
    counts = minute.groupBy("minute").agg(F.count_if(_failed()).alias("errors_5xx"))
    both = counts.join(exact_percentiles(minute, ["minute"], "latency_ms", {"p99_ms": 0.99}), "minute")
    judged = sustained(both, [], "minute", F.col("errors_5xx") > max_5xx, (periods_5xx - 1) * 60, 60, "errors_alarm")
    return sustained(judged, [], "minute", F.col("p99_ms") > max_p99_ms, (periods_p99 - 1) * 60, 60, "latency_alarm")
