"""Rules over time series: sustained conditions, counters with resets, generic thresholds, audit rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def _column(value: Column | int | float) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def _looking_back(df: DataFrame, ts: str, span_s: Column, spans: int) -> DataFrame:
    """Copy each row into its own time bucket and the next ones, so that a bucket sees `spans` spans of history.

    A window per (series, bucket) then holds a bounded stretch of time instead of a whole series.
    """
    micros = span_s.cast("bigint") * 1_000_000
    own = F.floor(F.unix_micros(ts) / micros)
    return df.withColumn("_own", own).withColumn("_bucket", F.explode(F.sequence(F.col("_own"), F.col("_own") + spans)))


def sustained(
    df: DataFrame, keys: Sequence[str], ts: str, condition: Column, for_s: Column | int, step_s: Column | int, name: str = "firing"
) -> DataFrame:
    """Add whether the condition has been true at every step for at least `for_s` seconds.

    A missing step or a false one starts over, as does NULL.
    """
    wait, step = _column(for_s), _column(step_s)
    held = df.withColumn("_ok", F.coalesce(condition, F.lit(False)))
    copies = _looking_back(held, ts, F.greatest(wait, step), 2)
    series = W.partitionBy(*keys, "_bucket").orderBy(ts)
    gap = (F.unix_micros(ts) - F.unix_micros(F.lag(ts).over(series))) / F.lit(1_000_000.0)
    starts = F.col("_ok") & (~F.coalesce(F.lag("_ok").over(series), F.lit(False)) | F.coalesce(gap > step, F.lit(True)))
    marked = copies.withColumn("_start", F.when(starts, F.unix_micros(ts)))
    since = F.max("_start").over(series.rowsBetween(W.unboundedPreceding, W.currentRow))
    long_enough = F.unix_micros(ts) - since >= wait.cast("bigint") * 1_000_000
    return (
        marked.withColumn(name, F.col("_ok") & F.coalesce(long_enough, F.lit(False)))
        .where(F.col("_bucket") == F.col("_own"))
        .select(*df.columns, name)
    )


def counter_increase(samples: DataFrame, keys: Sequence[str], ts: str, value: str, window_s: int, ties: Sequence[str] = ()) -> DataFrame:
    """Add `increase` of a counter over the trailing window; a drop means it was reset to zero.

    Only pairs of samples that both lie in the window count; `ties` order those of one moment. The steps of a window are the difference of two running totals: up
    to its end, and at its first sample, which a probe at its start finds as the next one. A frame that slides would add all of
    its rows up again for every row.
    """
    copies = _looking_back(samples, ts, F.lit(window_s), 1).withColumn("_at", F.unix_micros(ts))
    bucket = W.partitionBy(*keys, "_bucket")
    series, moments = bucket.orderBy("_at", *ties), bucket.orderBy("_at")
    before = F.lag(value).over(series)
    step = F.when(F.col(value) < before, F.col(value)).otherwise(F.col(value) - before)
    # Samples of one moment are numbered, so that both windows see them in one order.
    stepped = copies.withColumns({"_step": F.coalesce(step, F.lit(0)), "_no": F.row_number().over(series)})
    numbered = bucket.orderBy("_at", "_no")
    totals = stepped.withColumns({
        "_total": F.sum("_step").over(numbered.rowsBetween(W.unboundedPreceding, W.currentRow)),
        "_upto": F.sum("_step").over(moments.rangeBetween(W.unboundedPreceding, W.currentRow)),
    })
    own = F.col("_bucket") == F.col("_own")
    probed = totals.withColumn("_probe", F.explode(F.when(own, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))))
    place = F.when(F.col("_probe"), F.col("_at") - window_s * 1_000_000 + 1).otherwise(F.col("_at"))
    backwards = bucket.orderBy(place.desc(), F.col("_probe"), F.col("_no").desc()).rowsBetween(W.unboundedPreceding, W.currentRow)
    first = F.last(F.when(~F.col("_probe"), F.col("_total")), ignorenulls=True).over(backwards)
    return probed.withColumn("increase", F.col("_upto") - first).where("_probe").select(*samples.columns, "increase")


_COMPARE = {">": lambda a, b: a > b, ">=": lambda a, b: a >= b, "<": lambda a, b: a < b, "<=": lambda a, b: a <= b, "==": lambda a, b: a == b}


# The shipped alert rules as (alert, metric, op, threshold, for seconds, step seconds, severity).
SHIPPED_RULES = [
    ("InferenceHighErrorRate", "error_ratio", ">", 0.05, 300, 30, "critical"),
    ("InferenceHighLatency", "p99_seconds", ">", 0.3, 600, 30, "warning"),
    ("InferenceServiceDown", "absent_requests", "==", 1.0, 300, 30, "critical"),
    ("InferenceLowCacheHitRatio", "hit_ratio", "<", 0.30, 900, 30, "warning"),
    ("InferencePredictionRateAnomaly", "positive_ratio", ">", 0.50, 1800, 30, "warning"),
    ("AirflowDAGFailed", "dag_parse_increase", "==", 0.0, 0, 60, "warning"),
    ("AirflowSchedulerNotRunning", "absent_scheduler_heartbeat", "==", 1.0, 300, 60, "critical"),
    ("FeaturePipelineSLABreach", "feature_pipeline_seconds", ">", 7200.0, 0, 60, "warning"),
    ("DataQualityCheckFailed", "data_quality_issues", ">", 0.0, 0, 60, "warning"),
    ("PodCrashLooping", "container_restarts_15m", ">", 3.0, 0, 30, "critical"),
    ("PodOOMKilled", "oom_killed", "==", 1.0, 0, 30, "warning"),
    ("PodNotReady", "pod_not_ready", "==", 1.0, 600, 30, "warning"),
    ("NodeHighCPU", "node_cpu", ">", 0.85, 900, 60, "warning"),
    ("NodeHighMemory", "node_memory", ">", 0.85, 900, 60, "warning"),
    ("PVCUsageHigh", "volume_usage", ">", 0.80, 600, 60, "warning"),
]


def rule_table(spark, rules: Sequence[tuple[str, str, str, float, int, int, str]]) -> DataFrame:
    """(alert, metric, op, threshold, for_s, step_s, severity) as a frame."""
    return spark.createDataFrame(
        rules, "alert string, metric string, op string, threshold double, for_s int, step_s int, severity string"
    )


def rule_met() -> Column:
    """Whether columns value, op and threshold of a sample with its rule hold; NULL without a value or a known op."""
    met = None
    for op, compare in _COMPARE.items():
        branch = compare(F.col("value"), F.col("threshold"))
        met = F.when(F.col("op") == op, branch) if met is None else met.when(F.col("op") == op, branch)
    return met


def evaluate_alerts(metrics: DataFrame, rules: DataFrame) -> DataFrame:
    """Metric samples (metric, series, ts, value) against rules: one row per rule and sample, with `firing`."""
    judged = metrics.join(rules, "metric").withColumn("_met", rule_met())
    fired = sustained(judged, ["alert", "series"], "ts", F.col("_met"), F.col("for_s"), F.col("step_s"))
    return fired.select("alert", "severity", "series", "ts", "value", F.coalesce("_met", F.lit(False)).alias("met"), "firing")


def firing_alerts(evaluated: DataFrame) -> DataFrame:
    """Alerts that fired at all: when first, when last, at how many steps, with the worst value."""
    return evaluated.where("firing").groupBy("alert", "severity", "series").agg(
        F.min("ts").alias("first_fired"), F.max("ts").alias("last_fired"), F.count(F.lit(1)).alias("steps")
    )


def _name_is(*names: str) -> Column:
    return F.col("eventName").isin(*names)


def audit_rules() -> list[tuple[str, Column]]:
    """The seven security rules over audit records."""
    # The names of calls and sources that the rules look for.
    source = F.col("eventSource")
    return [
        ("root_account_usage", (F.col("userIdentity.type") == "Root") & (F.col("eventType") != "AwsServiceEvent")),
        ("console_login_failures", _name_is("ConsoleLogin") & (F.col("errorMessage") == "Failed authentication")),
        ("unauthorized_api_calls", F.col("errorCode").endswith("UnauthorizedAccess") | (F.col("errorCode") == "AccessDenied")),
        ("iam_policy_changes", _name_is(
            "PutUserPolicy", "PutRolePolicy", "PutGroupPolicy", "CreatePolicy", "DeletePolicy", "AttachRolePolicy",
            "DetachRolePolicy")),
        ("s3_bucket_policy_changes", (source == "s3.amazonaws.com") & _name_is("PutBucketPolicy", "PutBucketAcl", "DeleteBucketPolicy")),
        ("kms_key_deletion", (source == "kms.amazonaws.com") & _name_is("DisableKey", "ScheduleKeyDeletion")),
        ("security_group_changes", _name_is(
            "AuthorizeSecurityGroupIngress", "RevokeSecurityGroupIngress", "AuthorizeSecurityGroupEgress",
            "CreateSecurityGroup", "DeleteSecurityGroup")),
    ]


def apply_rules(events: DataFrame, rules: Sequence[tuple[str, Column]], ts: str = "eventTime", period_s: int = 300) -> DataFrame:
    """Matches per rule and period, from one scan; a period without matches has no row and raises nothing."""
    matched = F.filter(F.array(*[F.when(p, F.lit(n)) for n, p in rules]), lambda name: name.isNotNull())
    return (
        events.select(F.window(ts, f"{period_s} seconds").alias("w"), F.explode(matched).alias("rule"))
        .groupBy(F.col("w.start").alias("period_start"), "rule")
        .agg(F.count(F.lit(1)).alias("matches"))
        .withColumn("alarm", F.col("matches") > 0)
    )
