"""Customer features over rolling windows that end at an explicit moment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..constants import FEATURE_VERSION, SNAPSHOT_COLUMNS, SOURCE_DAYS, WINDOW_DAYS

SESSION, DEVICE, ATTRIBUTES = 0, 1, 2


def _since(as_of: Column, days: int) -> Column:
    return as_of - F.make_dt_interval(days=F.lit(days))


def _before(events: DataFrame, as_of: Column, days: int) -> DataFrame:
    time = F.col("event_timestamp")
    return events.where((time >= _since(as_of, days)) & (time < as_of))


def _measures(as_of: Column, days: int) -> list[Column]:
    """Aggregates of one window that need no distinct count."""
    inside = F.col("event_timestamp") >= _since(as_of, days)

    def of(column: str) -> Column:
        return F.when(inside, F.col(column))

    def events_of(event_type: str) -> Column:
        return F.count_if(inside & (F.col("event_type") == event_type))

    d = f"{days}d"
    return [
        F.count_if(inside).alias(f"total_events_{d}"),
        F.avg(of("session_duration")).alias(f"avg_session_duration_{d}"),
        F.stddev_samp(of("session_duration")).alias(f"std_session_duration_{d}"),
        F.max(of("session_duration")).cast("double").alias(f"max_session_duration_{d}"),
        F.sum(of("transaction_amount")).alias(f"total_transaction_amount_{d}"),
        F.count_if(inside & (F.col("transaction_amount") > 0)).alias(f"transaction_count_{d}"),
        F.avg(of("transaction_amount")).alias(f"avg_transaction_amount_{d}"),
        events_of("login").alias(f"login_count_{d}"),
        events_of("feature_usage").alias(f"feature_usage_count_{d}"),
        events_of("support_ticket").alias(f"support_tickets_{d}"),
        events_of("plan_downgrade").alias(f"plan_downgrades_{d}"),
        F.max(of("event_timestamp")).alias(f"last_event_timestamp_{d}"),
        F.min(of("event_timestamp")).alias(f"first_event_timestamp_{d}"),
    ]


_COUNTS = ("total_events", "transaction_count", "login_count", "feature_usage_count", "support_tickets", "plan_downgrades")


def _facets(events: DataFrame, facets: Sequence[int]) -> DataFrame:
    """Last time each customer was seen with each session, device and attribute combination.

    One hash aggregation with a single timestamp as state. A session (or device) lies in a window
    exactly when its last event does, which replaces one distinct count per window.
    """
    facet = F.col("_facet")
    spread = events.select("*", F.explode(F.array(*[F.lit(f) for f in facets])).alias("_facet"))
    return spread.groupBy(
        "customer_id",
        "_facet",
        F.when(facet == SESSION, F.col("session_id")).when(facet == DEVICE, F.col("device"))
        .otherwise(F.col("cohort")).alias("_key"),
        F.when(facet == ATTRIBUTES, F.col("plan")).alias("_plan"),
        F.when(facet == ATTRIBUTES, F.col("customer_state")).alias("_state"),
    ).agg(F.max("event_timestamp").alias("_last"))


def _distinct_counts(as_of: Column, days: Sequence[int]) -> list[Column]:
    counts = []
    for n in days:
        inside = F.col("_key").isNotNull() & (F.col("_last") >= _since(as_of, n))
        counts += [
            F.count_if((F.col("_facet") == SESSION) & inside).alias(f"unique_sessions_{n}d"),
            F.count_if((F.col("_facet") == DEVICE) & inside).alias(f"device_types_{n}d"),
        ]
    return counts


def _last_known() -> list[Column]:
    """Latest non-NULL value of each attribute; at equal times the greatest value."""
    pairs = [("_key", "cohort"), ("_plan", "current_plan"), ("_state", "customer_state")]
    return [
        F.max(
            F.when((F.col("_facet") == ATTRIBUTES) & F.col(source).isNotNull(), F.struct("_last", F.col(source).alias("v")))
        )["v"].alias(name)
        for source, name in pairs
    ]


def _null_when_absent(df: DataFrame, days: Sequence[int]) -> DataFrame:
    """A window without events has no values at all, not even zero counts."""
    changed = {}
    for n in days:
        active = F.col(f"total_events_{n}d") > 0
        for name in (*_COUNTS, "unique_sessions", "device_types"):
            changed[f"{name}_{n}d"] = F.when(active, F.col(f"{name}_{n}d"))
    return df.withColumns(changed)


def window_features(events: DataFrame, as_of: Column, days: Sequence[int] = WINDOW_DAYS) -> DataFrame:
    """Fifteen measures per customer and window of N days before `as_of`.

    Two column-disjoint scans (measures; sessions and devices), each reduced to one row per
    customer and already partitioned by customer, so the join adds no shuffle.
    """
    recent = _before(events, as_of, max(days))
    measures = recent.groupBy("customer_id").agg(*[m for n in days for m in _measures(as_of, n)])
    distinct = _facets(recent, [SESSION, DEVICE]).groupBy("customer_id").agg(*_distinct_counts(as_of, days))
    return _null_when_absent(measures.join(distinct, "customer_id"), days)


def static_features(events: DataFrame) -> DataFrame:
    """Last known attributes, first and last sighting, number of events per customer."""
    seen = events.groupBy("customer_id").agg(
        F.max("event_timestamp").alias("last_seen_at"),
        F.min("event_timestamp").alias("first_seen_at"),
        F.count(F.lit(1)).alias("total_events_all_time"),
    )
    known = _facets(events, [ATTRIBUTES]).groupBy("customer_id").agg(*_last_known())
    return known.join(seen, "customer_id")


def joined_features(events: DataFrame, as_of: Column, days: Sequence[int] = WINDOW_DAYS) -> DataFrame:
    """Left join of the static features with one aggregate per window: the definition, kept for comparison."""
    result = static_features(_before(events, as_of, SOURCE_DAYS))
    for n in days:
        d = f"{n}d"
        window = _before(events, as_of, n).groupBy("customer_id").agg(
            *_measures(as_of, n),
            F.count_distinct("session_id").alias(f"unique_sessions_{d}"),
            F.count_distinct("device").alias(f"device_types_{d}"),
        )
        result = result.join(window, "customer_id", "left")
    return result


def wide_features(events: DataFrame, as_of: Column, days: Sequence[int] = WINDOW_DAYS, source_days: int = SOURCE_DAYS) -> DataFrame:
    """Static and window features in one row per customer seen in the last `source_days`."""
    recent = _before(events, as_of, source_days)
    measures = recent.groupBy("customer_id").agg(
        F.max("event_timestamp").alias("last_seen_at"),
        F.min("event_timestamp").alias("first_seen_at"),
        F.count(F.lit(1)).alias("total_events_all_time"),
        *[m for n in days for m in _measures(as_of, n)],
    )
    facets = _facets(recent, [SESSION, DEVICE, ATTRIBUTES]).groupBy("customer_id").agg(
        *_last_known(), *_distinct_counts(as_of, days)
    )
    return _null_when_absent(facets.join(measures, "customer_id"), days)


def _share(part: str, whole: str) -> Column:
    return F.col(part) / F.greatest(F.col(whole), F.lit(1))


def with_derived(features: DataFrame, as_of: Column, version: str = FEATURE_VERSION) -> DataFrame:
    """Recency, trends, ratios, label and snapshot columns."""
    slow = F.col("avg_session_duration_30d")
    return features.withColumns({
        # Counts from the last event of any type; the name is part of the table's contract.
        "days_since_last_login": F.datediff(F.to_date(as_of), F.to_date("last_seen_at")),
        "session_duration_trend": (F.col("avg_session_duration_7d") - slow) / F.greatest(slow, F.lit(1.0)),
        "transaction_trend": F.col("transaction_count_7d") / F.lit(7.0) - F.col("transaction_count_30d") / F.lit(30.0),
        "feature_engagement_ratio_7d": _share("feature_usage_count_7d", "total_events_7d"),
        "support_ticket_rate_30d": _share("support_tickets_30d", "total_events_30d"),
        "snapshot_date": F.to_date(as_of),
        "_feature_version": F.lit(version),
        "_computed_at": as_of,
        "is_churned": F.coalesce((F.col("customer_state") == "churned").cast("int"), F.lit(0)),
    })


def build_features(events: DataFrame, as_of: Column, version: str = FEATURE_VERSION) -> DataFrame:
    """The feature snapshot in the table's columns. Unused measures are pruned by the optimizer."""
    return with_derived(wide_features(events, as_of), as_of, version).select(*SNAPSHOT_COLUMNS)


def last_login_age(events: DataFrame, as_of: Column) -> DataFrame:
    """Days since each customer's last login event, which `days_since_last_login` does not give."""
    logins = events.where((F.col("event_type") == "login") & (F.col("event_timestamp") < as_of))
    last = logins.groupBy("customer_id").agg(F.max("event_timestamp").alias("last_login_at"))
    return last.withColumn("days_since_true_login", F.datediff(F.to_date(as_of), F.to_date("last_login_at")))
