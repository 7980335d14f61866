"""Aggregate reports over curated events and feature snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalars import half_up


def daily_event_counts(events: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    """Per day and event type: volume, customers, session length, transactions."""
    start = F.date_sub(F.to_date(as_of), days).cast("timestamp")
    time = F.col("event_timestamp")
    return (
        events.where((time >= start) & (time < as_of))
        .groupBy(F.to_date(time).alias("event_date"), "event_type")
        .agg(
            F.count(F.lit(1)).alias("event_count"),
            F.count_distinct("customer_id").alias("unique_customers"),
            F.avg(F.col("session_duration").cast("double")).alias("avg_session_duration_secs"),
            F.count_if(F.col("transaction_amount") > 0).alias("transaction_events"),
            F.sum(F.coalesce("transaction_amount", F.lit(0.0))).alias("total_transaction_amount"),
        )
        .orderBy(F.desc("event_date"), F.desc("event_count"), "event_type")
    )


def month_to_date_event_days(events: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    """Events by day under the old day-of-month rule, which loses days at the start of a month."""
    today, time = F.to_date(as_of), F.col("event_timestamp")
    return (
        events.where(
            (F.year(time) == F.year(today)) & (F.month(time) == F.month(today))
            & (F.dayofmonth(time) >= F.dayofmonth(today) - days)
        )
        .groupBy(F.to_date(time).alias("event_date"))
        .agg(F.count(F.lit(1)).alias("event_count"))
    )


def latest_snapshot(features: DataFrame) -> DataFrame:
    """Rows of the newest snapshot; the date is a scalar subquery, so only its partition is read."""
    newest = features.agg(F.max("snapshot_date")).scalar()
    return features.where(F.col("snapshot_date") == newest)


def churn_risk_by_cohort(features: DataFrame) -> DataFrame:
    """Lifecycle state shares and averages per cohort and plan on the newest snapshot."""

    def in_state(*states: str) -> Column:
        return F.count_if(F.col("customer_state").isin(*states))

    def percent(count: Column) -> Column:
        return half_up(F.try_divide(100.0 * count, F.col("total_customers")), 2)

    stats = latest_snapshot(features).where(F.col("cohort").isNotNull()).groupBy("cohort", "current_plan").agg(
        F.count(F.lit(1)).alias("total_customers"),
        in_state("healthy").alias("healthy_count"),
        in_state("at_risk").alias("at_risk_count"),
        in_state("churning").alias("churning_count"),
        in_state("churned").alias("churned_count"),
        F.avg("session_duration_trend").alias("_trend"),
        F.avg("days_since_last_login").alias("_recency"),
        F.avg("transaction_count_30d").alias("_transactions"),
        F.avg("total_transaction_amount_30d").alias("_revenue"),
        F.avg("support_ticket_rate_30d").alias("_tickets"),
        F.avg("feature_engagement_ratio_7d").alias("_engagement"),
    )
    return stats.select(
        "cohort", "current_plan", "total_customers", "healthy_count", "at_risk_count", "churning_count", "churned_count",
        percent(F.col("churned_count")).alias("churn_rate_pct"),
        percent(F.col("at_risk_count") + F.col("churning_count")).alias("at_risk_rate_pct"),
        half_up(F.col("_trend"), 4).alias("session_duration_trend"),
        half_up(F.col("_recency"), 1).alias("avg_days_since_login"),
        half_up(F.col("_transactions"), 2).alias("avg_monthly_transactions"),
        half_up(F.col("_revenue"), 2).alias("avg_monthly_revenue_usd"),
        half_up(F.col("_tickets") * 100, 2).alias("support_ticket_rate_pct"),
        half_up(F.col("_engagement") * 100, 2).alias("feature_engagement_pct"),
    ).orderBy(F.desc("churn_rate_pct"), "cohort", "current_plan")


def spot_check(events: DataFrame, as_of: Column, hours: int = 2) -> DataFrame:
    """Is anything arriving: events, customers and newest event of the last hours."""
    recent = events.where(F.col("event_timestamp").between(as_of - F.make_dt_interval(hours=F.lit(hours)), as_of))
    return recent.agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count_distinct("customer_id").alias("unique_customers"),
        F.max("event_timestamp").alias("latest_event"),
    )


def label_rate(df: DataFrame, label: str = "is_churned") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"), F.avg(F.col(label).cast("double")).alias("churn_rate"))


def class_weight(df: DataFrame, label: str = "is_churned") -> DataFrame:
    """Negatives per positive; NULL when there is no positive."""
    negatives, positives = F.count_if(F.col(label) == 0), F.count_if(F.col(label) == 1)
    return df.agg(
        negatives.alias("negatives"), positives.alias("positives"),
        F.try_divide(negatives, positives).alias("positive_weight"),
    )


def runs_by_state(runs: DataFrame, until: Column, hours: int = 24) -> DataFrame:
    """Runs started in the last hours, by job and state."""
    recent = F.col("start").between(until - F.make_dt_interval(hours=F.lit(hours)), until)
    return runs.where(recent).groupBy("dag_id", "state").agg(F.count(F.lit(1)).alias("runs"))


def top_features(importances: DataFrame, k: int = 20) -> DataFrame:
    """The k most important features, ranked. Spark keeps k rows per task for this."""
    return importances.orderBy(F.desc("importance"), "feature").limit(k)
