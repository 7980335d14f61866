"""As-of join: for each outcome, the last prediction made at or before it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.running import running
from ..session import cut_lineage


def asof_latest(
    preds: DataFrame,
    outcomes: DataFrame,
    by: str = "customer_id",
    left_time: str = "inference_timestamp",
    right_time: str = "outcome_date",
    tie: str = "inference_id",
    max_age_days: int = 90,
) -> DataFrame:
    """Inner as-of join on `by`; an outcome without a prediction in the last `max_age_days` is dropped.

    Nothing is paired within a customer. Distinct prediction times and distinct outcome times are
    put on one time line, the running maximum of prediction times is taken along it in bins, and
    the prediction itself is fetched by an equi-join on (customer, time).
    """
    others = [c for c in preds.columns if c != by]
    made = preds.where(F.col(by).isNotNull() & F.col(left_time).isNotNull())
    asked = outcomes.where(F.col(by).isNotNull() & F.col(right_time).isNotNull())
    moments = asked.select(by, F.unix_micros(right_time).alias("_at"), F.lit(1).alias("_asked")).distinct()
    times = made.select(by, F.unix_micros(left_time).alias("_at"), F.lit(0).alias("_asked")).distinct()
    line = times.unionByName(moments)
    seen = running(
        line, [by], [F.col("_at"), F.col("_asked")],
        {"_seen": ("max", F.when(F.col("_asked") == 0, F.col("_at")))},
    )
    hit = seen.where((F.col("_asked") == 1) & F.col("_seen").isNotNull()).select(
        by, F.timestamp_micros("_at").alias(right_time), F.timestamp_micros("_seen").alias("_made")
    )
    oldest = F.make_dt_interval(days=F.lit(max_age_days))
    recent = cut_lineage(hit.where(F.col("_made") >= F.col(right_time) - oldest), "asof-hits")
    # Only predictions that some outcome asks for are fetched whole, one per customer and moment:
    # the greatest `tie` among equals.
    needed = made.withColumn("_made", F.col(left_time)).join(recent.select(by, "_made").distinct(), [by, "_made"], "left_semi")
    latest = needed.groupBy(by, "_made").agg(
        F.max(F.struct(F.col(tie).alias("_tie"), *[c for c in others if c != tie])).alias("_p")
    )
    found = asked.join(recent, [by, right_time]).join(latest, [by, "_made"])
    return found.select(
        *outcomes.columns,
        *[
            F.col("_made").alias(c) if c == left_time else F.col("_p._tie").alias(c) if c == tie else F.col(f"_p.{c}").alias(c)
            for c in others
        ],
    )


def outcomes_joined(preds: DataFrame, outcomes: DataFrame, by: str = "customer_id") -> DataFrame:
    """Plain inner join of predictions and outcomes; several outcomes of a customer multiply its rows."""
    return preds.join(outcomes, by)
