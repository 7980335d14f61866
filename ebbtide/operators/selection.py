"""Picking rows: latest, winner, previous, unseen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .curate import newest_per_key


def latest_row(df: DataFrame, key: str, time: str, tie: str) -> DataFrame:
    """The whole latest row of each key; at equal times the greatest `tie`."""
    return newest_per_key(df, key, [F.col(time).desc_nulls_last(), F.col(tie).desc_nulls_last()])


def pick_winner(results: DataFrame, by: list[str], name: str = "model_type", forced: str | None = None) -> DataFrame:
    """Best AUC among the candidates that passed; a forced choice wins if it passed; NULL if none did."""
    passed = F.col("passed")
    best = F.max(F.when(passed, F.struct("auc", F.col(name).alias("name"))))["name"]
    choice = best if forced is None else F.coalesce(F.max(F.when(passed & (F.col(name) == forced), F.col(name))), best)
    return results.groupBy(*by).agg(choice.alias("winner"))


def previous_version(history: DataFrame, failed_version: Column | str, by: list[str]) -> DataFrame:
    """Newest deployment of another version than the failed one."""
    failed = F.lit(failed_version) if isinstance(failed_version, str) else failed_version
    newest = F.max(F.struct("deployed_at", "model_version"))
    return (
        history.where(F.col("model_version") != failed).groupBy(*by).agg(newest.alias("n"))
        .select(*by, "n.model_version", "n.deployed_at")
    )


def needs_baseline(versions: DataFrame, now: Column, days: int = 7) -> DataFrame:
    """Production versions created less than a week ago."""
    recent = F.col("created_at") > now - F.make_dt_interval(days=F.lit(days))
    return versions.where((F.col("stage") == "Production") & recent)


def unseen_categories(known: DataFrame, live: DataFrame, column: str) -> DataFrame:
    """Values of `live` that `known` does not have."""
    return live.select(column).distinct().join(known.select(column).distinct(), column, "left_anti")


def latest_complete_execution(executions: DataFrame) -> DataFrame:
    """The newest run per schedule, only if it is complete; an older complete run is not a substitute."""
    newest = latest_row(executions, "schedule", "created_at", tie="execution_id")
    return newest.where(F.col("status").isin("Completed", "CompletedWithViolations"))
