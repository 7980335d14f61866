"""Job entry points: each reads tables, runs one step and writes its result.

The clock is always an argument. Every job can be run again for the same moment.
"""

from __future__ import annotations

import datetime as dt
import functools

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schemas
from ..operators import curate as C, drift as D, evaluate as E, features as X, labels as B, prep as Q, profile as P
from ..operators import reports as R, validate as V
from ..session import cut_lineage, few_rows, owned_scratch, prepare
from ..sinks import writers as W
from ..sinks.tables import VersionedTable
from ..sources import labels as L, raw, snapshots as N
from ..sources.paths import exists

EVENT_PARTITIONS = ["event_year", "event_month", "event_day"]


def _ts(moment: dt.datetime):
    return F.lit(moment).cast("timestamp")


def job(run):
    """A job removes the intermediate tables it makes; what it returns stands by itself."""

    @functools.wraps(run)
    def owned(*args, **named):
        with owned_scratch(SparkSession.getActiveSession()):
            return run(*args, **named)

    return owned


def events_table(spark: SparkSession, path: str) -> VersionedTable:
    return VersionedTable(spark, path, schemas.CURATED_EVENT, EVENT_PARTITIONS)


@job
def curate(
    spark: SparkSession, raw_path: str, curated_path: str, start: dt.datetime, end: dt.datetime, etl_ts: dt.datetime,
    times_are_final: bool = False,
) -> DataFrame:
    """Raw range to curated table; returns the load metrics.

    With `times_are_final` an event id never comes again with another time, so the table need not
    be searched for it outside the days of the range.
    """
    prepare(spark)
    rows = raw.read_raw(spark, raw_path, _ts(start), _ts(end))
    curated = cut_lineage(C.curate(rows, _ts(start), _ts(end), _ts(etl_ts), "curate"), "curated")
    events_table(spark, curated_path).upsert(
        curated, "event_id", "_etl_timestamp", etl_ts, f"curate-{start.isoformat()}-{end.isoformat()}-{etl_ts.isoformat()}",
        keys_may_move=not times_are_final, stored=True,
    )
    return few_rows(C.load_metrics(rows, curated))


@job
def features(spark: SparkSession, curated_path: str, out_path: str, as_of: dt.datetime) -> DataFrame:
    """Feature snapshot of a moment, replacing the snapshot of that day."""
    prepare(spark)
    days = X.SOURCE_DAYS
    table = events_table(spark, curated_path)
    first = (as_of - dt.timedelta(days=days)).date()
    wanted = [
        (d.year, d.month, d.day) for d in (first + dt.timedelta(days=i) for i in range(days + 1))
    ]
    snapshot = X.build_features(table.read(only=wanted), _ts(as_of))
    W.overwrite_partitions(snapshot, out_path, ["snapshot_date"])
    return N.read_features(spark, out_path).where(F.col("snapshot_date") == F.lit(as_of.date()))


@job
def splits(spark: SparkSession, features_path: str, out_path: str, as_of: dt.datetime) -> DataFrame:
    """Stratified train, validation and test sets of a snapshot; returns rows and churn rate of each."""
    prepare(spark)
    snapshot = N.read_features(spark, features_path).where(F.col("snapshot_date") == F.lit(as_of.date()))
    return W.write_splits(Q.stratified_split(snapshot), out_path, as_of.date().isoformat())


@job
def validate(
    spark: SparkSession, features_path: str, results_path: str, as_of: dt.datetime, moment: dt.datetime | None = None, **limits
) -> DataFrame:
    """Check the snapshot of a day at a moment (the day's own unless given), record the results, return the verdict."""
    moment = moment or as_of
    prepare(spark)
    snapshot = N.read_features(spark, features_path).where(F.col("snapshot_date") == F.lit(as_of.date()))
    checks = cut_lineage(V.validate(snapshot, _ts(moment), **limits), "checks")
    W.append_check_results(checks, results_path, "features", _ts(moment))
    return few_rows(V.verdict(checks))


@job
def evaluate(scored: DataFrame, threshold: float, p99_latency_ms: float) -> tuple[DataFrame, DataFrame]:
    """(metrics, gates) of labelled scores; the latency is measured elsewhere."""
    metrics = few_rows(E.evaluation(scored, threshold).withColumn("p99_latency_ms", F.lit(p99_latency_ms)))
    return metrics, E.quality_gates(metrics)


@job
def score(features_df: DataFrame, out_path: str, scored_at: dt.datetime, apply, run: str | None = None) -> None:
    """Score a snapshot with `apply` (frame to frame) and add the predictions by date and run.

    A run is named by its moment unless a name is given; repeated, it replaces its own predictions and no others.
    """
    rows = apply(features_df).withColumns({"scored_at": _ts(scored_at), "date": F.to_date(_ts(scored_at))})
    W.append_predictions(rows, out_path, run or f"{scored_at:%Y%m%dT%H%M%S}")


@job
def ground_truth(
    spark: SparkSession, capture_path: str, outcomes_path: str, out_path: str, end: dt.datetime, outcome_days: int = 7, lookback_days: int = 90
) -> DataFrame:
    """Join captured predictions to the outcomes of the last days; returns the summary."""
    prepare(spark)
    start = end - dt.timedelta(days=outcome_days)
    preds = L.read_capture(spark, capture_path, (start - dt.timedelta(days=lookback_days)).date(), end.date())
    outcomes = L.read_outcomes(spark, outcomes_path, start.date(), end.date())
    merged = cut_lineage(B.merged_labels(preds, outcomes, _ts(end), outcome_days, lookback_days), "merged")
    W.write_merged_labels(merged, out_path, end.date().isoformat())
    return few_rows(B.merge_summary(merged))


@job
def baseline(training: DataFrame, columns: list[str], out_path: str, model_version: str, sketched: bool = False, **limits) -> DataFrame:
    """What live data is compared with, stored under the model version: profile, constraints, counts of values and categories.

    `sketched` stores a quantile sketch per number instead of its distinct values: a baseline whose size does not depend on
    the rows, at an error that the comparison states.
    """
    profiled = cut_lineage(P.profile(training, columns), "profile")
    numbers, texts = P.split_kinds(training, columns)
    stored = {
        "profile": profiled, "constraints": P.suggest_constraints(profiled, **limits),
        "categories": P.category_counts(training, texts),
    }
    stored |= {"sketches": P.value_sketches(training, numbers)} if sketched else {"values": P.value_counts(training, numbers)}
    for name, frame in stored.items():
        frame.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{out_path}/{model_version}/{name}")
    return training.sparkSession.read.parquet(f"{out_path}/{model_version}/constraints")


@job
def drift(
    live: DataFrame, columns: list[str], baseline_path: str, summaries_path: str, environment: str, schedule: str, at: dt.datetime,
    high_importance: list[str], monitoring_type: str = "data_quality", **limits,
) -> DataFrame:
    """Check live rows against a stored baseline, record the summary, return it with the decision.

    Profiles are held against the constraints, and the distributions of numbers and categories against those of the
    baseline. `high_importance` names the features whose drift alone asks for a new training, such as the model's most
    important ones.
    """
    read = live.sparkSession.read.parquet
    broken = D.constraint_violations(P.profile(live, columns), read(f"{baseline_path}/constraints"))
    numbers, texts = P.split_kinds(live, columns)
    texts_of = read(f"{baseline_path}/categories"), P.category_counts(live, texts)
    if exists(live.sparkSession, f"{baseline_path}/sketches"):
        tested = D.ks_of_sketches(read(f"{baseline_path}/sketches"), P.value_sketches(live, numbers), P.SKETCH_K, limits.get("alpha", 0.05))
        moved = D.distribution_violations(None, None, *texts_of, **limits, numbers=tested)
    else:
        moved = D.distribution_violations(read(f"{baseline_path}/values"), P.value_counts(live, numbers), *texts_of, **limits)
    decided = D.with_decision(D.drift_score(broken.unionByName(moved), high_importance))
    summary = cut_lineage(D.drift_summary(decided, _ts(at), schedule, monitoring_type, baseline_path), "drift-summary")
    W.append_drift_summaries(summary, summaries_path, environment)
    return few_rows(summary)


def register_views(events: DataFrame, snapshots: DataFrame, as_of: dt.datetime) -> None:
    """The two reports as temporary SQL views."""
    R.daily_event_counts(events, _ts(as_of)).createOrReplaceTempView("daily_event_counts")
    R.churn_risk_by_cohort(snapshots).createOrReplaceTempView("churn_risk_by_cohort")


