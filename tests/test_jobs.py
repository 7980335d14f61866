"""The jobs one after the other, and each of them twice."""

import datetime as dt

from pyspark.sql import functions as F

from ebbtide import schemas
from ebbtide.plans import jobs
from ebbtide.sinks import writers as W
from test_curation import raw_row, ts

AS_OF = ts("2024-01-31")


def test_jobs_in_a_row(spark, folder):
    rows = [
        raw_row(f"e{c}-{d}", time=f"2024-01-{d:02d}T10:00:00", customer_id=f"c{c}", customer_state="churned" if c % 10 == 0 else "healthy", session_duration=c + d)
        for c in range(40) for d in (5, 20, 28)
    ]
    W.write_raw(spark.createDataFrame(rows, schemas.RAW_EVENT), f"{folder}/raw")

    def curate(etl):
        return jobs.curate(spark, f"{folder}/raw", f"{folder}/curated", ts("2024-01-01"), AS_OF, ts(etl)).first()

    first = curate("2024-01-31T01:00:00")
    assert (first["raw_records"], first["curated_records"], first["null_customer_rate"]) == (120, 120, 0.0)
    table = jobs.events_table(spark, f"{folder}/curated")
    before = table.commits().count()
    curate("2024-01-31T01:00:00")
    assert table.commits().count() == before and table.read().count() == 120
    curate("2024-01-31T02:00:00")
    assert table.read().count() == 120
    assert {r[0] for r in table.read().select("_etl_timestamp").distinct().collect()} == {ts("2024-01-31T02:00:00")}

    for _ in range(2):
        snapshot = jobs.features(spark, f"{folder}/curated", f"{folder}/features", AS_OF)
    assert snapshot.count() == 40
    one = snapshot.where("customer_id = 'c3'").first()
    assert (one["total_events_7d"], one["total_events_30d"], one["days_since_last_login"]) == (1, 3, 3)

    split = {r["split"]: (r["rows"], r["churn_rate"]) for r in jobs.splits(spark, f"{folder}/features", f"{folder}/splits", AS_OF).collect()}
    assert sum(n for n, _ in split.values()) == 40 and split["test"][0] == 8

    verdict = jobs.validate(spark, f"{folder}/features", f"{folder}/checks", AS_OF, min_rows=8, max_null_rate=1.0).first()
    assert verdict["passed"] and spark.read.parquet(f"{folder}/checks").count() == verdict["evaluated"]

    columns = ["total_events_30d", "avg_session_duration_30d", "cohort"]
    jobs.baseline(snapshot, columns, f"{folder}/baselines", "7")
    live = snapshot.withColumn("avg_session_duration_30d", F.col("avg_session_duration_30d") - 1000).drop("cohort")
    summary = jobs.drift(
        live, columns[:2], f"{folder}/baselines/7", f"{folder}/drift", "dev", "daily", AS_OF, high_importance=["cohort"]).first()
    # cohort is gone (critical), the duration is negative, far from its mean and of another distribution.
    assert (summary["violation_count"], summary["critical_features"], summary["retraining_triggered"]) == (4, ["cohort"], True)
    assert abs(summary["drift_score"] - (0.15 + 0.05 + 0.075 + 0.075)) < 1e-9
    assert spark.read.json(f"{folder}/drift").count() == 1

    jobs.register_views(table.read(), snapshot, AS_OF)
    assert spark.sql("SELECT sum(event_count) FROM daily_event_counts").first()[0] == 40
    assert spark.sql("SELECT sum(total_customers) FROM churn_risk_by_cohort").first()[0] == 40


def test_score_and_evaluate(spark, folder):
    from ebbtide.operators import score as S

    df = spark.createDataFrame([(f"c{i}", i / 10, int(i > 6)) for i in range(10)], "customer_id string, x double, label int")
    for _ in range(2):
        jobs.score(df, f"{folder}/scores", dt.datetime(2024, 1, 31), lambda d: S.score_linear(d, {"x": 10.0}, -6.5))
    scored = spark.read.parquet(f"{folder}/scores")
    assert scored.count() == 10
    metrics, gates = jobs.evaluate(scored.withColumnRenamed("churn_probability", "probability"), 0.5, 120.0)
    assert (metrics.first()["auc"], metrics.first()["recall"]) == (1.0, 1.0)
    assert all(r["passed"] for r in gates.collect())
