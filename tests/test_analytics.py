"""Running totals, features, validation, drift, evaluation, alerts: brute force and hand-written results."""

import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from ebbtide.constants import HIGH_IMPORTANCE_FEATURES, NUMERIC_FEATURES, REQUIRED_COLUMNS, SNAPSHOT_COLUMNS
from ebbtide.functions import running as R, scalars as S
from ebbtide.operators import alerts as K, asof as J, drift as D, evaluate as E, features as X, prep as Q, reuse as U, score, selection as L
from ebbtide.operators import service as H, validate as V


def ts(text):
    return dt.datetime.fromisoformat(text)


def lit(text):
    return F.lit(text).cast("timestamp")


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows in one key, with few and with many distinct values."""
    rng = random.Random(5)
    data = [("hot" if i % 3 == 0 else f"k{i % 7}", rng.choice([rng.random(), 0.5, 0.25]), i) for i in range(900)]
    return data, spark.createDataFrame(data, "key string, v double, i int")


@pytest.mark.parametrize("bins", [2, 16])
@pytest.mark.parametrize("inclusive", [True, False])
def test_running_against_brute_force(skewed, bins, inclusive):
    data, df = skewed
    got = R.running(df, ["key"], [F.col("v"), F.col("i")], {"n": ("sum", F.lit(1)), "top": ("max", F.col("i"))}, inclusive, bins)
    for row in got.collect():
        before = [d for d in data if d[0] == row["key"] and ((d[1], d[2]) <= (row["v"], row["i"]) if inclusive else (d[1], d[2]) < (row["v"], row["i"]))]
        assert row["n"] == len(before)
        assert row["top"] == max((d[2] for d in before), default=None)


def test_percentiles_against_brute_force(skewed):
    import numpy as np

    data, df = skewed
    got = {r["key"]: r for r in R.exact_percentiles(df, ["key"], "v", {"p1": 0.01, "p50": 0.5, "p99": 0.99}, bins=8).collect()}
    for key, row in got.items():
        values = [d[1] for d in data if d[0] == key]
        for name, p in (("p1", 1), ("p50", 50), ("p99", 99)):
            assert row[name] == pytest.approx(np.percentile(values, p), abs=1e-12)


def test_percentiles_of_nothing(spark):
    empty = spark.createDataFrame([], "k string, v double")
    assert R.exact_percentiles(empty, ["k"], "v", {"p": 0.5}).count() == 0
    one = spark.createDataFrame([("a", 3.0), ("a", None)], "k string, v double")
    assert R.exact_percentiles(one, ["k"], "v", {"p": 0.5}).first()["p"] == 3.0


def test_dense_index_is_sorted(spark):
    words = ["b", "a", "abcdefgh", "abcdefgg", "é", "", "z", "a"]
    df = spark.createDataFrame([(w,) for w in words] + [(None,)], "w string")
    got = {r["w"]: r["i"] for r in R.dense_index(df, "w", "i", bins=4).collect()}
    assert got == {w: i for i, w in enumerate(sorted(set(words), key=lambda w: w.encode()))}


def test_long_common_prefix_is_spread(spark):
    """Values that differ only behind a long prefix, most rows in one key: no bin holds them all."""
    df = spark.range(3000).select(F.lit("k").alias("k"), F.concat(F.lit("customer_" * 5), F.lpad(F.col("id").cast("string"), 6, "0")).alias("v"))
    sizes = [r["n"] for r in R.binned(df, ["k"], [F.col("v")], bins=8).groupBy("_bin").agg(F.count("*").alias("n")).collect()]
    assert len(sizes) >= 6 and max(sizes) < 1000 and sum(sizes) == 3000


EVENT = "customer_id string, event_id string, event_type string, event_timestamp timestamp, session_id string, session_duration int, transaction_amount double, device string, cohort string, plan string, customer_state string"


def event(customer, i, time, kind="login", session="s", duration=10, amount=0.0, device="mobile", cohort="q", plan="pro", state="healthy"):
    return (customer, str(i), kind, ts(time), session, duration, amount, device, cohort, plan, state)


AS_OF = "2024-04-01 00:00:00"


@pytest.fixture(scope="module")
def history(spark):
    return spark.createDataFrame([
        event("quiet", 1, "2024-02-21", plan="basic"),
        event("edge", 2, "2024-03-25", session="x"), event("edge", 3, "2024-03-24T23:59:59", session="x"),
        event("edge", 4, "2024-03-30", session=None, device="tablet", amount=5.0, kind="transaction"),
        event("edge", 5, "2024-04-01", session="future"),
        event("mover", 6, "2024-03-01", plan="basic", state="healthy"), event("mover", 7, "2024-03-20", plan="pro", state="churned"),
        event("mover", 8, "2024-03-21", plan=None, state=None, cohort=None),
        event("gone", 9, "2023-12-01"),
    ], EVENT)


def test_feature_windows(history):
    got = {r["customer_id"]: r for r in X.build_features(history, lit(AS_OF)).collect()}
    assert set(got) == {"quiet", "edge", "mover"}
    quiet, edge, mover = got["quiet"], got["edge"], got["mover"]
    assert quiet["total_events_7d"] is None and quiet["login_count_7d"] is None and quiet["transaction_trend"] is None
    assert quiet["total_events_90d"] == 1 and quiet["days_since_last_login"] == 40
    # The event at the cutoff counts, the one a second earlier and the one at as_of do not.
    assert (edge["total_events_7d"], edge["total_events_30d"], edge["total_events_all_time"]) == (2, 3, 3)
    assert (edge["unique_sessions_7d"], edge["unique_sessions_30d"]) == (1, 1)
    assert edge["std_session_duration_7d"] == 0.0 and quiet["avg_session_duration_30d"] is None
    assert (edge["transaction_count_7d"], edge["total_transaction_amount_7d"]) == (1, 5.0)
    assert (mover["current_plan"], mover["customer_state"], mover["cohort"], mover["is_churned"]) == ("pro", "churned", "q", 1)
    assert X.build_features(history, lit(AS_OF)).columns == SNAPSHOT_COLUMNS


def test_one_event_has_no_deviation(spark):
    one = spark.createDataFrame([event("a", 1, "2024-03-31")], EVENT)
    assert X.build_features(one, lit(AS_OF)).first()["std_session_duration_7d"] is None


def test_single_pass_equals_joins(history, rows):
    wide, joined = X.wide_features(history, lit(AS_OF)), X.joined_features(history, lit(AS_OF))
    assert rows(wide.select(*sorted(wide.columns))) == rows(joined.select(*sorted(wide.columns)))


def snapshot(spark, n=200, churned=40, **constant):
    data = []
    for i in range(n):
        row = {c: float((i * 7 + j) % 11) for j, c in enumerate(NUMERIC_FEATURES)}
        row.update(customer_id=f"c{i}", is_churned=int(i < churned), snapshot_date=dt.date(2024, 1, 31), cohort="q", current_plan="pro", **constant)
        data.append(row)
    schema = ", ".join(["customer_id string", "is_churned int", "snapshot_date date", "cohort string", "current_plan string", *[f"{c} double" for c in NUMERIC_FEATURES]])
    return spark.createDataFrame([tuple(r[f.split()[0]] for f in schema.split(", ")) for r in data], schema)


def failed(df, now="2024-02-01 00:00:00", **limits):
    checks = V.validate(df, lit(now), **{"min_rows": 80, **limits})
    return {(r["check"], r["column"]) for r in checks.collect() if not r["passed"]}


def test_validation_passes(spark):
    df = snapshot(spark)
    assert failed(df) == set()
    verdict = V.verdict(V.validate(df, lit("2024-02-01"), min_rows=80)).first()
    assert verdict["passed"] and verdict["failures"] == 0


def test_each_check_fails_alone(spark):
    df = snapshot(spark)
    assert failed(df, now="2024-02-02 00:00:01") == {("freshness", "snapshot_date")}
    assert failed(df, now="2024-02-02 00:00:00") == set()
    assert failed(df, min_rows=170) == {("volume", "active"), ("volume", "churned")}
    assert failed(df, max_churn=0.19) == {("target_high", "is_churned")}
    assert failed(df, min_churn=0.21) == {("target_low", "is_churned")}
    holes = df.withColumn("login_count_7d", F.when(F.col("customer_id") >= "c5", F.col("login_count_7d")))
    assert ("null_rate", "login_count_7d") in failed(holes, max_null_rate=0.3)
    assert failed(df.withColumn("login_count_7d", F.lit(1.0))) == {("zero_variance", "login_count_7d")}
    assert failed(df.limit(1), min_rows=0, min_churn=0, max_churn=1) == set()
    twice = df.unionByName(df.where("customer_id in ('c100', 'c101')"))
    assert failed(twice) == set()
    assert failed(twice.unionByName(df.where("customer_id = 'c102'"))) == {("duplicates", "customer_id")}
    nameless = df.withColumn("customer_id", F.when(~F.col("customer_id").isin("c1", "c2", "c3"), F.col("customer_id")))
    assert failed(nameless) == {("duplicates", "customer_id")}


@pytest.mark.parametrize("column", REQUIRED_COLUMNS)
def test_missing_columns(spark, column):
    assert ("schema", "") in failed(snapshot(spark, 5, 1).drop(column), min_rows=0)


VIOLATION = "feature_name string, constraint_check_type string"


@pytest.mark.parametrize("violations, score, retrain", [
    ([], 0.0, False),
    ([("plain", "completeness_check")], 0.05, False),
    ([("plain", "Categorical_Distribution_check")], 0.075, False),
    ([("monthly_charges", "completeness_check")], 0.15, True),
    ([("monthly_charges", "baseline_drift_check")], 0.225, True),
    ([("plain", "x")] * 5, 0.25, True),
    ([("plain", "distribution")] * 4, 0.30, True),
    ([("monthly_charges", "baseline")] * 9, 1.0, True),
])
def test_drift_score(spark, violations, score, retrain):
    row = D.with_decision(D.drift_score(spark.createDataFrame(violations, VIOLATION), HIGH_IMPORTANCE_FEATURES)).first()
    assert row["drift_score"] == pytest.approx(score) and row["retrain"] is retrain
    assert row["violation_count"] == len(violations)


def test_ks_by_hand(spark):
    base = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 4)], "x double")
    live = spark.createDataFrame([(float(v),) for v in (3, 4, 5, 6)], "x double")
    row = D.ks_two_sample(base, live, ["x"]).first()
    assert row["statistic"] == 0.5 and (row["n_base"], row["n_live"]) == (4, 4)
    same = D.ks_two_sample(base, base, ["x"]).first()
    assert same["statistic"] == 0.0 and same["p_value"] == 1.0 and not same["drifted"]
    far = spark.range(200).select((F.col("id") + 1000.0).alias("x"))
    near = spark.range(200).select(F.col("id").cast("double").alias("x"))
    assert D.ks_two_sample(near, far, ["x"]).first()["drifted"]


def test_chi_squared_by_hand(spark):
    base = spark.createDataFrame([("a",)] * 10 + [("b",)] * 20, "c string")
    live = spark.createDataFrame([("a",)] * 20 + [("b",)] * 10, "c string")
    row = D.chi_squared(base, live, ["c"]).first()
    assert row["statistic"] == pytest.approx(4 * 25 / 15) and row["degrees"] == 1


SCORED = "label int, probability double"


def auc(spark, data):
    return E.roc_auc(spark.createDataFrame(data, SCORED)).first()["auc"]


def test_auc(spark):
    rng = random.Random(3)
    data = [(int(rng.random() < 0.3), round(rng.random(), 2)) for _ in range(300)]
    pos, neg = ([p for y, p in data if y == c] for c in (1, 0))
    brute = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    assert auc(spark, data) == pytest.approx(brute)
    assert auc(spark, [(y, 1 - p) for y, p in data]) == pytest.approx(1 - brute)
    assert auc(spark, [(1, 0.9), (0, 0.1)]) == 1.0
    assert auc(spark, [(1, 0.5), (0, 0.5)]) == 0.5
    assert auc(spark, [(1, 0.5), (1, 0.7)]) is None


def test_best_threshold(spark):
    def best(data):
        return tuple(E.best_threshold(spark.createDataFrame(data, SCORED)).first())

    assert best([(1, 0.29), (0, 0.28)]) == (0.29, 1.0)
    assert best([(1, 0.57), (0, 0.30)]) == (0.31, 1.0)
    assert best([(1, 0.05), (0, 0.5)]) == (0.5, 0.0)
    assert best([(0, 0.5)]) == (0.5, 0.0)


def test_metrics_without_predicted_positives(spark):
    rows = E.with_prediction(spark.createDataFrame([(1, 0.1), (0, 0.2)], SCORED), 0.5)
    m = E.binary_metrics(rows).first()
    assert (m["precision"], m["recall"], m["f1"], m["accuracy"], m["specificity"]) == (0.0, 0.0, 0.0, 0.5, 1.0)


def test_gates(spark):
    metrics = spark.createDataFrame([(0.82, 0.75, 0.69, 200.0)], "auc double, precision double, recall double, p99_latency_ms double")
    result = E.gate_result(E.quality_gates(metrics)).first()
    assert (result["passed"], result["failures"]) == (False, "p99_latency_ms,recall")


def test_asof_against_brute_force(spark):
    rng = random.Random(11)
    start = ts("2024-01-01")
    preds = [("hot" if i % 3 == 0 else f"c{i % 5}", f"p{i}", start + dt.timedelta(hours=rng.randrange(600)), i) for i in range(300)]
    outs = [("hot" if i % 3 == 0 else f"c{i % 6}", start + dt.timedelta(days=rng.randrange(-2, 30)), i) for i in range(90)]
    p = spark.createDataFrame(preds, "customer_id string, inference_id string, inference_timestamp timestamp, score int")
    o = spark.createDataFrame(outs, "customer_id string, outcome_date timestamp, n int")
    got = {r["n"]: r["inference_id"] for r in J.asof_latest(p, o, max_age_days=5).collect()}
    want = {}
    for customer, at, n in outs:
        fits = [(t, i) for c, i, t, _ in preds if c == customer and at - dt.timedelta(days=5) <= t <= at]
        if fits:
            want[n] = max(fits)[1]
    assert got == want and want


def test_split_is_a_partition_with_equal_rates(spark):
    df = spark.range(1000).select(F.concat(F.lit("c"), "id").alias("customer_id"), (F.col("id") % 10 == 0).cast("int").alias("is_churned"))
    split = Q.stratified_split(df)
    counts = {(r["split"], r["is_churned"]): r["count"] for r in split.groupBy("split", "is_churned").count().collect()}
    assert counts == {("test", 1): 20, ("test", 0): 180, ("validation", 1): 10, ("validation", 0): 90, ("train", 1): 70, ("train", 0): 630}
    assert split.select("customer_id").distinct().count() == 1000
    again = Q.stratified_split(df.orderBy(F.desc("customer_id")))
    assert split.exceptAll(again).isEmpty()


def test_constant_column_is_centred_only(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    scaled = Q.scale(df, Q.fit_scaler(df, ["a", "b"]), ["a", "b"])
    assert sorted(tuple(r) for r in scaled.collect()) == [(-1.0, 0.0), (1.0, 0.0)]


def test_unseen_category(spark):
    train = spark.createDataFrame([("b",), ("a",), ("unknown",)], "cohort string")
    live = spark.createDataFrame([("b",), ("zz",)], "cohort string")
    got = {r["cohort"]: r["cohort_encoded"] for r in Q.encode(live, Q.fit_encoder(train, "cohort"), "cohort").collect()}
    assert got == {"b": 1, "zz": 2}


def test_scoring_rules(spark):
    df = spark.createDataFrame([(1.2,), (-0.1,), (0.4999999,), (0.5,)], "p double")
    got = [(r["churn_probability"], r["churn_prediction"]) for r in score.stamped(df, F.col("p"), 0.5, "1", "m").collect()]
    assert got == [(1.0, True), (0.0, False), (0.5, False), (0.5, True)]
    with pytest.raises(ValueError, match="Missing required features"):
        score.score_linear(df, {"absent": 1.0}, 0.0)


def test_prediction_reuse(spark):
    asked = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "customer_id string, x int")
    calls = []

    def model(df):
        calls.append({r["customer_id"] for r in df.select("customer_id").collect()})
        return score.stamped(df, F.lit(0.9), 0.5, "2", "m")

    now = ts("2024-01-01T12:00:00")
    old = score.stamped(U.keyed(asked, ["x"]), F.lit(0.1), 0.5, "1", "m").withColumn(
        "scored_at", F.when(F.col("customer_id") == "a", F.lit(now - dt.timedelta(seconds=299))).otherwise(F.lit(now - dt.timedelta(seconds=300))))
    changed = asked.withColumn("x", F.when(F.col("customer_id") == "c", 4).otherwise(F.col("x")))
    got = {r["customer_id"]: (r["cached"], r["model_version"]) for r in U.incremental_score(changed, old, model, ["x"], F.lit(now)).collect()}
    assert got == {"a": (True, "1"), "b": (False, "2"), "c": (False, "2")} and calls == [{"b", "c"}]
    left = U.invalidated(old, spark.createDataFrame([("a",)], "customer_id string"))
    assert {r["customer_id"] for r in left.collect()} == {"b", "c"}


def test_key_ignores_feature_order(spark):
    df = spark.createDataFrame([("a", 1, None)], "customer_id string, x int, y double")
    one, two = (df.select(S.prediction_key(F.col("customer_id"), names).alias("k")).first()["k"] for names in (["x", "y"], ["y", "x"]))
    assert one == two and one.startswith("churn:pred:") and len(one) == len("churn:pred:") + 32


def series(spark, values, step=60):
    start = ts("2024-01-01")
    return spark.createDataFrame([("s", start + dt.timedelta(seconds=step * i), v) for i, v in values], "key string, ts timestamp, v double")


@pytest.mark.parametrize("on, want", [
    ([0, 1, 2, 3, 4], []), ([0, 1, 2, 3, 4, 5], [5]), (list(range(0, 9)), [5, 6, 7, 8]), ([0, 1, 2, 4, 5, 6, 7, 8], []), (list(range(2, 30)), list(range(7, 30))),
])
def test_sustained_for_five_minutes(spark, on, want):
    df = series(spark, [(i, float(i in on)) for i in range(32)])
    got = K.sustained(df, ["key"], "ts", F.col("v") > 0, 300, 60)
    assert sorted((r["ts"] - ts("2024-01-01")).seconds // 60 for r in got.where("firing").collect()) == want
    assert got.count() == 32


def test_gap_starts_over(spark):
    df = series(spark, [(i, 1.0) for i in range(20) if i != 8])
    fired = {(r["ts"] - ts("2024-01-01")).seconds // 60 for r in K.sustained(df, ["key"], "ts", F.col("v") > 0, 300, 60).where("firing").collect()}
    assert fired == {5, 6, 7, 14, 15, 16, 17, 18, 19}


def test_counter_with_reset(spark):
    df = series(spark, [(0, 5.0), (5, 7.0), (10, 1.0), (14, 4.0), (20, 4.0), (60, 9.0)])
    got = {(r["ts"] - ts("2024-01-01")).seconds // 60: r["increase"] for r in K.counter_increase(df, ["key"], "ts", "v", 900).collect()}
    assert got == {0: 0.0, 5: 2.0, 10: 3.0, 14: 6.0, 20: 3.0, 60: 0.0}


def test_counter_in_a_dense_window(spark):
    """Against brute force, with several samples at one moment; no frame slides, whose work grows with the square of the rows."""
    rng = random.Random(8)
    data = sorted((rng.randrange(3_000), no, rng.randrange(100)) for no in range(1_500))
    df = spark.createDataFrame([(ts("2024-01-01") + dt.timedelta(seconds=s), no, v) for s, no, v in data], "ts timestamp, no int, v int")
    risen = K.counter_increase(df.withColumn("key", F.lit("a")), ["key"], "ts", "v", 900, ["no"])
    steps = [0] + [b if b < a else b - a for (_, _, a), (_, _, b) in zip(data, data[1:])]
    want = {}
    for s, no, _ in data:
        seen = [step for (other, _, _), step in zip(data, steps) if s - 900 < other <= s]
        want[no] = sum(seen) - seen[0]
    assert {r["no"]: r["increase"] for r in risen.collect()} == want
    plan = risen._jdf.queryExecution().optimizedPlan().toString()
    assert "RangeFrame, -" not in plan and "RowFrame, unboundedpreceding" in plan


def test_histogram_quantile(spark):
    log = spark.createDataFrame([("prod", ms) for ms in (5.0, 5.0, 8.0, 9000.0)], "env string, latency_ms double")
    histogram = H.latency_histogram(log)
    assert histogram.first()["cumulative"][:2] == [2, 3] and histogram.first()["cumulative"][-1] == 4
    assert H.histogram_quantile(histogram, 0.5).first()["quantile"] == pytest.approx(0.005)
    assert H.histogram_quantile(histogram, 0.625).first()["quantile"] == pytest.approx(0.0075)
    assert H.histogram_quantile(histogram, 0.99).first()["quantile"] == 5.0


CANARY = "canary_error_rate double, canary_p99_ms double, canary_positive_rate double, stable_positive_rate double"


@pytest.mark.parametrize("row, verdict, alert", [
    ((0.05, 500.0, 0.1, 0.1), "pass", False), ((0.0501, 10.0, 0.1, 0.1), "rollback", False), ((0.0, 501.0, 0.1, 0.1), "rollback", False),
    ((0.0, 10.0, 0.16, 0.1), "pass", True), ((0.0, 10.0, 0.0, 0.1), "pass", False), ((None, None, None, None), "pass", False),
])
def test_canary(spark, row, verdict, alert):
    got = H.canary_verdict(spark.createDataFrame([row], CANARY)).first()
    assert (got["verdict"], got["alert"]) == (verdict, alert)


def test_audit_rules(spark):
    fields = "eventTime timestamp, eventName string, eventSource string, eventType string, errorCode string, errorMessage string, userIdentity struct<type:string>"
    at = ts("2024-01-01T00:01:00")
    records = [
        (at, "X", "a", "AwsApiCall", None, None, ("Root",)), (at, "X", "a", "AwsServiceEvent", None, None, ("Root",)),
        (at, "ConsoleLogin", "a", "t", None, "Failed authentication", ("User",)), (at, "X", "a", "t", "Client.UnauthorizedAccess", None, ("User",)),
        (at, "PutBucketPolicy", "s3.amazonaws.com", "t", None, None, ("User",)), (at, "PutBucketPolicy", "other", "t", None, None, ("User",)),
        (at, "DeletePolicy", "iam", "t", "AccessDenied", None, None),
    ]
    got = {r["rule"]: r["matches"] for r in K.apply_rules(spark.createDataFrame(records, fields), K.audit_rules()).collect()}
    assert got == {"root_account_usage": 1, "console_login_failures": 1, "unauthorized_api_calls": 2, "s3_bucket_policy_changes": 1, "iam_policy_changes": 1}


def test_winner(spark):
    fields = "run string, model_type string, auc double, passed boolean"
    df = spark.createDataFrame([("r", "boosted", 0.9, True), ("r", "mlp", 0.95, False), ("s", "boosted", 0.5, False), ("t", "boosted", 0.8, True), ("t", "mlp", 0.7, True)], fields)
    assert {r["run"]: r["winner"] for r in L.pick_winner(df, ["run"]).collect()} == {"r": "boosted", "s": None, "t": "boosted"}
    assert {r["run"]: r["winner"] for r in L.pick_winner(df, ["run"], forced="mlp").collect()} == {"r": "boosted", "s": None, "t": "mlp"}


def test_cohort_names(spark):
    df = spark.createDataFrame([("2024-Q1",), ("2024-Q5",), ("x2024-Q1",), (None,)], "c string")
    assert [r[0] for r in df.select(S.valid_cohort(F.col("c"))).collect()] == [True, False, False, None]


def test_stdev_matches_statistics(spark):
    durations = [3, 8, 1, 90]
    df = spark.createDataFrame([event("a", i, "2024-03-31", duration=d) for i, d in enumerate(durations)], EVENT)
    row = X.window_features(df, lit(AS_OF), (7,)).first()
    assert row["std_session_duration_7d"] == pytest.approx(statistics.stdev(durations))


def test_boosting_goes_on_while_the_loss_falls(spark):
    """Small steps gain less than a hundredth of the loss each; they are gains nevertheless."""
    import random

    from pyspark.ml.linalg import Vectors

    from ebbtide.constants import LABEL
    from ebbtide.operators import train

    rnd = random.Random(2)
    rows = []
    for i in range(600):
        x = rnd.random()
        rows.append((Vectors.dense([x, rnd.random()]), int(rnd.random() < x), "validation" if i % 4 == 0 else "train"))
    inputs = spark.createDataFrame(rows, ["features", LABEL, "split"])
    params = {"maxIter": 8, "maxDepth": 2, "stepSize": 0.01}
    assert train.train_boosted(inputs, **params).getNumTrees > 1
