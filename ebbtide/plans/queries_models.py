"""Preparation, evaluation, scoring, reuse and training."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..constants import NUMERIC_FEATURES
from ..operators import evaluate as E, network as N, prep as Q, reuse as U, score as S, train as T
from ..session import cut_lineage, scratch_dir
from ..sinks import writers as W
from ..sources import raw
from . import adapter as A, jobs
from .adapter import SCORED_SQL, r, with_sql
from .queries_features import FEATURES_SQL, stored_features as features
from .registry import query

SPLIT_SQL = FEATURES_SQL + """,
hashed AS (SELECT *, CAST('0x' || substr(md5(customer_id || ':42'), 1, 15) AS BIGINT) AS h FROM features),
split AS (
  SELECT *, CASE WHEN place <= floor(size * 0.2 + 0.5) THEN 'test'
                 WHEN place <= floor(size * 0.2 + 0.5) + floor(size * 0.1 + 0.5) THEN 'validation' ELSE 'train' END AS split
  FROM (SELECT *, row_number() OVER (PARTITION BY is_churned ORDER BY h, customer_id) AS place, count(*) OVER (PARTITION BY is_churned) AS size FROM hashed)
)"""


def _split(spark, sf):
    return Q.stratified_split(features(spark, sf))


@query("prep1_fill_missing", with_sql(FEATURES_SQL, "SELECT customer_id, " + ", ".join(
    r(f"coalesce({c}, 0)", c) for c in NUMERIC_FEATURES) + ", coalesce(cohort, 'unknown') AS cohort, coalesce(current_plan, 'unknown') AS current_plan FROM features"))
def _(spark, sf):
    return Q.fill_missing(features(spark, sf)).select("customer_id", *NUMERIC_FEATURES, "cohort", "current_plan")


@query("prep2_encode", with_sql(FEATURES_SQL, """
SELECT customer_id, cohort, CAST(dense_rank() OVER (ORDER BY cohort) - 1 AS INTEGER) AS cohort_encoded,
       current_plan, CAST(dense_rank() OVER (ORDER BY current_plan) - 1 AS INTEGER) AS current_plan_encoded FROM features"""))
def _(spark, sf):
    rows = Q.fill_missing(features(spark, sf))
    for column in ("cohort", "current_plan"):
        rows = Q.encode(rows, Q.fit_encoder(rows, column), column)
    return rows.select("customer_id", "cohort", "cohort_encoded", "current_plan", "current_plan_encoded")


@query("prep2_encode_unseen", with_sql(FEATURES_SQL, """
SELECT f.customer_id, f.cohort, CAST(coalesce(t.place, (SELECT count(DISTINCT cohort) FROM features WHERE current_plan = 'HOUSEHOLD')) AS INTEGER) AS cohort_encoded
FROM features f LEFT JOIN (SELECT cohort, dense_rank() OVER (ORDER BY cohort) - 1 AS place FROM (SELECT DISTINCT cohort FROM features WHERE current_plan = 'HOUSEHOLD')) t
ON f.cohort = t.cohort"""))
def _(spark, sf):
    rows = features(spark, sf).select("customer_id", "cohort", "current_plan")
    encoder = Q.fit_encoder(rows.where(F.col("current_plan") == "HOUSEHOLD"), "cohort")
    return Q.encode(rows, encoder, "cohort").select("customer_id", "cohort", "cohort_encoded")


FITTED_SQL = SPLIT_SQL + ", fitted AS (SELECT " + ", ".join(
    f"avg(coalesce({c}, 0)) AS m_{c}, CASE WHEN stddev_pop(coalesce({c}, 0)) = 0 THEN 1 ELSE stddev_pop(coalesce({c}, 0)) END AS s_{c}" for c in NUMERIC_FEATURES
) + " FROM split WHERE split = 'train')"


@query("prep3_scale", with_sql(FITTED_SQL, "SELECT customer_id, " + ", ".join(
    r(f"(coalesce({c}, 0) - m_{c}) / s_{c}", c, 4) for c in NUMERIC_FEATURES) + " FROM split, fitted"))
def _(spark, sf):
    rows = cut_lineage(Q.fill_missing(_split(spark, sf)), "filled")
    scaled = Q.scale(rows, Q.fit_scaler(rows.where(F.col("split") == "train")))
    return scaled.select("customer_id", *[F.round(F.col(c).cast("decimal(30,10)"), 4).cast("double").alias(c) for c in NUMERIC_FEATURES])


@query("prep4_stratified_split", with_sql(SPLIT_SQL, "SELECT customer_id, is_churned, split FROM split"))
def _(spark, sf):
    return _split(spark, sf).select("customer_id", "is_churned", "split")


@query("prep4_stratified_split_events", with_sql(SCORED_SQL, """
SELECT row_id, label, CASE WHEN place <= floor(size * 0.2 + 0.5) THEN 'test'
                 WHEN place <= floor(size * 0.2 + 0.5) + floor(size * 0.1 + 0.5) THEN 'validation' ELSE 'train' END AS split
FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY h, row_id) AS place, count(*) OVER (PARTITION BY label) AS size
      FROM (SELECT *, CAST('0x' || substr(md5(row_id || ':7'), 1, 15) AS BIGINT) AS h FROM scored))"""))
def _(spark, sf):
    return Q.stratified_split(A.scored(spark, sf), "label", "row_id", seed=7).select("row_id", "label", "split")


@query("prep4_hash_split", with_sql(SCORED_SQL, """
SELECT split, count(*) AS rows, count(*) FILTER (WHERE label = 1) AS positives FROM (
  SELECT label, CASE WHEN h / pow(16, 15) < 0.2 THEN 'test' WHEN h / pow(16, 15) < 0.2 + 0.1 THEN 'validation' ELSE 'train' END AS split
  FROM (SELECT *, CAST('0x' || substr(md5(row_id || ':42'), 1, 15) AS BIGINT) AS h FROM scored)) GROUP BY split"""))
def _(spark, sf):
    split = Q.hash_split(A.scored(spark, sf), "row_id")
    return split.groupBy("split").agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("label") == 1).alias("positives"))


@query("snk5_split_summary", with_sql(SPLIT_SQL, f"SELECT split, count(*) AS rows, {r('avg(is_churned)', 'churn_rate')} FROM split GROUP BY split"))
def _(spark, sf):
    return Q.split_summary(_split(spark, sf))


@query("prep5_assemble", with_sql(FEATURES_SQL, "SELECT customer_id, 27 AS width FROM features"))
def _(spark, sf):
    from pyspark.ml.functions import vector_to_array

    inputs, _, _ = T.fit_inputs(_split(spark, sf))
    return inputs.select("customer_id", F.size(vector_to_array("features")).alias("width"))


PREDICTED_SQL = SCORED_SQL + ", predicted AS (SELECT *, CASE WHEN probability >= 0.55 THEN 1 ELSE 0 END AS prediction FROM scored)"
CELLS = """(SELECT CAST(count(*) FILTER (WHERE label = 1 AND prediction = 1) AS DOUBLE) AS tp, CAST(count(*) FILTER (WHERE label = 0 AND prediction = 1) AS DOUBLE) AS fp,
  CAST(count(*) FILTER (WHERE label = 0 AND prediction = 0) AS DOUBLE) AS tn, CAST(count(*) FILTER (WHERE label = 1 AND prediction = 0) AS DOUBLE) AS fn FROM predicted)"""
AUC = """(SELECT sum(pos * (below + neg / 2)) / (sum(pos) * sum(neg)) FROM (
  SELECT CAST(pos AS DOUBLE) AS pos, CAST(neg AS DOUBLE) AS neg, CAST(coalesce(sum(neg) OVER (ORDER BY probability ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) AS below
  FROM (SELECT probability, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg FROM scored GROUP BY probability)))"""


def _predicted(spark, sf):
    return E.with_prediction(A.scored(spark, sf), 0.55)


@query("agg9_confusion_matrix", with_sql(PREDICTED_SQL, 'SELECT label, prediction, count(*) AS "count" FROM predicted GROUP BY label, prediction'))
def _(spark, sf):
    return E.confusion_matrix(_predicted(spark, sf))


@query("evl1_binary_metrics", with_sql(PREDICTED_SQL, f"""
SELECT CAST(tp + fp + tn + fn AS BIGINT) AS samples, {r("(tp + fn) / (tp + fp + tn + fn)", "churn_rate")}, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp,
       CAST(tn AS BIGINT) AS tn, CAST(fn AS BIGINT) AS fn, {r("tp / (tp + fp)", "precision")}, {r("tp / (tp + fn)", "recall")}, {r("2 * tp / (2 * tp + fp + fn)", "f1")},
       {r("(tp + tn) / (tp + fp + tn + fn)", "accuracy")}, {r("fn / (tp + fn)", "false_negative_rate")}, {r("fp / (fp + tn)", "false_positive_rate")},
       {r("tn / (fp + tn)", "specificity")} FROM {CELLS}"""))
def _(spark, sf):
    return E.binary_metrics(_predicted(spark, sf))


@query("evl2_roc_auc", with_sql(SCORED_SQL, f"SELECT {r(AUC, 'auc')}"))
def _(spark, sf):
    return E.roc_auc(A.scored(spark, sf))


GRID_SQL = SCORED_SQL + """,
grid AS (
  SELECT t, CAST(count(*) FILTER (WHERE label = 1 AND probability >= t / 100.0::DOUBLE) AS DOUBLE) AS tp, CAST(count(*) FILTER (WHERE label = 0 AND probability >= t / 100.0::DOUBLE) AS DOUBLE) AS fp,
         CAST(count(*) FILTER (WHERE label = 1) AS DOUBLE) AS p
  FROM scored, range(10, 90) g(t) GROUP BY t
)"""


@query("evl3_threshold_table", with_sql(GRID_SQL, f"""
SELECT {r("t / 100.0", "threshold")}, {r("2 * tp / (tp + fp + p)", "f1")} FROM grid"""))
def _(spark, sf):
    return E.threshold_table(A.scored(spark, sf))


@query("evl3_best_threshold", with_sql(GRID_SQL, f"""
SELECT {r("t / 100.0", "threshold")}, {r("2 * tp / (tp + fp + p)", "f1")} FROM grid ORDER BY 2 * tp / (tp + fp + p) DESC, t LIMIT 1"""))
def _(spark, sf):
    return E.best_threshold(A.scored(spark, sf))


@query("evl4_curve_points", with_sql(SCORED_SQL, f"""
SELECT {r("probability", "threshold")}, {r("tp / p", "tpr")}, {r("fp / n", "fpr")}, {r("tp / (tp + fp)", "precision")}
FROM (SELECT probability, CAST(sum(pos) OVER w AS DOUBLE) AS tp, CAST(sum(neg) OVER w AS DOUBLE) AS fp, sum(pos) OVER () AS p, sum(neg) OVER () AS n
      FROM (SELECT probability, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg FROM scored GROUP BY probability)
      WINDOW w AS (ORDER BY probability DESC))"""))
def _(spark, sf):
    return E.curve_points(A.scored(spark, sf))


GATES_SQL = with_sql(PREDICTED_SQL + ",\n" + A.REQUESTS_SQL.strip(), f"""
SELECT gate, {r("value", "value")}, threshold, CASE WHEN gate = 'p99_latency_ms' THEN value < threshold ELSE value >= threshold END AS passed
FROM (SELECT unnest(['auc', 'precision', 'recall', 'p99_latency_ms']) AS gate, unnest([0.82, 0.75, 0.70, 200.0])::DOUBLE AS threshold,
             unnest([{AUC}, tp / (tp + fp), tp / (tp + fn), (SELECT quantile_cont(latency_ms, 0.99) FROM requests)]) AS value FROM {CELLS})""")


def _gates(spark, sf):
    from ..functions.running import exact_percentiles

    p99 = exact_percentiles(A.request_log(spark, sf), [], "latency_ms", {"p99": 0.99}).scalar()
    return E.quality_gates(E.evaluation(A.scored(spark, sf), 0.55).withColumn("p99_latency_ms", p99))


@query("evl5_quality_gates", GATES_SQL)
def _(spark, sf):
    return _gates(spark, sf)


@query("evl5_gate_result", f"""
SELECT bool_and(passed) AS passed, coalesce(string_agg(gate, ',' ORDER BY gate) FILTER (WHERE NOT passed), '') AS failures FROM ({GATES_SQL})""")
def _(spark, sf):
    return E.gate_result(_gates(spark, sf))


WEIGHTS = {"days_since_last_login": 0.8, "support_ticket_rate_30d": 4.0, "total_events_7d": -0.05, "session_duration_trend": -1.0}
LOGIT = "0.1 + 0.8 * days_since_last_login + 4.0 * support_ticket_rate_30d - 0.05 * total_events_7d - 1.0 * session_duration_trend"


@query("scr1_score_linear", with_sql(FEATURES_SQL, f"""
SELECT customer_id, {r("p", "churn_probability")}, p >= 0.5 AS churn_prediction, '3' AS model_version, CAST(0.5 AS DOUBLE) AS threshold, 'linear' AS model_type
FROM (SELECT customer_id, 1 / (1 + exp(-({LOGIT}))) AS p FROM features)"""))
def _(spark, sf):
    scored = S.score_linear(features(spark, sf), WEIGHTS, 0.1, version="3")
    return scored.select("customer_id", *U.PREDICTION)


@query("scr1_score_foreign", with_sql(A.CURATED_SQL, f"""
SELECT event_id, {r("least(session_duration / 100.0, 1)", "churn_probability")}, session_duration / 100.0 >= 0.4 AS churn_prediction,
       'f1' AS model_version, CAST(0.4 AS DOUBLE) AS threshold, 'foreign' AS model_type FROM curated"""))
def _(spark, sf):
    def predict(frame):
        return frame["session_duration"] / 100.0

    return S.score_foreign(A.curated_events(spark, sf), predict, ["session_duration"], "event_id", 0.4, "f1", "foreign")


@query("scr5_ensemble", with_sql(FEATURES_SQL, f"""
SELECT customer_id, {r("(a + b) / 2", "churn_probability")}, (a + b) / 2 >= 0.5 AS churn_prediction
FROM (SELECT customer_id, round(1 / (1 + exp(-({LOGIT}))), 6) AS a, round(1 / (1 + exp(-(-0.5 + 0.3 * days_since_last_login))), 6) AS b FROM features)"""))
def _(spark, sf):
    rows = features(spark, sf)
    second = S.score_linear(rows, {"days_since_last_login": 0.3}, -0.5)
    return S.ensemble(S.score_linear(rows, WEIGHTS, 0.1), second)


KEYED = list(WEIGHTS)
STORE_SQL = FEATURES_SQL + f""",
numbered AS (SELECT *, CAST(substr(customer_id, 6) AS INTEGER) AS no FROM features),
store AS (SELECT customer_id, no, TIMESTAMP '{A.AS_OF}' - to_minutes(no % 10) AS scored_at FROM numbered)"""


def _store(spark, sf, rows):
    """A stored prediction for every customer, made up to nine minutes ago."""
    no = F.substring("customer_id", 6, 20).cast("int")
    stored = S.stamped(U.keyed(rows, KEYED), F.lit(0.25), 0.5, "1", "stored")
    return stored.withColumn("scored_at", A.as_of() - F.make_dt_interval(mins=no % 10))


def _written_store(spark, sf, rows):
    """The store as files by date; a run of another month lies beside it."""
    path = scratch_dir(spark, "store")
    stored = _store(spark, sf, rows).withColumn("cached", F.lit(False))
    held = stored.select("prediction_key", "customer_id", *U.PREDICTION, "scored_at", F.to_date("scored_at").alias("date"))
    W.append_predictions(held, path, "stored")
    U.write_store(stored.drop("scored_at"), path, F.lit("2023-12-01").cast("timestamp"), "old")
    return path


def _incremental(spark, sf):
    rows = features(spark, sf)
    path = _written_store(spark, sf, rows)
    store = U.read_store(spark, path, dt.datetime.fromisoformat(A.AS_OF))
    scored = U.incremental_score(
        rows.select("customer_id", *WEIGHTS), store, lambda df: S.score_linear(df, WEIGHTS, 0.1, version="3"), KEYED, A.as_of())
    return path, scored


@query("jn5_incremental_score", with_sql(STORE_SQL, f"""
SELECT n.customer_id, s.customer_id IS NOT NULL AS cached, {r(f"CASE WHEN s.customer_id IS NOT NULL THEN 0.25 ELSE 1 / (1 + exp(-({LOGIT}))) END", "churn_probability")},
       CASE WHEN s.customer_id IS NOT NULL THEN '1' ELSE '3' END AS model_version
FROM numbered n LEFT JOIN store s ON n.customer_id = s.customer_id AND s.scored_at > TIMESTAMP '{A.AS_OF}' - INTERVAL 300 SECOND"""))
def _(spark, sf):
    return _incremental(spark, sf)[1].select("customer_id", "cached", "churn_probability", "model_version")


@query("scr3_rows_to_store", with_sql(STORE_SQL, f"""
SELECT customer_id, TIMESTAMP '{A.AS_OF}' AS scored_at, DATE '2024-01-31' AS date FROM numbered WHERE no % 10 >= 5"""))
def _(spark, sf):
    """What was scored now, written twice as the same run and read back."""
    path, scored = _incremental(spark, sf)
    for _ in range(2):
        U.write_store(scored, path, A.as_of(), "now")
    return U.read_store(spark, path, dt.datetime.fromisoformat(A.AS_OF)).where("run = 'now'").select("customer_id", "scored_at", "date")


@query("scr2_missing_features", "SELECT count(*) AS customers, 'no_such_input' AS missing, 'c_acctbal' AS present FROM customer")
def _(spark, sf):
    rows = A.table(spark, sf, "customer")
    missing = S.missing_features(rows, ["c_acctbal", "no_such_input"])
    S.require_features(rows, ["c_acctbal"])
    return rows.agg(F.count(F.lit(1)).alias("customers")).select("customers", F.lit(",".join(missing)).alias("missing"), F.lit("c_acctbal").alias("present"))


@query("src10_schema_diff", """SELECT 'c_note' AS "column", 'added' AS change, count(*) AS customers FROM customer""")
def _(spark, sf):
    """The table's own schema against one that lacks a column and has another."""
    rows = A.table(spark, sf, "customer").withColumn("c_note", F.lit("x"))
    known = A.table(spark, sf, "customer").schema
    diff = raw.schema_diff(spark, known, rows.schema)
    return diff.select("column", "change").withColumn("customers", rows.agg(F.count(F.lit(1))).scalar())


@query("job_score", with_sql(FEATURES_SQL, """
SELECT CASE WHEN CAST(substr(customer_id, 6) AS INTEGER) % 2 = 0 THEN TIMESTAMP '2024-01-31 06:00:00' ELSE TIMESTAMP '2024-01-31 18:00:00' END AS scored_at, count(*) AS predictions
FROM features GROUP BY 1"""))
def _(spark, sf):
    """Two runs on one day, the first of them repeated: both stay, once."""
    rows, path = features(spark, sf), scratch_dir(spark, "scores")
    even = F.substring("customer_id", 6, 20).cast("int") % 2 == 0
    for hour, mine in ((6, even), (18, ~even), (6, even)):
        jobs.score(rows.where(mine), path, dt.datetime(2024, 1, 31, hour), lambda df: S.score_linear(df, WEIGHTS, 0.1))
    return spark.read.parquet(path).groupBy("scored_at").agg(F.count(F.lit(1)).alias("predictions"))


@query("scr4_invalidated", with_sql(STORE_SQL, """
SELECT customer_id, scored_at FROM store WHERE customer_id NOT IN (SELECT 'cust_' || c_custkey FROM customer WHERE c_acctbal > 5000)"""))
def _(spark, sf):
    refreshed = A.table(spark, sf, "customer").where(F.col("c_acctbal") > 5000).select(
        F.concat(F.lit("cust_"), F.col("c_custkey")).alias("customer_id"))
    return U.invalidated(_store(spark, sf, features(spark, sf)), refreshed).select("customer_id", "scored_at")


def _inputs(spark, sf):
    return T.fit_inputs(_split(spark, sf))[0]


# What holds of any trained model: every customer is scored, with a probability, not worse than by chance where it learned
# (as good as chance when there are too few rows for a single split).
TRAINED_SQL = with_sql(FEATURES_SQL, "SELECT count(*) AS scored, TRUE AS in_range, TRUE AS not_worse_than_chance FROM features")


def _properties(scored):
    train = scored.where("split = 'train'").select(F.col("is_churned").alias("label"), F.col("churn_probability").alias("probability"))
    auc = E.roc_auc(train).scalar()
    return scored.agg(
        F.count(F.lit(1)).alias("scored"), F.bool_and(F.col("churn_probability").between(0, 1)).alias("in_range")
    ).withColumn("not_worse_than_chance", auc >= 0.5)


def _model_rows(inputs, model, name):
    scored = S.score_pipeline(inputs, model, 0.5, "1", name).select("customer_id", "is_churned", "split", *U.PREDICTION)
    return _properties(cut_lineage(scored, "scored"))


@query("trn1_boosted_trees", TRAINED_SQL)
def _(spark, sf):
    inputs = _inputs(spark, sf)
    return _model_rows(inputs, T.train_boosted(inputs), "boosted")


@query("trn2_perceptron", TRAINED_SQL)
def _(spark, sf):
    inputs = _inputs(spark, sf)
    return _model_rows(inputs, T.train_mlp(inputs, len(Q.model_columns())), "mlp")


@query("trn3_search", TRAINED_SQL)
def _(spark, sf):
    inputs = _inputs(spark, sf)
    return _model_rows(inputs, T.search(inputs, T.draw_trials(T.TRIALS))[0], "boosted")


# A label that the features tell: more events in a month than the average customer.
LEARNED_SQL = with_sql(FEATURES_SQL, "SELECT count(*) AS customers, TRUE AS found_on_held_out_rows FROM features")


def _planted(spark, sf):
    rows = features(spark, sf)
    many = F.coalesce(F.col("total_events_30d"), F.lit(0)) > rows.agg(F.avg(F.coalesce(F.col("total_events_30d"), F.lit(0)))).scalar()
    return T.fit_inputs(Q.stratified_split(rows.withColumn("is_churned", many.cast("int"))))[0]


def _found(inputs, scored, probability="churn_probability", least=0.9):
    """Whether the test rows, which no training has seen, are ranked right."""
    held = scored.where("split = 'test'").select(F.col("is_churned").alias("label"), F.col(probability).alias("probability"))
    return inputs.agg(F.count(F.lit(1)).alias("customers")).withColumn("found_on_held_out_rows", E.roc_auc(held).scalar() > least)


@query("trn1_learned", LEARNED_SQL)
def _(spark, sf):
    inputs = _planted(spark, sf)
    return _found(inputs, S.score_pipeline(inputs, T.train_boosted(inputs, patience=5, maxIter=30), 0.5, "1", "boosted"))


@query("trn2_learned", LEARNED_SQL)
def _(spark, sf):
    """The network with validation stop and a step that is lowered on plateaus."""
    inputs = _planted(spark, sf)
    rows = T.boosted_rows(inputs)
    train, validation = (rows.where(F.col("split") == part).drop("split") for part in ("train", "validation"))
    net = N.train_network(train, validation, len(Q.model_columns()), epochs=15, batch=16, step=0.01, patience=8, plateau=3)
    return _found(inputs, net.probabilities(inputs), "probability", 0.8)


@query("trn3_learned", LEARNED_SQL)
def _(spark, sf):
    inputs = _planted(spark, sf)
    trials = [{**t, "maxIter": 32} for t in T.draw_trials(4)]
    return _found(inputs, S.score_pipeline(inputs, T.search(inputs, trials, first_trees=8)[0], 0.5, "1", "boosted"))


@query("trn4_planted_first", with_sql(FEATURES_SQL, "SELECT 'total_events_30d' AS feature, TRUE AS more_than_one_split, count(*) AS customers FROM features"))
def _(spark, sf):
    """The most important input of a model whose label was made from it."""
    inputs = _planted(spark, sf)
    model = T.train_boosted(inputs, patience=5, maxIter=20)
    first = T.feature_importance(spark, model, Q.model_columns()).orderBy(F.desc("importance"), "feature").limit(1)
    return first.select("feature", F.lit(model.totalNumNodes > model.getNumTrees).alias("more_than_one_split")).crossJoin(
        inputs.agg(F.count(F.lit(1)).alias("customers")))


@query("trn4_feature_importance", "SELECT 27 AS inputs, TRUE AS sums_to_one, count(*) > 0 AS trained FROM customer")
def _(spark, sf):
    model = T.train_boosted(_inputs(spark, sf))
    shares = T.feature_importance(spark, model, Q.model_columns())
    # Without any split there is nothing to share out.
    split_less = F.lit(model.totalNumNodes == model.getNumTrees) & (F.sum("importance") == 0)
    return shares.agg(
        F.count(F.lit(1)).cast("int").alias("inputs"), ((F.abs(F.sum("importance") - 1) < 1e-9) | split_less).alias("sums_to_one"),
        F.lit(True).alias("trained"))
