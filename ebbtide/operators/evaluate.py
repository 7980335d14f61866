"""Evaluation of binary classifiers from rows of (label, probability)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..constants import QUALITY_GATES
from ..functions.running import running
from ..functions.scalars import ratio_or_zero

FIRST_CENT, LAST_CENT = 10, 89


def with_prediction(scored: DataFrame, threshold: float, probability: str = "probability") -> DataFrame:
    return scored.withColumn("prediction", (F.col(probability) >= threshold).cast("int"))


def confusion_matrix(predicted: DataFrame) -> DataFrame:
    return predicted.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("count"))


def _rates(tp: Column, fp: Column, tn: Column, fn: Column) -> list[Column]:
    """Rates of the positive class; 0 where a denominator is 0."""
    return [
        ratio_or_zero(tp, tp + fp).alias("precision"),
        ratio_or_zero(tp, tp + fn).alias("recall"),
        ratio_or_zero(2 * tp, 2 * tp + fp + fn).alias("f1"),
        ratio_or_zero(tp + tn, tp + fp + tn + fn).alias("accuracy"),
        ratio_or_zero(fn, tp + fn).alias("false_negative_rate"),
        ratio_or_zero(fp, fp + tn).alias("false_positive_rate"),
        ratio_or_zero(tn, fp + tn).alias("specificity"),
    ]


def binary_metrics(predicted: DataFrame) -> DataFrame:
    """Metrics of 0/1 predictions in one aggregation."""

    def cell(label: int, prediction: int) -> Column:
        return F.count_if((F.col("label") == label) & (F.col("prediction") == prediction))

    counts = predicted.agg(
        cell(1, 1).alias("tp"), cell(0, 1).alias("fp"), cell(0, 0).alias("tn"), cell(1, 0).alias("fn"),
        F.count(F.lit(1)).alias("samples"), F.avg(F.col("label").cast("double")).alias("churn_rate"),
    )
    c = F.col
    return counts.select("samples", "churn_rate", "tp", "fp", "tn", "fn", *_rates(c("tp"), c("fp"), c("tn"), c("fn")))


def _per_score(scored: DataFrame, probability: str) -> DataFrame:
    """Positives and negatives per distinct score, combined before the shuffle."""
    return scored.groupBy(F.col(probability).cast("double").alias("score")).agg(
        F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg")
    )

def roc_auc(scored: DataFrame, probability: str = "probability") -> DataFrame:
    """Probability that a positive outranks a negative, ties counting half; NULL with one class only."""
    counts = _per_score(scored, probability)
    upto = running(counts, [], [F.col("score")], {"neg_upto": ("sum", F.col("neg"))})
    wins = F.col("pos").cast("double") * (F.col("neg_upto") - F.col("neg") + F.col("neg") / 2)
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return upto.agg(F.try_divide(F.sum(wins), pairs).alias("auc"))


def curve_points(scored: DataFrame, probability: str = "probability") -> DataFrame:
    """ROC and precision-recall coordinates at every distinct score used as threshold."""
    counts = _per_score(scored, probability)
    sums = {"tp": ("sum", F.col("pos")), "fp": ("sum", F.col("neg"))}
    upto = running(counts, [], [F.col("score").desc()], sums, whole={"p": "tp", "n": "fp"})
    return upto.select(
        F.col("score").alias("threshold"),
        F.try_divide(F.col("tp"), F.col("p")).alias("tpr"),
        F.try_divide(F.col("fp"), F.col("n")).alias("fpr"),
        F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
    )


def _cents(probability: Column) -> Column:
    """Largest whole i with probability >= i / 100, free of the rounding of probability * 100."""
    guess = F.floor(probability * 100)
    up = F.when(probability >= (guess + 1) / F.lit(100.0), guess + 1).otherwise(guess)
    return F.when(probability < up / F.lit(100.0), up - 1).otherwise(up)


def threshold_table(scored: DataFrame, probability: str = "probability") -> DataFrame:
    """F1 at each threshold 0.10 .. 0.89: one pass into at most 81 bins, then running sums over the bins."""
    bin_no = F.least(F.greatest(_cents(F.col(probability)), F.lit(FIRST_CENT - 1)), F.lit(LAST_CENT))
    counts = scored.groupBy(bin_no.alias("cent")).agg(
        F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg")
    )
    grid = scored.sparkSession.range(FIRST_CENT - 1, LAST_CENT + 1).withColumnRenamed("id", "cent")
    filled = grid.join(counts, "cent", "left").fillna(0, ["pos", "neg"])
    above = W.orderBy(F.desc("cent")).rowsBetween(W.unboundedPreceding, W.currentRow)
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    at = filled.select(
        "cent", F.sum("pos").over(above).alias("tp"), F.sum("neg").over(above).alias("fp"), F.sum("pos").over(everything).alias("p")
    ).where(F.col("cent") >= FIRST_CENT)
    return at.select(
        (F.col("cent") / F.lit(100.0)).alias("threshold"),
        ratio_or_zero(2 * F.col("tp"), F.col("tp") + F.col("fp") + F.col("p")).alias("f1"),
    )


def best_threshold(scored: DataFrame, probability: str = "probability") -> DataFrame:
    """Lowest threshold of the highest F1; 0.5 when no threshold finds a positive."""
    best = threshold_table(scored, probability).agg(F.max(F.struct("f1", (-F.col("threshold")).alias("t"))).alias("b"))
    useful = F.col("b.f1") > 0
    return best.select(F.when(useful, -F.col("b.t")).otherwise(0.5).alias("threshold"), F.col("b.f1").alias("f1"))


def evaluation(scored: DataFrame, threshold: float, probability: str = "probability") -> DataFrame:
    """Threshold metrics and AUC in one row."""
    return binary_metrics(with_prediction(scored, threshold, probability)).withColumn("auc", roc_auc(scored, probability).scalar())


def quality_gates(metrics: DataFrame, gates: Mapping[str, float] = QUALITY_GATES) -> DataFrame:
    """One row per gate with value, threshold and result; latency must stay below, all others reach it."""
    rows = [
        F.struct(
            F.lit(gate).alias("gate"), F.col(gate).cast("double").alias("value"), F.lit(float(limit)).alias("threshold"),
            F.coalesce(F.col(gate) < limit if gate.endswith("latency_ms") else F.col(gate) >= limit, F.lit(False)).alias("passed"),
        )
        for gate, limit in gates.items()
    ]
    return metrics.select(F.explode(F.array(*rows)).alias("g")).select("g.*")


def gate_result(gates: DataFrame) -> DataFrame:
    """Overall result and the failed gates; there are as many gates as thresholds."""
    failed = F.array_sort(F.collect_set(F.when(~F.col("passed"), F.col("gate"))))
    return gates.agg(F.bool_and("passed").alias("passed"), F.concat_ws(",", failed).alias("failures"))


def against_baseline(metrics: DataFrame, minimum: Mapping[str, float]) -> DataFrame:
    """Model-quality violations: metrics below their baseline minimum."""
    rows = [
        F.struct(F.lit(name).alias("metric"), F.col(name).cast("double").alias("value"), F.lit(float(low)).alias("minimum"))
        for name, low in minimum.items()
    ]
    long = metrics.select(F.explode(F.array(*rows)).alias("m")).select("m.*")
    return long.withColumn("violated", F.coalesce(F.col("value") < F.col("minimum"), F.lit(True)))
