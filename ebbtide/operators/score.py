"""Batch scoring."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalars import half_up, sigmoid


def missing_features(df: DataFrame, required: Sequence[str]) -> list[str]:
    return sorted(set(required) - set(df.columns))


def require_features(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Fail before any row is read when a model input is absent; other columns are ignored."""
    absent = missing_features(df, required)
    if absent:
        raise ValueError(f"Missing required features: {absent}")
    return df


def stamped(df: DataFrame, probability: Column, threshold: float, version: str, model_type: str) -> DataFrame:
    """The prediction columns: clipped and rounded probability, decision on the unrounded one."""
    p = F.when(probability < 0, 0.0).when(probability > 1, 1.0).otherwise(probability)
    return df.withColumns({
        "churn_probability": F.round(p, 6), "churn_prediction": p >= threshold, "model_version": F.lit(version),
        "threshold": F.lit(threshold), "model_type": F.lit(model_type),
    })


def linear_logit(weights: Mapping[str, float], bias: float) -> Column:
    total = F.lit(bias)
    for name, weight in weights.items():
        total = total + F.coalesce(F.col(name).cast("double"), F.lit(0.0)) * weight
    return total


def score_linear(
    df: DataFrame, weights: Mapping[str, float], bias: float, threshold: float = 0.5, version: str = "1", model_type: str = "linear"
) -> DataFrame:
    """Logistic model as a built-in expression."""
    return stamped(require_features(df, list(weights)), sigmoid(linear_logit(weights, bias)), threshold, version, model_type)


def score_pipeline(df: DataFrame, model, threshold: float, version: str, model_type: str) -> DataFrame:
    """A fitted MLlib model with a probability vector."""
    from pyspark.ml.functions import vector_to_array

    scored = model.transform(df)
    result = stamped(scored, vector_to_array("probability")[1], threshold, version, model_type)
    return result.drop("rawPrediction", "probability", "prediction")


def score_foreign(
    df: DataFrame, predict: Callable, features: Sequence[str], key: str, threshold: float, version: str, model_type: str
) -> DataFrame:
    """A model of another library: `predict` maps a pandas frame of the features to probabilities, batch by batch."""
    names = list(features)

    def batches(frames: Iterator) -> Iterator:
        for frame in frames:
            yield frame[[key]].assign(_p=np.asarray(predict(frame[names]), dtype=float))

    kind = dict(df.dtypes)[key]
    scored = require_features(df, names).select(key, *names).mapInPandas(batches, f"{key} {kind}, _p double")
    return stamped(scored, F.col("_p"), threshold, version, model_type).drop("_p")


def ensemble(first: DataFrame, second: DataFrame, key: str = "customer_id", threshold: float = 0.5) -> DataFrame:
    """Mean probability of two models' predictions."""
    other = second.select(key, F.col("churn_probability").alias("_other"))
    mean = (F.col("churn_probability") + F.col("_other")) / 2
    return first.select(key, "churn_probability").join(other, key).select(
        key, half_up(mean, 6).alias("churn_probability"), (mean >= threshold).alias("churn_prediction")
    )
