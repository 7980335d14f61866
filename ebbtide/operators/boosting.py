"""Boosted trees that stop when the validation rows have gained nothing for a number of rounds.

MLlib can only stop at the first round without gain. Here trees are fitted in slices that grow fourfold, each from the first
tree; after each slice the loss of every prefix of the ensemble on the validation rows comes from one pass, and the best prefix
is what is kept. With the same seed and rows a shorter ensemble is a prefix of a longer one, so the kept model is a fit of that
many trees, whatever the slices.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..constants import LABEL

# Rounds without gain that are waited for, and the most trees.
PATIENCE, MOST_TREES = 30, 500

# A slice is so many times the one before: every level of a tree is a job, and a slice repeats all trees of the last one.
GROWTH = 4


class Fitted(NamedTuple):
    """The kept model, the validation loss after each tree that was fitted, and why fitting ended."""

    model: object
    losses: list[float]
    ended: str

    @property
    def trees(self) -> int:
        return self.model.getNumTrees


def best_prefix(losses: Sequence[float], patience: int) -> tuple[int, bool]:
    """How many trees to keep, and whether `patience` rounds went by without a lower loss; later rounds do not count then."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            return best + 1, True
    return best + 1, False


def fit_trees(train: DataFrame, trees: int, seed: int = 42, **params):
    """An ensemble of exactly so many trees of `train` (features, label, weight)."""
    from pyspark.ml.classification import GBTClassifier

    return GBTClassifier(featuresCol="features", labelCol=LABEL, weightCol="weight", seed=seed, **{**params, "maxIter": trees}).fit(train)


def fit_with_patience(train: DataFrame, validation: DataFrame, patience: int = PATIENCE, seed: int = 42, begun=None, **params) -> Fitted:
    """Boosted trees of `train` (features, label, weight), cut where the loss on `validation` was least.

    Both are read several times and have to be stored. Without validation rows all trees are kept. `begun` may be an ensemble
    of the same rows, seed and parameters that is there already: it is the first slice.
    """
    most = params.pop("maxIter", MOST_TREES)

    def fit(trees: int):
        return begun if begun is not None and begun.getNumTrees == trees else fit_trees(train, trees, seed, **params)

    if validation.isEmpty():
        return Fitted(fit(most), [], "no validation rows")
    size = min(most, begun.getNumTrees if begun is not None else 2 * patience)
    while True:
        model = fit(size)
        losses = list(model.evaluateEachIteration(validation))
        keep, waited = best_prefix(losses, patience)
        if waited or size == most:
            break
        size = min(most, GROWTH * size)
    return Fitted(model if keep == size else fit(keep), losses, "patience" if waited else "all trees")


def report(spark: SparkSession, fitted: Fitted) -> DataFrame:
    """One row per tree that was fitted: its validation loss and whether it was kept; at most as many as the most trees."""
    rows = [(i + 1, float(loss), i < fitted.trees) for i, loss in enumerate(fitted.losses)]
    return spark.createDataFrame(rows, "tree int, validation_loss double, kept boolean").withColumn("ended", F.lit(fitted.ended))
