"""Model training with MLlib."""

from __future__ import annotations

import math
import random
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, functions as F

from ..constants import LABEL
from ..session import cut_lineage, dealt
from . import prep
from .boosting import MOST_TREES, PATIENCE, Fitted, fit_trees, fit_with_patience

# Defaults of the boosted trees, and how many trials a search makes.
BOOSTED_DEFAULTS = {"maxDepth": 6, "minInstancesPerNode": 5, "subsamplingRate": 0.8, "stepSize": 0.05, "maxIter": MOST_TREES}
TRIALS = 20

# Trees of each trial in the first round of a search.
FIRST_TREES = 8

# Hidden layers of the perceptron.
MLP_LAYERS = [256, 128, 64]

# Search ranges (low, high, scale).
SEARCH_SPACE = {
    "stepSize": (0.01, 0.3, "log"),
    "subsamplingRate": (0.5, 1.0, "linear"),
    "maxDepth": (3, 10, "integer"),
    "minInstancesPerNode": (1, 20, "integer"),
    "maxIter": (100, 1000, "log_integer"),
}


def weighted(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Add `weight`: negatives per positive for the positives, 1 for the others."""
    balance = df.agg(F.try_divide(F.count_if(F.col(label) == 0), F.count_if(F.col(label) == 1))).scalar()
    return df.withColumn("weight", F.when(F.col(label) == 1, F.coalesce(balance, F.lit(1.0))).otherwise(1.0))


def balanced(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Repeat positives until the classes weigh about the same; no row is left out."""
    times = df.agg(F.greatest(F.round(F.try_divide(F.count_if(F.col(label) == 0), F.count_if(F.col(label) == 1))), F.lit(1.0))).scalar()
    copies = F.when(F.col(label) == 1, F.coalesce(times, F.lit(1.0)).cast("int")).otherwise(1)
    return df.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies))).drop("_copy")


def fit_inputs(split: DataFrame) -> tuple[DataFrame, DataFrame, dict[str, DataFrame]]:
    """Model inputs of all rows, stored in even parts, with scaler and encoders fitted on the training rows only."""
    split = cut_lineage(split, "split")
    train = prep.fill_missing(split.where(F.col("split") == "train"))
    scaler = prep.fit_scaler(train)
    encoders = {c: prep.fit_encoder(train, c) for c in prep.CATEGORICAL_FEATURES}
    inputs = prep.assemble(prep.prepare_inputs(split, scaler, encoders))
    return cut_lineage(dealt(inputs), "inputs"), scaler, encoders


def boosted_rows(inputs: DataFrame) -> DataFrame:
    """Weighted train and validation rows, stored in even parts: every fit and every look at the losses reads them."""
    rows = weighted(inputs.where(F.col("split").isin("train", "validation"))).select("features", LABEL, "weight", "split")
    return cut_lineage(dealt(rows), "boosted")


def fit_boosted(rows: DataFrame, patience: int = PATIENCE, seed: int = 42, begun=None, **params) -> Fitted:
    """Boosted trees of stored rows, stopped after `patience` rounds without gain on the validation rows."""
    train, validation = (rows.where(F.col("split") == part).drop("split") for part in ("train", "validation"))
    return fit_with_patience(train, validation, patience, seed, begun, **{**BOOSTED_DEFAULTS, **params})


def train_boosted(inputs: DataFrame, patience: int = PATIENCE, seed: int = 42, **params):
    """The model of `fit_boosted`."""
    return fit_boosted(boosted_rows(inputs), patience, seed, **params).model


def train_mlp(inputs: DataFrame, width: int, layers: Sequence[int] = tuple(MLP_LAYERS), seed: int = 42, **params):
    """Multilayer perceptron on the balanced train rows."""
    from pyspark.ml.classification import MultilayerPerceptronClassifier

    net = MultilayerPerceptronClassifier(
        featuresCol="features", labelCol=LABEL, layers=[width, *layers, 2], seed=seed, **{"maxIter": 100, **params}
    )
    return net.fit(balanced(inputs.where(F.col("split") == "train")))


def draw_trials(trials: int, seed: int = 42, space: dict = SEARCH_SPACE) -> list[dict]:
    """Seeded random points of the search space."""
    rng = random.Random(seed)

    def draw(low, high, scale):
        if scale.startswith("log"):
            value = math.exp(rng.uniform(math.log(low), math.log(high)))
            return round(value) if scale == "log_integer" else value
        return rng.randint(low, high) if scale == "integer" else rng.uniform(low, high)

    return [{name: draw(*limits) for name, limits in space.items()} for _ in range(trials)]


def search(inputs: DataFrame, trials: Sequence[dict], first_trees: int = FIRST_TREES, parallelism: int = TRIALS, seed: int = 42):
    """(model, trial, AUC) of the trial that ranks the validation rows best, by successive halving; trained on train rows only.

    All trials begin with `first_trees` trees. The better half of a round goes on with twice as many, until one is left; that
    one is trained in full and stopped like any training, from its last ensemble on. All fits read the same stored rows. A fit
    is a chain of small jobs that leave most cores idle, so the trials of a round go side by side; no model of a trial that has
    dropped out is kept.
    """
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    judge = BinaryClassificationEvaluator(labelCol=LABEL, metricName="areaUnderROC")
    rows = boosted_rows(inputs)
    train, validation = (rows.where(F.col("split") == part).drop("split") for part in ("train", "validation"))

    def attempt(trial: dict, trees: int) -> tuple:
        params = {**BOOSTED_DEFAULTS, **trial}
        model = fit_trees(train, min(trees, trial.get("maxIter", trees)), seed, **params)
        return judge.evaluate(model.transform(validation)), model

    alive, trees, begun = list(trials), first_trees, None
    with ThreadPoolExecutor(parallelism) as pool:
        while len(alive) > 1:
            found = list(pool.map(inheritable_thread_target(inputs.sparkSession)(attempt), alive, [trees] * len(alive)))
            order = sorted(range(len(alive)), key=lambda i: -found[i][0])
            begun = found[order[0]][1]
            alive, trees = [alive[i] for i in order[: (len(alive) + 1) // 2]], 2 * trees
    fitted = fit_boosted(rows, seed=seed, begun=begun, **alive[0])
    return fitted.model, alive[0], judge.evaluate(fitted.model.transform(validation))


def feature_importance(spark, model, columns: Sequence[str]) -> DataFrame:
    """One row per model input with its share of the total importance."""
    shares = model.featureImportances.toArray()
    rows = [(name, float(share)) for name, share in zip(columns, shares)]
    return spark.createDataFrame(rows, "feature string, importance double")
