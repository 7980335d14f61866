"""A feed-forward network trained over all partitions, with validation stop and a learning rate that is lowered on plateaus.

An epoch is one job: every task starts from the same state, takes steps over mini-batches of its own rows (Adam with decoupled
weight decay), and returns its state once; states are averaged, weighted by rows, in two levels of a tree. A task holds one
mini-batch and a few copies of the state, whatever the number of rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from ..constants import LABEL

# Hidden layers, step, decay, rows of a mini-batch, epochs at most, epochs without gain until the end and until
# the step is lowered, and the factor by which it is.
LAYERS, STEP, DECAY, BATCH, EPOCHS, PATIENCE, PLATEAU, FACTOR = (256, 128, 64), 1e-3, 1e-4, 512, 100, 10, 5, 0.5

# Adam's moments, and the relative gain that counts on a plateau.
FIRST, SECOND, SMALL, GAIN = 0.9, 0.999, 1e-8, 1e-4


def shapes(width: int, layers: Sequence[int]) -> list[tuple[int, int]]:
    sizes = [width, *layers, 1]
    return list(zip(sizes, sizes[1:]))


def initial(width: int, layers: Sequence[int], seed: int) -> np.ndarray:
    """Weights scaled by the inputs of a layer, zero biases, as one vector."""
    rng = np.random.default_rng(seed)
    return np.concatenate([np.concatenate([rng.normal(0, math.sqrt(2 / a), a * b), np.zeros(b)]) for a, b in shapes(width, layers)])


def _unpacked(vector: np.ndarray, kinds: Sequence[tuple[int, int]]) -> list[tuple[np.ndarray, np.ndarray]]:
    out, at = [], 0
    for a, b in kinds:
        out.append((vector[at : at + a * b].reshape(a, b), vector[at + a * b : at + a * b + b]))
        at += a * b + b
    return out


def forward(vector: np.ndarray, kinds: Sequence[tuple[int, int]], x: np.ndarray) -> list[np.ndarray]:
    """Inputs of every layer, then the logits."""
    parts, flow = _unpacked(vector, kinds), [x]
    for i, (w, b) in enumerate(parts):
        z = flow[-1] @ w + b
        flow.append(np.maximum(z, 0) if i < len(parts) - 1 else z)
    return flow


def gradient(vector: np.ndarray, kinds: Sequence[tuple[int, int]], x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, float]:
    """Of the weighted mean log loss, and the loss."""
    flow, parts = forward(vector, kinds, x), _unpacked(vector, kinds)
    z, total = flow[-1][:, 0], max(w.sum(), 1e-12)
    loss = float((w * (np.logaddexp(0, z) - y * z)).sum() / total)
    back, grads = ((1 / (1 + np.exp(-np.clip(z, -500, 500))) - y) * w / total)[:, None], []
    for i in reversed(range(len(parts))):
        grads.append(np.concatenate([(flow[i].T @ back).ravel(), back.sum(0)]))
        if i:
            back = (back @ parts[i][0].T) * (flow[i] > 0)
    return np.concatenate(grads[::-1]), loss


class State(NamedTuple):
    """Weights with Adam's two moments, and steps taken so far."""

    weights: np.ndarray
    first: np.ndarray
    second: np.ndarray
    steps: int


def stepped(state: State, grad: np.ndarray, rate: float, decay: float) -> State:
    n = state.steps + 1
    first, second = FIRST * state.first + (1 - FIRST) * grad, SECOND * state.second + (1 - SECOND) * grad * grad
    move = (first / (1 - FIRST**n)) / (np.sqrt(second / (1 - SECOND**n)) + SMALL)
    return State(state.weights - rate * (move + decay * state.weights), first, second, n)


def epoch_over(batches: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]], state: State, kinds, rate: float, decay: float) -> tuple[State, int, float]:
    """Steps over mini-batches; the state, the rows and the sum of the losses times rows."""
    rows, lost = 0, 0.0
    for x, y, w in batches:
        grad, loss = gradient(state.weights, kinds, x, y, w)
        state, rows, lost = stepped(state, grad, rate, decay), rows + len(x), lost + loss * len(x)
    return state, rows, lost


def averaged(states: Sequence[tuple[State, int, float]]) -> tuple[State, int, float]:
    """Weighted by rows; steps are the most that any took."""
    rows = sum(n for _, n, _ in states)
    mean = [sum(s[i] * (n / rows) for s, n, _ in states) for i in range(3)]
    return State(*mean, max(s.steps for s, _, _ in states)), rows, sum(lost for _, _, lost in states)


def _batches(arrow: Iterator[pa.RecordBatch], width: int, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Mini-batches of exactly `size` rows but for the last."""
    held, n = [], 0

    def matrix(batch: pa.RecordBatch) -> tuple:
        x = batch.column(0).flatten().to_numpy().reshape(-1, width).astype(float)
        return x, batch.column(1).to_numpy().astype(float), batch.column(2).to_numpy().astype(float)

    for batch in arrow:
        if batch.num_rows:
            held.append(matrix(batch))
            n += batch.num_rows
        while n >= size:
            joined = [np.concatenate(c) for c in zip(*held)]
            yield tuple(c[:size] for c in joined)
            held, n = [tuple(c[size:] for c in joined)], n - size
    if n:
        yield tuple(np.concatenate(c) for c in zip(*held))


_PART = T.StructType([T.StructField("part", T.LongType()), T.StructField("steps", T.LongType()), T.StructField("rows", T.LongType()), T.StructField("lost", T.DoubleType()), T.StructField("state", T.BinaryType())])


def _row(part: int, found: tuple[State, int, float]) -> dict:
    state, rows, lost = found
    return {"part": part, "steps": state.steps, "rows": rows, "lost": lost, "state": np.concatenate(state[:3]).tobytes()}


def _read(row) -> tuple[State, int, float]:
    return State(*np.split(np.frombuffer(row["state"], float), 3), row["steps"]), row["rows"], row["lost"]


def _epoch(rows: DataFrame, state: State, kinds, rate: float, decay: float, size: int) -> tuple[State, int, float]:
    spark, width = rows.sparkSession, kinds[0][0]
    shared = spark.sparkContext.broadcast(state)

    def run(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.taskcontext import TaskContext

        found = epoch_over(_batches(arrow, width, size), shared.value, kinds, rate, decay)
        if found[1]:
            yield pa.RecordBatch.from_pylist([_row(TaskContext.get().partitionId(), found)], schema=flat)

    def join(table: pa.Table) -> pa.Table:
        parts = sorted(table.to_pylist(), key=lambda r: r["part"])
        return pa.Table.from_pylist([_row(parts[0]["part"], averaged([_read(r) for r in parts]))], schema=flat)

    flat = pa.schema([("part", pa.int64()), ("steps", pa.int64()), ("rows", pa.int64()), ("lost", pa.float64()), ("state", pa.binary())])
    groups = max(1, math.isqrt(rows.rdd.getNumPartitions()))
    states = rows.mapInArrow(run, _PART).groupBy(F.pmod("part", F.lit(groups)).alias("g")).applyInArrow(join, _PART)
    found = averaged([_read(r) for r in sorted(states.collect(), key=lambda r: r["part"])])
    shared.destroy()
    return found


class Network(NamedTuple):
    """The weights of the best epoch, and per epoch (train loss, validation AUC, step)."""

    weights: np.ndarray
    kinds: list[tuple[int, int]]
    history: list[tuple[float, float, float]]
    best_epoch: int

    def probabilities(self, df: DataFrame, features: str = "features", name: str = "probability") -> DataFrame:
        """Add the probability of class 1; NULL where the features are."""
        from pyspark.ml.functions import vector_to_array
        from pyspark.sql.functions import pandas_udf

        weights, kinds = self.weights, self.kinds

        @pandas_udf("double")
        def score(x):
            import pandas as pd

            out, there = np.full(len(x), np.nan), x.notna().to_numpy()
            if there.any():
                out[there] = 1 / (1 + np.exp(-np.clip(forward(weights, kinds, np.stack(x[there].to_list()))[-1][:, 0], -500, 500)))
            return pd.Series(out).where(there, None)

        return df.withColumn(name, score(F.when(F.col(features).isNotNull(), vector_to_array(features))))


def train_network(
    train: DataFrame, validation: DataFrame, width: int, layers: Sequence[int] = LAYERS, seed: int = 42, epochs: int = EPOCHS, step: float = STEP,
    decay: float = DECAY, batch: int = BATCH, patience: int = PATIENCE, plateau: int = PLATEAU, factor: float = FACTOR,
) -> Network:
    """Train on rows (features, label, weight) until the AUC of the validation rows has not risen for `patience` epochs.

    The step is multiplied by `factor` when the AUC has not risen for more than `plateau` epochs. The weights of the best
    epoch are kept. Both inputs are read once an epoch and have to be stored. Without validation rows of both classes all
    epochs are made and the last one is kept.
    """
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.functions import vector_to_array

    rows = train.select(vector_to_array("features").alias("x"), F.col(LABEL).cast("double").alias("y"), F.col("weight").cast("double").alias("w"))
    kinds = shapes(width, layers)
    weights = initial(width, layers, seed)
    state = State(weights, np.zeros_like(weights), np.zeros_like(weights), 0)
    judged = validation.select(LABEL).distinct().count() == 2
    judge = BinaryClassificationEvaluator(labelCol=LABEL, rawPredictionCol="probability", metricName="areaUnderROC", numBins=0)
    best, best_auc, waited, history, high, dull = state.weights, -math.inf, 0, [], -math.inf, 0
    best_epoch = 0
    for number in range(1, epochs + 1):
        state, n, lost = _epoch(rows, state, kinds, step, decay, batch)
        network = Network(state.weights, kinds, history, number)
        auc = judge.evaluate(network.probabilities(validation)) if judged else math.nan
        history.append((lost / n, auc, step))
        if not judged or auc > best_auc:
            best, best_auc, best_epoch, waited = state.weights, auc, number, 0
        else:
            waited += 1
            if waited >= patience:
                break
        # The plateau is counted by itself: gains below a ten-thousandth do not count there.
        high, dull = (auc, 0) if auc > high + abs(high) * GAIN or not math.isfinite(high) else (high, dull + 1)
        if dull > plateau:
            step, dull = step * factor, 0
    return Network(best, kinds, history, best_epoch)
