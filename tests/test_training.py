"""Training: stop after rounds without gain, search by halving, the network against a plain version."""

import math
import random

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from ebbtide.constants import LABEL
from ebbtide.operators import boosting as G
from ebbtide.operators import network as N
from ebbtide.operators import train as T
from ebbtide.session import cut_lineage


@pytest.mark.parametrize("losses, patience, want", [
    ([5, 4, 3], 2, (3, False)), ([5, 4, 4.5, 4.4, 3.9, 4, 4], 3, (5, False)), ([5, 4, 4.5, 4.4, 3.9, 4, 4], 2, (2, True)),
    ([5, 4, 4, 4, 4], 3, (2, True)), ([1], 1, (1, False)), ([3, 2, 2.5, 2.4, 2.3, 1], 4, (6, False)),
])
def test_best_prefix(losses, patience, want):
    assert G.best_prefix(losses, patience) == want


def planted(spark, n, noise=0.0, seed=1, width=3):
    """Class 1 where the first input is above the second; the last input says nothing."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        x = [rnd.gauss(0, 1) for _ in range(width)]
        y = int(x[0] > x[1]) if rnd.random() >= noise else rnd.randint(0, 1)
        rows.append((Vectors.dense(x), y, "validation" if i % 4 == 0 else "train"))
    return cut_lineage(spark.createDataFrame(rows, ["features", LABEL, "split"]), "planted")


def test_later_trees_are_kept_when_the_loss_falls_again(spark):
    """With noise and small samples the loss goes up and down; waiting finds a lower one than stopping at the first rise."""
    rows = T.boosted_rows(planted(spark, 500, 0.3))
    params = {"maxDepth": 3, "stepSize": 0.1, "subsamplingRate": 0.3, "maxIter": 24}
    for seed in range(1, 9):  # how a sample falls depends on the order of stored rows
        fitted = T.fit_boosted(rows, patience=8, seed=seed, **params)
        first_rise = next(i for i in range(1, len(fitted.losses)) if fitted.losses[i] >= fitted.losses[i - 1])
        if fitted.trees > first_rise:
            break
    assert fitted.trees > first_rise and min(fitted.losses) < fitted.losses[first_rise - 1]
    assert fitted.trees == G.best_prefix(fitted.losses, 8)[0]
    # The kept model is that prefix.
    validation = rows.where("split = 'validation'")
    assert fitted.model.evaluateEachIteration(validation) == pytest.approx(fitted.losses[: fitted.trees], abs=1e-9)
    kept = G.report(spark, fitted).groupBy("kept").count().collect()
    assert sum(r["count"] for r in kept) == len(fitted.losses) and {r["kept"]: r["count"] for r in kept}[True] == fitted.trees


def test_without_validation_rows_all_trees_are_kept(spark):
    rows = T.boosted_rows(planted(spark, 80)).where("split = 'train'")
    assert T.fit_boosted(rows, maxIter=3, maxDepth=2).trees == 3


def test_search_by_halving_finds_the_winner(spark):
    inputs = planted(spark, 400)
    trials = [{"maxDepth": 1, "stepSize": 0.01}, {"maxDepth": 4, "stepSize": 0.3}, {"maxDepth": 1, "stepSize": 0.02}]
    model, trial, auc = T.search(inputs, [{**t, "maxIter": 24} for t in trials], first_trees=6)
    assert trial["maxDepth"] == 4 and auc > 0.95 and model.getNumTrees <= 24


def test_search_goes_on_from_the_winners_last_ensemble(spark, monkeypatch):
    """The winner's trees of the last round are its first slice: no ensemble is fitted twice, and the model is that of a full fit."""
    fits, fit_trees = [], G.fit_trees
    for module in (G, T):
        monkeypatch.setattr(module, "fit_trees", lambda train, trees, seed, **p: fits.append((p["maxDepth"], trees)) or fit_trees(train, trees, seed, **p))
    inputs = planted(spark, 300)
    trials = [{"maxDepth": 1, "stepSize": 0.01, "maxIter": 24}, {"maxDepth": 3, "stepSize": 0.3, "maxIter": 24}]
    model, trial, _ = T.search(inputs, trials, first_trees=6)
    assert trial["maxDepth"] == 3 and len(set(fits)) == len(fits) and fits.count((3, 6)) == 1
    assert [n for depth, n in fits if depth == 3][:2] == [6, 24]
    whole = T.fit_boosted(T.boosted_rows(inputs), **trial).model
    assert model.getNumTrees == whole.getNumTrees


def test_slices_do_not_change_what_is_kept(spark, monkeypatch):
    rows = T.boosted_rows(planted(spark, 400, 0.4))
    kept = []
    for growth in (2, 4):
        monkeypatch.setattr(G, "GROWTH", growth)
        kept.append(T.fit_boosted(rows, patience=3, maxDepth=2, stepSize=0.1, maxIter=30).model)
    assert kept[0].getNumTrees == kept[1].getNumTrees and kept[0].toDebugString.split("\n", 1)[1] == kept[1].toDebugString.split("\n", 1)[1]


def test_gradient_by_differences():
    rng = np.random.default_rng(0)
    kinds = N.shapes(4, (5, 3))
    v = N.initial(4, (5, 3), 1) + 0.01
    x, y, w = rng.normal(size=(20, 4)), rng.integers(0, 2, 20).astype(float), rng.uniform(0.5, 3, 20)
    grad, _ = N.gradient(v, kinds, x, y, w)
    for i in rng.choice(len(v), 25, replace=False):
        up, down = v.copy(), v.copy()
        up[i] += 1e-6
        down[i] -= 1e-6
        assert grad[i] == pytest.approx((N.gradient(up, kinds, x, y, w)[1] - N.gradient(down, kinds, x, y, w)[1]) / 2e-6, abs=1e-5)


@pytest.mark.parametrize("parts", [1, 3, 5])
def test_epoch_against_a_plain_version(spark, parts):
    """The same steps written out: every partition by itself, then the mean weighted by rows."""
    kinds = N.shapes(2, (4,))
    rows = spark.range(0, 200, 1, parts).select(
        F.array(F.sin("id"), F.cos("id")).alias("x"), (F.col("id") % 3 == 0).cast("double").alias("y"), (1 + F.col("id") % 2).cast("double").alias("w"))
    state = N.State(N.initial(2, (4,), 0), *[np.zeros(sum(a * b + b for a, b in kinds))] * 2, 7)
    got, n, lost = N._epoch(rows, state, kinds, 0.01, 1e-3, 16)
    found = []
    for part in range(parts):
        ids = np.arange(200 * part // parts, 200 * (part + 1) // parts)
        s, total = state, 0.0
        for at in range(0, len(ids), 16):
            i = ids[at : at + 16]
            grad, loss = N.gradient(s.weights, kinds, np.stack([np.sin(i), np.cos(i)], 1), (i % 3 == 0).astype(float), 1.0 + i % 2)
            m, v, t = 0.9 * s.first + 0.1 * grad, 0.999 * s.second + 0.001 * grad**2, s.steps + 1
            move = m / (1 - 0.9**t) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
            s, total = N.State(s.weights - 0.01 * (move + 1e-3 * s.weights), m, v, t), total + loss * len(i)
        found.append((s, len(ids), total))
    assert n == 200 and lost == pytest.approx(sum(x[2] for x in found))
    for k in range(3):
        assert np.allclose(got[k], sum(s[k] * len_ / 200 for s, len_, _ in found), atol=1e-12)
    assert got.steps == max(s.steps for s, _, _ in found)


def test_network_learns_stops_and_lowers_its_step(spark):
    rows = T.boosted_rows(planted(spark, 1200, 0.1))
    train, validation = (rows.where(F.col("split") == s).repartition(2, "split").drop("split") for s in ("train", "validation"))
    train, validation = cut_lineage(train, "train"), cut_lineage(validation, "validation")
    net = N.train_network(train, validation, 3, (16, 8), step=0.02, batch=64, epochs=40, patience=6, plateau=2)
    aucs = [auc for _, auc, _ in net.history]
    assert max(aucs) > 0.85 and aucs[net.best_epoch - 1] == max(aucs)
    assert len(net.history) < 40 and len(net.history) == net.best_epoch + 6
    assert net.history[-1][2] < 0.02
    p = net.probabilities(validation.unionByName(validation.limit(1).withColumn("features", F.lit(None).cast(validation.schema["features"].dataType))))
    assert p.where("probability IS NULL").count() == 1 and p.where("probability NOT BETWEEN 0 AND 1").count() == 0


def test_network_without_a_judgement(spark):
    rows = T.boosted_rows(planted(spark, 60)).where("split = 'train'").drop("split")
    net = N.train_network(rows, rows.limit(0), 3, (4,), epochs=3)
    assert len(net.history) == 3 and net.best_epoch == 3 and all(math.isnan(a) for _, a, _ in net.history)


def test_rows_of_one_file_are_trained_by_several_tasks(spark):
    """Few bytes made one file and one task, whatever the cores; a small table stays in one part."""
    for n, parts in ((4 * 2048, 4), (100, 1)):
        rows = cut_lineage(spark.range(n).coalesce(1).select(
            array_to_vector(F.array(F.col("id").cast("double"))).alias("features"), (F.col("id") % 2).cast("int").alias(LABEL), F.lit("train").alias("split")), "one")
        held = T.boosted_rows(rows).groupBy(F.spark_partition_id()).count().collect()
        assert len(held) == parts and sum(r["count"] for r in held) == n and max(r["count"] for r in held) <= n / parts + 8
