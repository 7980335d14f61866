import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbtide.llm import hard_negatives as hn
from ebbtide.llm import queries

SCHEMA = "vec_id long, embedding array<float>, label int, score long, id string"


def brute(rows, positives=5, negatives=10, anchor=lambda k: k is not None and k % 100 == 0):
    fine = []
    for key, vector, label in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        if key is not None and key % 7 == 0:
            label = (label + 1) % 10
        fine.append((key, [math.floor(256 * float(np.float32(x))) for x in vector], label))
    order = lambda x: (-x[0], x[1] is None, x[1] or 0)
    out = []
    for i, (key, vector, label) in enumerate(fine):
        if not anchor(key):
            continue
        scored = [(sum(a * b for a, b in zip(vector, v)), k, lab, j) for j, (k, v, lab) in enumerate(fine)]
        for ps, pk, *_ in sorted((x for x in scored if x[2] == label and x[3] != i), key=order)[:positives]:
            fit = sorted((x for x in scored if x[2] != label and 30 * ps <= 100 * x[0] <= 90 * ps), key=order)[:negatives]
            out += [(key, pk, rank, x[1], ps, x[0]) for rank, x in enumerate(fit, 1)]
    return sorted(out, key=repr)


def mined(spark, rows, **options):
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return sorted(map(tuple, hn.hard_negatives(frame, label=label, **options).collect()), key=repr)


def vectors(n, dims, seed, labels=4):
    rnd = random.Random(seed)
    centre = [[rnd.gauss(0, 1) for _ in range(dims)] for _ in range(labels)]
    rows = []
    for k in range(n):
        c = rnd.randrange(labels)
        rows.append((k, [0.2 * (0.3 * x + rnd.gauss(0.4, 0.6)) for x in centre[c]], c))
    return rows


@pytest.mark.parametrize("dims", [1, 8, 19])
def test_against_brute_force(spark, monkeypatch, dims):
    for name, value in (("ANCHORS", 3), ("CANDIDATES", 100), ("ROWS_AT_ONCE", 7), ("ANCHORS_AT_ONCE", 2)):
        monkeypatch.setattr(hn, name, value)
    rows = vectors(500, dims, dims)
    assert mined(spark, rows) == brute(rows)


def test_scores_are_inner_products():
    rnd = np.random.default_rng(1)
    for largest in (1, 200, 70_000):
        rows, anchors = rnd.integers(-largest, largest + 1, (50, 24)), rnd.integers(-largest, largest + 1, (9, 24))
        bits = largest.bit_length() + 1
        planes = np.stack([np.packbits((rows >> j & 1).astype(np.uint8), axis=1, bitorder="little") for j in range(bits)], 1)
        assert (hn.scores(hn.subset_sums(anchors), planes) == rows @ anchors.T).all()


def test_awkward_rows(spark):
    rows = vectors(120, 5, 3)
    rows += [(200, None, 1), (300, [0.5] * 5, None), (400, [0.5, None, 0.1, 0.2, 0.3], 2), (500, [float("nan")] * 5, 1), (600, [float("inf")] * 5, 1)]
    rows += [(700, [], 1), (701, [0.4], 2), (None, [0.5, 0.4, 0.3, 0.2, 0.1], 3), (None, [0.5, 0.4, 0.3, 0.2, 0.1], 3)]
    rows += [(800, [0.3, 0.3, 0.3, 0.3, 0.3], 1)] * 3 + [(801, [0.3, 0.3, 0.3, 0.3, 0.3], 2)] * 15
    assert mined(spark, rows) == brute(rows)
    assert mined(spark, []) == [] and mined(spark, [(1, [0.5], 1)]) == [] and mined(spark, [(100, [0.5], 1)]) == []


def test_half_of_the_rows_are_one_vector(spark, monkeypatch):
    monkeypatch.setattr(hn, "CANDIDATES", 64)
    rows = vectors(200, 6, 9) + [(1000 + i, [0.25] * 6, i % 3) for i in range(300)]
    assert mined(spark, rows, positives=3, negatives=4) == brute(rows, 3, 4)


def test_scores_that_may_not_fit_are_refused(spark):
    with pytest.raises(ValueError):
        mined(spark, [(0, [1e9] * 4, 1)])


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert sorted(map(tuple, queries.op11_hard_negatives(spark, sf).collect()), key=repr) == brute(rows)
