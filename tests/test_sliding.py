"""Quantiles of overlapping windows: within the stated error of the value of that rank."""

import datetime as dt
import math
import random

import pytest

from ebbtide.operators import service as H


@pytest.mark.parametrize("error", [0.01, 0.05])
def test_within_the_error(spark, error):
    rnd = random.Random(3)
    start = dt.datetime(2024, 1, 1)
    rows = [("p" if rnd.random() < 0.7 else "q", start + dt.timedelta(seconds=rnd.randint(0, 1200)), rnd.lognormvariate(4, 1.5)) for _ in range(4000)]
    rows += [("p", start, 0.0), ("p", start, -3.0), ("p", start, None), ("p", start, float("nan")), ("z", start, 0.0)]
    log = spark.createDataFrame(rows, "env string, ts timestamp, latency_ms double")
    probabilities = {"p0": 0.0, "p50": 0.5, "p99": 0.99, "p100": 1.0}
    found = {(r["env"], r["ts"]): r for r in H.sliding_quantiles(log, probabilities, error=error).collect()}
    windows: dict = {}
    for env, ts, x in rows:
        if x is not None and not math.isnan(x):
            end = start + dt.timedelta(seconds=((ts - start).seconds // 30 + 1) * 30)
            for i in range(10):
                windows.setdefault((env, end + dt.timedelta(seconds=30 * i)), []).append(max(x, 0.0))
    assert found.keys() == windows.keys()
    for key, values in windows.items():
        values.sort()
        assert found[key]["n"] == len(values)
        for name, p in probabilities.items():
            exact = values[math.floor(p * (len(values) - 1))]
            assert abs(found[key][name] - exact) <= error * exact * (1 + 1e-9)


def test_nothing_to_rank(spark):
    log = spark.createDataFrame([("p", dt.datetime(2024, 1, 1), None)], "env string, ts timestamp, latency_ms double")
    assert H.sliding_quantiles(log, {"p50": 0.5}).count() == 0
