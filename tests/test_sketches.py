"""Baselines of bounded size: distances from quantile sketches lie within their stated error."""

import pytest
from pyspark.sql import functions as F

from ebbtide.operators import drift as D
from ebbtide.operators import profile as P
from ebbtide.plans import jobs
from test_curation import ts


def table(spark, n, shift=0.0, seed=1):
    return spark.range(n).select((F.randn(seed) + shift).alias("x"), F.floor(F.rand(seed + 1) * 5 + shift).cast("double").alias("atoms"), F.lit(None).cast("double").alias("none"))


@pytest.mark.parametrize("k, shift", [(200, 0.0), (200, 0.3), (1000, 0.05), (4096, 1.0)])
def test_distance_within_its_error(spark, k, shift):
    base, live = table(spark, 40_000), table(spark, 30_000, shift, 7)
    found = {r["feature"]: r for r in D.ks_of_sketches(P.value_sketches(base, ["x", "atoms"], k), P.value_sketches(live, ["x", "atoms"], k), k).collect()}
    exact = {r["feature"]: r for r in D.ks_two_sample(base, live, ["x", "atoms"]).collect()}
    assert found.keys() == exact.keys() == {"x", "atoms"}
    for feature, r in found.items():
        assert abs(r["statistic"] - exact[feature]["statistic"]) <= r["error"]
        assert (r["n_base"], r["n_live"]) == (40_000, 30_000)
        assert not r["certain"] or (r["drifted"] and exact[feature]["drifted"])


def test_size_does_not_depend_on_rows(spark):
    sizes = [P.value_sketches(table(spark, n), ["x"], 400).select(F.length("sketch")).first()[0] for n in (50_000, 500_000)]
    assert sizes[1] < 1.3 * sizes[0] < 40_000


def test_missing_values(spark):
    odd = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x double")
    assert [(r["feature"], r["n"]) for r in P.value_sketches(odd, ["x"]).collect()] == [("x", 1)]
    assert P.value_sketches(table(spark, 10), ["none"]).count() == 0 and P.value_sketches(odd, []).count() == 0


def test_job_with_a_sketched_baseline(spark, folder):
    base, live = table(spark, 4000), table(spark, 4000, 1.0, 9)
    for sketched in (False, True):
        path = f"{folder}/{sketched}"
        jobs.baseline(base, ["x"], path, "1", sketched=sketched)
        rows = [jobs.drift(other, ["x"], f"{path}/1", f"{folder}/s{sketched}", "dev", "daily", ts("2024-01-31"), []).first()["violation_count"] for other in (base, live)]
        assert rows[0] == 0 and rows[1] >= 1
