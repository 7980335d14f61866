import math
import random

import pytest
from pyspark.sql import functions as F

from ebbtide.functions.special import chi_squared_critical, chi_squared_p_value, gamma_q, log_gamma


def closed_q(a2, x):
    """Q(a2 / 2, x) for whole a2 from the closed forms at 1/2 and 1 and the step from a to a + 1."""
    if a2 % 2:
        a, q = 0.5, math.erfc(math.sqrt(x))
    else:
        a, q = 1.0, math.exp(-x)
    while 2 * a < a2:
        q += math.exp(a * math.log(x) - x - math.lgamma(a + 1))
        a += 1
    return q


def test_against_closed_forms(spark):
    rnd = random.Random(0)
    cases = [(n, x) for n in (1, 2, 3, 4, 7, 10, 31, 100, 501, 2000) for x in (1e-6, 0.1, n / 4, n / 2, n / 2 + 1, n / 2 + 2, n, 3.0 * n + 5)]
    cases += [(rnd.randint(1, 300), rnd.uniform(0.01, 300)) for _ in range(200)]
    cases = [(n, float(x)) for n, x in cases]
    rows = spark.createDataFrame(cases, "n int, x double").select("n", "x", gamma_q(F.col("n") / 2.0, F.col("x")).alias("q"), log_gamma(F.col("n") / 2.0).alias("g")).collect()
    for r in rows:
        want = closed_q(r.n, r.x)
        assert abs(r.q - want) < 1e-9 and (want < 1e-250 or want > 0.5 or abs(r.q / want - 1) < 1e-8), (r, want)
        assert abs(r.g - math.lgamma(r.n / 2)) <= 1e-12 * max(1, abs(r.g))


def test_known_critical_values(spark):
    # Quantiles of the chi-squared distribution as printed in tables.
    known = [(1, 0.05, 3.841458820694124), (1, 0.001, 10.827566170662733), (2, 0.05, 5.991464547107979), (5, 0.10, 9.236356899781123), (10, 0.01, 23.209251158954356), (100, 0.05, 124.34211340400407)]
    for n, alpha, want in known:
        assert spark.range(1).select(chi_squared_critical(F.lit(n), alpha)).first()[0] == pytest.approx(want, rel=1e-9)


@pytest.mark.parametrize("alpha", [0.5, 0.2, 0.037, 1e-6, 1e-12])
def test_any_level(spark, alpha):
    rows = spark.createDataFrame([(1,), (2,), (13,), (400,)], "n int").select("n", chi_squared_critical(F.col("n"), alpha).alias("x"))
    for r in rows.select("n", chi_squared_p_value(F.col("x"), F.col("n")).alias("p")).collect():
        assert r.p == pytest.approx(alpha, rel=1e-7)
    with pytest.raises(ValueError):
        chi_squared_critical(F.lit(1), 0)


def test_values_at_the_edges(spark):
    rows = spark.createDataFrame([(0, 1.0), (1, 0.0), (1, -1.0), (1, None), (None, 1.0), (1, 5000.0)], "n int, x double")
    assert [r[0] for r in rows.select(chi_squared_p_value(F.col("x"), F.col("n"))).collect()] == [None, 1.0, 1.0, None, None, 0.0]


@pytest.mark.parametrize("degrees, statistic", [(1502, 13556.826409041782), (9002, 81329.59020354219), (9002, 9200.0), (90002, 90500.0)])
def test_many_degrees(spark, degrees, statistic):
    """The whole series, from below its largest terms to far above them; one of 2,000 terms gives 1 for the first two."""
    a, x = degrees / 2, statistic / 2
    below = math.fsum(math.exp((a + n) * math.log(x) - x - math.lgamma(a + n + 1)) for n in range(60_000))
    got = spark.createDataFrame([(statistic, degrees)], "s double, d int").select(chi_squared_p_value(F.col("s"), F.col("d"))).first()[0]
    assert got == pytest.approx(1 - below, abs=1e-6)
