"""Special functions as columns, for p-values and critical values at any level."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

# Coefficients of Stirling's series for the logarithm of the gamma function: B(2k) / (2k (2k - 1)).
STIRLING = [1 / 12, -1 / 360, 1 / 1260, -1 / 1680, 1 / 1188, -691 / 360360, 1 / 156]

# Smallest magnitude a denominator of the continued fraction may take.
TINY = 1e-300


def _let(value: Column, body) -> Column:
    """`body` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def log_gamma(a: Column) -> Column:
    """log of the gamma function for a > 0: moved up by eight, then Stirling's series."""
    up = a + 8.0
    shift = F.lit(0.0)
    for i in range(8):
        shift = shift + F.log(a + float(i))
    series = F.lit(0.0)
    for k, c in reversed(list(enumerate(STIRLING))):
        series = (series / (up * up)) + c if k < len(STIRLING) - 1 else F.lit(c)
    return (up - 0.5) * F.log(up) - up + 0.5 * math.log(2 * math.pi) + series / up - shift


def _terms(a: Column) -> Column:
    """How many terms leave nothing above the last bit: both expansions settle within a few times the root of a."""
    return F.sequence(F.lit(1), (F.lit(100) + F.ceil(12.0 * F.sqrt(a))).cast("int"))


def gamma_q(a: Column, x: Column) -> Column:
    """Regularised upper incomplete gamma function Q(a, x) for a > 0; NULL for other a or x, 1 at x <= 0.

    A power series below a + 1, a continued fraction (by Lentz's rule) above.
    """

    def of(v: Column) -> Column:
        a, x = v["a"], v["x"]
        front = F.exp(a * F.log(x) - x - log_gamma(a))
        series = F.aggregate(
            _terms(a), F.struct((1.0 / a).alias("t"), (1.0 / a).alias("s")),
            lambda s, n: _let(s["t"] * x / (a + n), lambda t: F.struct(t.alias("t"), (s["s"] + t).alias("s"))), lambda s: s["s"],
        )

        def safe(v: Column) -> Column:
            return F.when(F.abs(v) < TINY, F.lit(TINY)).otherwise(v)

        def step(s: Column, n: Column) -> Column:
            n = n.cast("double")
            an, b = n * (a - n), x + 2.0 * n + 1.0 - a
            return _let(
                F.struct((1.0 / safe(an * s["d"] + b)).alias("d"), safe(b + an / s["c"]).alias("c")),
                lambda t: F.struct(t["c"].alias("c"), t["d"].alias("d"), (s["h"] * t["c"] * t["d"]).alias("h")),
            )

        first = 1.0 / safe(x + 1.0 - a)
        fraction = F.aggregate(_terms(a), F.struct(F.lit(1 / TINY).alias("c"), first.alias("d"), first.alias("h")), step, lambda s: s["h"])
        q = F.when(x < a + 1.0, 1.0 - front * series).otherwise(front * fraction)
        return F.when(x <= 0, F.lit(1.0)).otherwise(F.least(F.greatest(q, F.lit(0.0)), F.lit(1.0)))

    given = F.struct(a.cast("double").alias("a"), x.cast("double").alias("x"))
    return F.when((a > 0) & x.isNotNull(), _let(given, of))


def chi_squared_p_value(statistic: Column, degrees: Column) -> Column:
    """Probability of a statistic at least as large under the chi-squared distribution; NULL without degrees of freedom."""
    return gamma_q(degrees / 2.0, statistic / 2.0)


def chi_squared_critical(degrees: Column, alpha: float) -> Column:
    """The value that is exceeded with probability `alpha`, for any level between 0 and 1, by bisection.

    A chi-squared value exceeds d + 2 sqrt(d l) + 2 l with a probability of at most exp(-l), which bounds the search.
    """
    if not 0 < alpha < 1:
        raise ValueError("the level has to lie between 0 and 1")
    least = -math.log(alpha)

    def of(d: Column) -> Column:
        def halve(s: Column, _: Column) -> Column:
            def pick(m: Column) -> Column:
                above = chi_squared_p_value(m, d) > alpha
                return F.struct(F.when(above, m).otherwise(s["lo"]).alias("lo"), F.when(above, s["hi"]).otherwise(m).alias("hi"))

            return _let((s["lo"] + s["hi"]) / 2.0, pick)

        widest = d + 2.0 * F.sqrt(d * least) + 2.0 * least
        return F.aggregate(F.sequence(F.lit(1), F.lit(64)), F.struct(F.lit(0.0).alias("lo"), widest.alias("hi")), halve, lambda s: (s["lo"] + s["hi"]) / 2.0)

    return F.when(degrees > 0, _let(degrees.cast("double"), of))
