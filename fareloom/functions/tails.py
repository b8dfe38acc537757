"""Tail shares of the chi-squared and Student distributions as column expressions.

Each is a fixed number of terms of a series or a continued fraction, folded over a sequence of numbers, so
p-values are computed where the statistics are and no row goes to the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Terms of the series and fractions; enough for 1e-12 up to a few hundred thousand degrees of freedom.
TERMS = 1500


def lgamma(z: Column) -> Column:
    """Logarithm of the gamma function of a positive number: Stirling's series, eight places further up."""
    w = z + 8
    series = 1 / (12 * w) - 1 / (360 * w**3) + 1 / (1260 * w**5) - 1 / (1680 * w**7)
    steps = F.lit(0.0)
    for k in range(8):
        steps = steps + F.log(z + k)
    return (w - 0.5) * F.log(w) - w + 0.5 * math.log(2 * math.pi) + series - steps


def gamma_tail(a: Column, x: Column) -> Column:
    """Share of the gamma distribution of shape ``a`` above ``x``."""
    front = F.exp(a * F.log(x) - x - lgamma(a))
    # Below the mean the series of the lower part, above it the fraction of the upper one.
    zero = F.struct((1 / a).alias("term"), (1 / a).alias("sum"))

    def add(s: Column, n: Column) -> Column:
        term = s["term"] * x / (a + n)
        return F.struct(term.alias("term"), (s["sum"] + term).alias("sum"))

    lower = F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), zero, add, lambda s: s["sum"])
    inner = F.aggregate(F.sequence(F.lit(TERMS), F.lit(1), F.lit(-1)), F.lit(0.0), lambda s, n: n * (n - a) / (x + 2 * n + 1 - a - s))
    upper = front / (x + 1 - a - inner)
    return F.when(x <= 0, 1.0).when(x < a + 1, 1 - front * lower).otherwise(upper)


def _beta_fraction(a: Column, b: Column, x: Column) -> Column:
    front = F.exp(lgamma(a + b) - lgamma(a) - lgamma(b) + a * F.log(x) + b * F.log1p(-x)) / a

    def back(s: Column, m: Column) -> Column:
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        return even / (1 + odd / (1 + s))

    inner = F.aggregate(F.sequence(F.lit(TERMS), F.lit(1), F.lit(-1)), F.lit(0.0), back)
    return front / (1 - (a + b) * x / (a + 1) / (1 + inner))


def beta_share(a: Column, b: Column, x: Column) -> Column:
    """Share of the beta distribution below ``x``."""
    near = x <= (a + 1) / (a + b + 2)
    return F.when(x <= 0, 0.0).when(x >= 1, 1.0).when(near, _beta_fraction(a, b, x)).otherwise(1 - _beta_fraction(b, a, 1 - x))


def chi2_tail(statistic: Column, dof: Column) -> Column:
    """Chance of a statistic at least as large; null without a degree of freedom."""
    return F.when((dof > 0) & ~F.isnan(statistic), gamma_tail(dof.cast("double") / 2, statistic.cast("double") / 2))


def student_tail(t: Column, dof: Column) -> Column:
    """Chance of a statistic at least as far from zero, on either side; null if either is missing or not finite."""
    good = (dof > 0) & ~F.isnan(t) & (F.abs(t) < float("inf")) & (dof < float("inf"))
    t, dof = t.cast("double"), dof.cast("double")
    # 1 - dof / (dof + t^2) without the loss of digits where t is small
    far = t * t / (dof + t * t)
    below = F.when(far >= 1.5 / (dof / 2 + 2.5), _beta_fraction(dof / 2, F.lit(0.5), 1 - far)).otherwise(1 - _beta_fraction(F.lit(0.5), dof / 2, far))
    return F.when(good, F.when(t == 0, 1.0).otherwise(below))
