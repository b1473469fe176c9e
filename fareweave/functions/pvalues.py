"""p-values of the two-sample tests, evaluated on one row per feature."""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

# Ship these helpers with the UDF, so that executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

STEPS = 100_000


def normal_two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2.0))


def gamma_tail(a: float, x: float) -> float:
    """The regularised upper incomplete gamma function, in a bounded number of steps.

    Below a + 1 the series of the lower function, above it the continued fraction of the
    upper one. Where ``a`` is so large that neither has settled after ``STEPS`` steps, the
    cube root of a gamma variable is as good as normal.
    """
    if x <= 0:
        return 1.0
    scale = math.exp(a * math.log(x) - x - math.lgamma(a)) if a < 1e12 else 0.0
    if x < a + 1:
        term = total = 1.0 / a
        for k in range(1, STEPS):
            term *= x / (a + k)
            total += term
            if term < total * 1e-16:
                return min(1.0, max(0.0, 1.0 - total * scale))
    else:
        b = x + 1.0 - a
        c, d = 1e300, 1.0 / b
        fraction = d
        for k in range(1, STEPS):
            step = -k * (k - a)
            b += 2.0
            d = 1.0 / (step * d + b or 1e-300)
            c = b + step / c or 1e-300
            fraction *= c * d
            if abs(c * d - 1.0) < 1e-15:
                return min(1.0, max(0.0, fraction * scale))
    z = ((x / a) ** (1 / 3) - (1 - 1 / (9 * a))) * 3 * math.sqrt(a)
    return 0.5 * math.erfc(z / math.sqrt(2.0))


def chi_square_tail(x: float, df: int) -> float:
    """P(X >= x) for a chi-square variable with a whole number of degrees of freedom."""
    if df <= 0 or x <= 0:
        return 1.0
    if math.isinf(x):
        return 0.0
    return gamma_tail(df / 2.0, x / 2.0)


def kolmogorov_tail(lam: float) -> float:
    """Limiting distribution of the scaled Kolmogorov-Smirnov distance."""
    if lam < 0.2:
        return 1.0
    k = np.arange(1, 101)
    return float(np.clip(2.0 * np.sum((-1.0) ** (k - 1) * np.exp(-2.0 * (k * lam) ** 2)), 0.0, 1.0))


def exact_ks_tail(ties: list[int], n: int, m: int, distance: float) -> float:
    """The share of all ways to deal the pooled values to samples of n and m that lie at least ``distance`` apart.

    ``ties`` are the sizes of the groups of equal values, in order. A deal is a path of n steps
    right and m steps up; it counts as near if at the end of every group its shares differ by
    less. The chance of a near path is carried from value to value: n + m steps of up to n + 1 numbers.
    """
    if n == 0 or m == 0:
        return 1.0
    total = n + m
    least = round(distance * n * m)
    if least <= 0:
        return 1.0
    near = np.zeros(n + 1)
    near[0] = 1.0
    right = np.arange(n + 1)
    seen = 0
    for size in ties:
        for _ in range(size):
            # The next value goes to the first sample with the chance of its places that are left.
            go = near * ((n - right) / (total - seen))
            near = near - go
            near[1:] += go[:-1]
            seen += 1
        up = seen - right
        near[np.abs(right * m - up * n) >= least] = 0.0
    return float(min(1.0, max(0.0, 1.0 - near.sum())))


def p_value(test: str, statistic: float, n: int, m: int, distinct: int) -> float | None:
    if statistic is None or math.isnan(statistic):
        return None
    if test == "z":
        return normal_two_sided(statistic)
    if test == "chi_square":
        return chi_square_tail(statistic, int(distinct) - 1)
    if test == "ks":
        return kolmogorov_tail(math.sqrt(n / (n + m) * m) * statistic)
    return None


@F.pandas_udf(DoubleType())
def p_values(
    test: pd.Series, statistic: pd.Series, n: pd.Series, m: pd.Series, distinct: pd.Series
) -> pd.Series:
    rows = zip(test, statistic, n, m, distinct)
    return pd.Series([p_value(*r) for r in rows], dtype="float64")


@F.pandas_udf(DoubleType())
def exact_ks_p_values(ties: pd.Series, n: pd.Series, m: pd.Series, statistic: pd.Series) -> pd.Series:
    rows = zip(ties, n, m, statistic)
    found = [
        None if t is None or s is None or math.isnan(s) else exact_ks_tail([int(v) for v in t], int(a), int(b), s)
        for t, a, b, s in rows
    ]
    return pd.Series(found, dtype="float64")
