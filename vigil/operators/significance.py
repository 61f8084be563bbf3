"""Are a group's rate and the reference group's rate different?

The audit compares two samples of zeros and ones, of which only the counts are
needed: first whether their variances are equal (Levene's test around the
medians), then the means by a pooled t-test, or by Welch's where they are not.
Only the grouped table is read, a row per group.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.operators.fairness import DISPARITY_METRICS, RATES
from vigil.session import importable

ALPHA = 0.05
METRICS = tuple(m for m in RATES if m in DISPARITY_METRICS)


def _log_beta(a: float, b: float) -> float:
    """Logarithm of the beta function. Where one argument is a half and the other
    large, the difference of two nearly equal logarithms is a series instead."""
    a, b = max(a, b), min(a, b)
    if b == 0.5 and a > 100:
        u = 1 / a
        ratio = 1 - u / 8 + u ** 2 / 128 + 5 * u ** 3 / 1024 - 21 * u ** 4 / 32768      # gamma(a + 1/2) / (gamma(a) sqrt(a))
        return 0.5 * math.log(math.pi) - 0.5 * math.log(a) - math.log(ratio)
    return math.lgamma(a) + math.lgamma(b) - math.lgamma(a + b)


def incomplete_beta(a: float, b: float, x: float, y: float) -> float:
    """Regularised incomplete beta function at x = 1 - y, by its continued
    fraction; the smaller of x and y is the exact one."""
    if x <= 0 or y <= 0:
        return float(y <= 0)
    if x > (a + 1) / (a + b + 2):
        return 1 - incomplete_beta(b, a, y, x)
    log_x, log_y = (math.log(x) if x < y else math.log1p(-y)), (math.log(y) if y < x else math.log1p(-x))
    front = math.exp(a * log_x + b * log_y - _log_beta(a, b)) / a
    value = 1.0                                             # 1 + d1 / (1 + d2 / (1 + ...)) from the innermost term
    for i in range(_terms(a, b), 0, -1):
        m = i // 2
        d = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)) if i % 2 == 0 else -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        value = 1 + d / value
    return front / value


def _terms(a: float, b: float) -> int:
    """Terms after which the fraction doesn't change: it converges in about the
    square root of the larger parameter, and faster far from the mean."""
    return 200 + 10 * int(math.sqrt(min(max(a, b), 1e8)))


def t_two_sided(t: float, freedom: float) -> float:
    """Probability of a larger |t| under Student's distribution."""
    if math.isinf(t):
        return 0.0
    if freedom > 1e8:                                       # the normal distribution to within 1e-8
        return math.erfc(t / math.sqrt(2))
    return incomplete_beta(freedom / 2, 0.5, freedom / (freedom + t * t), t * t / (freedom + t * t))


def equal_variances(k: float, n: float, k0: float, n0: float, alpha: float = ALPHA) -> bool:
    """Levene's test around the medians, of k ones in n and k0 in n0."""
    def centred(ones: float, size: float) -> float:
        """Mean of |x - median|: all a half if the median is a half."""
        return 0.5 if 2 * ones == size else min(ones, size - ones) / size
    z, z0 = centred(k, n), centred(k0, n0)
    both = (n * z + n0 * z0) / (n + n0)
    between = n * (z - both) ** 2 + n0 * (z0 - both) ** 2
    within = sum(size * m * (1 - m) if 2 * ones != size else 0.0 for ones, size, m in ((k, n, z), (k0, n0, z0)))
    if within == 0:
        return between < 1e-24
    return t_two_sided(math.sqrt((n + n0 - 2) * between / within), n + n0 - 2) >= alpha


def p_value(k: float, n: float, k0: float, n0: float, alpha: float = ALPHA) -> float:
    """Two-sided p of the t-test between k ones of n and k0 of n0; NaN where it
    is undefined (an empty sample, one row in all, no variance and equal means)."""
    if not n or not n0 or n + n0 < 3 or any(math.isnan(v) for v in (k, n, k0, n0)):
        return math.nan
    mean, mean0 = k / n, k0 / n0
    square, square0 = n * mean * (1 - mean), n0 * mean0 * (1 - mean0)
    if equal_variances(k, n, k0, n0, alpha):
        freedom = n + n0 - 2
        error = (square + square0) / freedom * (1 / n + 1 / n0)
    else:
        if n < 2 or n0 < 2:
            return math.nan
        own, other = square / (n - 1) / n, square0 / (n0 - 1) / n0
        error = own + other
        if error == 0:
            return 0.0 if mean != mean0 else math.nan
        freedom = error ** 2 / (own ** 2 / (n - 1) + other ** 2 / (n0 - 1))
    if error <= 0:
        return 0.0 if mean != mean0 else math.nan
    return t_two_sided(abs(mean - mean0) / math.sqrt(error), freedom)


def _p_values(k: pd.Series, n: pd.Series, k0: pd.Series, n0: pd.Series) -> pd.Series:
    rows = zip(*(s.astype("float64").tolist() for s in (k, n, k0, n0)), strict=True)
    return pd.Series(np.array([p_value(*r) for r in rows], dtype="float64"))


def with_significance(disparities: DataFrame, alpha: float = ALPHA, mask: bool = True) -> DataFrame:
    """``<metric>_significance`` for every rate that is a share of counts: with
    ``mask`` whether p < ``alpha`` (false where p is undefined), without it p
    itself. ``disparities`` has the counts and the reference's (``ref_``)."""
    importable(disparities.sparkSession)
    test = F.pandas_udf(_p_values, "double")
    out = disparities
    for m in METRICS:
        num, den = RATES[m]
        # both counts as doubles, so that an absent reference is NaN
        p = test(*[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in (num, den, f"ref_{num}", f"ref_{den}")])
        p = F.when(~F.isnan(p), p)
        out = out.withColumn(f"{m}_significance", F.coalesce(p < alpha, F.lit(False)) if mask else p)
    return out

