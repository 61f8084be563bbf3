"""Statistics expressions with the sample corrections the profile needs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sample_skewness(c) -> Column:
    """Adjusted Fisher-Pearson skewness G1 = g1 * sqrt(n(n-1)) / (n-2).

    Spark's ``skewness`` is the population g1; both come from the same
    partial-aggregation moments, so this stays a single pass. Null for n < 3.
    """
    n = F.count(_col(c)).cast("double")
    g1 = F.skewness(_col(c))
    return F.when(n >= 3, g1 * F.sqrt(n * (n - 1)) / (n - 2))


def sample_kurtosis(c) -> Column:
    """Bias-corrected excess kurtosis G2 = (n-1)/((n-2)(n-3)) * ((n+1) g2 + 6).

    Spark's ``kurtosis`` is the population excess g2. Null for n < 4.
    """
    n = F.count(_col(c)).cast("double")
    g2 = F.kurtosis(_col(c))
    return F.when(n >= 4, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6))


def safe_ratio(num, den) -> Column:
    """num / den, null when den is 0 or null (ANSI-safe)."""
    return F.try_divide(_col(num).cast("double"), F.nullif(_col(den).cast("double"), F.lit(0.0)))
