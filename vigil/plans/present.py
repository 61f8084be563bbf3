"""Presentation rounding for compared outputs: nine significant digits, so
results of floating-point sums taken in different orders agree."""

from __future__ import annotations

from pyspark.sql import functions as F

SIG_DIGITS = 9


def sig_round(c, digits: int = SIG_DIGITS):
    x = F.col(c) if isinstance(c, str) else c
    unit = F.pow(F.lit(10.0), F.ceil(F.log10(F.abs(x))))
    return F.when(x.isNull() | (x == 0) | F.isnan(x), x).otherwise(F.round(x / unit, digits) * unit)


def round_cols(df, cols, digits: int = SIG_DIGITS):
    return df.select(*[sig_round(c, digits).alias(c) if c in cols else F.col(c) for c in df.columns])


def sround(expr: str, digits: int = SIG_DIGITS) -> str:
    """SQL twin of ``sig_round``."""
    return (f"(CASE WHEN ({expr}) IS NULL OR ({expr}) = 0 OR isnan({expr}) THEN ({expr}) "
            f"ELSE round(({expr}) / pow(10.0, ceil(log10(abs({expr})))), {digits})"
            f" * pow(10.0, ceil(log10(abs({expr})))) END)")


# A standard deviation below this share of the mean's magnitude is floating
# noise of the moment merge order (a constant column): reported as 0.
NOISE = 1e-12


def zero_noise(df, col, ref):
    x, m = F.col(col), F.col(ref)
    return df.withColumn(col, F.when(x < F.lit(NOISE) * F.greatest(F.abs(m), F.lit(1.0)), F.lit(0.0))
                               .otherwise(x))


def sstd(std_expr: str, mean_expr: str) -> str:
    """SQL twin of ``zero_noise`` followed by ``sround``."""
    return (f"(CASE WHEN ({std_expr}) < {NOISE} * greatest(abs({mean_expr}), 1.0) THEN 0.0 "
            f"ELSE {sround(std_expr)} END)")
