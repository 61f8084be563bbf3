"""Profiles that grow by the month: mergeable sketches instead of a new scan.

Each month's rows become one row of sketches per column (KLL for quantiles, HLL
for distinct counts, counts and sums for the rest); the profile of any period
merges those rows. A month that arrives again replaces its own row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Sizes of the sketches, whatever the rows.
KLL_K = 400
HLL_LG_K = 14


def rank_error(k: int = KLL_K) -> float:
    """Bound of the normalised rank error of a quantile at 99 % confidence
    (2.446 / k ** 0.9433, published with the sketch)."""
    return 2.446 / k ** 0.9433


def monthly(df: DataFrame, month: str, numeric: Sequence[str], text: Sequence[str] = ()) -> DataFrame:
    """(month, variable, rows, n, low, high, mean, m2, kll, hll): a row per
    month and column; NaN is missing. One aggregation with partial sketches in
    every task, whose size does not depend on the rows."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    for c in numeric:
        x = F.col(c).cast("double")
        x = F.when(~F.isnan(x), x)
        aggs += [F.count(x).alias(f"{c}__n"), F.min(x).alias(f"{c}__low"), F.max(x).alias(f"{c}__high"), F.avg(x).alias(f"{c}__mean"),
                 (F.var_pop(x) * F.count(x)).alias(f"{c}__m2"), F.kll_sketch_agg_double(x, KLL_K).alias(f"{c}__kll"),
                 F.hll_sketch_agg(F.when(x.isNotNull(), x.cast("string")), HLL_LG_K).alias(f"{c}__hll")]
    for c in text:
        aggs += [F.count(c).alias(f"{c}__n"), F.hll_sketch_agg(F.col(c), HLL_LG_K).alias(f"{c}__hll")]
    wide = df.groupBy(month).agg(*aggs)
    of = lambda c, s, t: (F.col(f"{c}__{s}") if c in numeric or s in ("n", "hll") else F.lit(None)).cast(t).alias(s)
    rows = [F.struct(F.lit(c).alias("variable"), of(c, "n", "bigint"), *[of(c, s, "double") for s in ("low", "high", "mean", "m2")],
                     of(c, "kll", "binary"), of(c, "hll", "binary")) for c in (*numeric, *text)]
    return wide.select(month, "rows", F.inline(F.array(*rows)))


def profile(sketches: DataFrame, probs: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """(variable, rows, count, missings, min, max, mean, std, uniques, q...) of all
    months in ``sketches``: exact but for ``uniques`` (HLL) and the quantiles (KLL).
    Reads a row per month and column."""
    every = Window.partitionBy("variable")                 # a row per month
    mean = F.sum(F.col("mean") * F.col("n")).over(every) / F.nullif(F.sum("n").over(every), F.lit(0))
    rows = sketches.withColumn("_mean", mean).withColumn("_m2", F.col("m2") + F.col("n") * (F.col("mean") - F.col("_mean")) ** 2)
    merged = rows.groupBy("variable").agg(
        F.sum("rows").alias("rows"), F.sum("n").alias("count"), F.min("low").alias("min"), F.max("high").alias("max"),
        F.max("_mean").alias("mean"), F.sum("_m2").alias("_m2"),
        F.kll_merge_agg_double("kll").alias("_kll"), F.hll_sketch_estimate(F.hll_union_agg("hll")).alias("uniques"))
    std = F.sqrt(F.col("_m2") / F.nullif(F.col("count") - 1, F.lit(0)))
    some = F.col("count").cast("boolean") & F.col("min").isNotNull()
    quantiles = [F.when(some, F.kll_sketch_get_quantile_double("_kll", F.lit(float(p)))).alias(f"q{round(p * 100)}") for p in probs]
    return merged.select("variable", "rows", "count", (F.col("rows") - F.col("count")).alias("missings"), "min", "max", "mean",
                         std.alias("std"), "uniques", *quantiles)
