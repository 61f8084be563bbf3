"""Exact quantiles (linear interpolation, like pandas ``quantile`` and SQL
``quantile_cont``) computed without gathering a column in one task.

1. Values are counted per (group, variable, value): a partial aggregation,
   so a value repeated in a third of the rows becomes one row.
2. The counted values are range-partitioned and sorted by (group, variable,
   value); a running count inside each range partition plus the counts of
   the preceding partitions (a table with one row per partition and
   variable) gives each value the run of ranks [start, end) it covers.
3. The wanted ranks floor((n-1)q) and ceil((n-1)q) per (group, variable)
   form a small table; one equi-join on (group, variable) with a range
   condition picks the values at those ranks.

No step holds more than one range partition of distinct values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil.session import materialize


def ranked_values(df: DataFrame, cols: Sequence[str], group: str | None = None) -> DataFrame:
    """(group?, variable, x, c, _pid, _run): every distinct value with its count,
    its range partition and the running count in there. A row per distinct
    value; null and NaN are left out. Written once: two runs of a range shuffle
    need not cut the values alike."""
    keys = [*([group] if group else []), "variable"]
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("variable"),
                                         F.col(c).cast("double").alias("x")) for c in cols]))
    values = (df.select(*keys[:-1], pairs.alias("p")).select(*keys[:-1], "p.*")
                .filter(F.col("x").isNotNull() & ~F.isnan("x")))
    counted = values.groupBy(*keys, "x").agg(F.count(F.lit(1)).alias("c"))
    ranged = (counted.repartitionByRange(*[F.col(k) for k in keys], F.col("x"))
                     .sortWithinPartitions(*keys, "x")
                     .withColumn("_pid", F.spark_partition_id()))
    within = Window.partitionBy("_pid", *keys).orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    return materialize(ranged.withColumn("_run", F.sum("c").over(within)), "ranked-values")


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                    group: str | None = None, ranked: DataFrame | None = None) -> DataFrame:
    """Long table (group?, variable, prob, value) of exact quantiles (``ranked``:
    the values as ``ranked_values`` returned them)."""
    keys = [*([group] if group else []), "variable"]
    ranged = ranked if ranked is not None else ranked_values(df, cols, group)
    # rows of a (group, variable) per range partition, and the exclusive
    # prefix over partitions: one row per (partition, variable)
    per_part = ranged.groupBy(*keys, "_pid").agg(F.sum("c").alias("_pc"))
    before = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select(*keys, "_pid", F.coalesce(F.sum("_pc").over(before), F.lit(0)).alias("_off"))
    spans = (ranged.join(offsets, [*keys, "_pid"])
                   .select(*keys, "x", (F.col("_off") + F.col("_run") - F.col("c")).alias("start"),
                           (F.col("_off") + F.col("_run")).alias("end")))

    totals = per_part.groupBy(*keys).agg(F.sum("_pc").alias("n"))
    wanted = (totals.select(*keys, "n", F.explode(F.array(*[F.lit(float(q)) for q in probs])).alias("prob"))
                    .withColumn("pos", (F.col("n") - 1) * F.col("prob"))
                    .withColumn("lo", F.floor("pos").cast("bigint"))
                    .withColumn("hi", F.ceil("pos").cast("bigint")))
    # both wanted ranks as rows, so one range join finds the two values
    ranks = wanted.select(*keys, "prob", "pos", "lo", "hi",
                          F.explode(F.array(F.col("lo"), F.col("hi"))).alias("r"))
    # one row per (variable, prob, rank) without groups: a fixed size,
    # broadcast. With groups it grows with the group count, so AQE decides
    # from the measured size (broadcast when small, shuffle join otherwise).
    if group is None:
        ranks = F.broadcast(ranks)
    hit = (spans.join(ranks, keys)
                .filter((F.col("start") <= F.col("r")) & (F.col("r") < F.col("end"))))
    both = hit.groupBy(*keys, "prob", "pos", "lo", "hi").agg(
        F.max(F.when(F.col("r") == F.col("lo"), F.col("x"))).alias("v_lo"),
        F.max(F.when(F.col("r") == F.col("hi"), F.col("x"))).alias("v_hi"))
    value = F.when(F.col("lo") == F.col("hi"), F.col("v_lo")).otherwise(
        (F.col("hi") - F.col("pos")) * F.col("v_lo") + (F.col("pos") - F.col("lo")) * F.col("v_hi"))
    return both.select(*keys, "prob", value.alias("value"))


def quantile_columns(q: DataFrame, probs: dict[str, float], group: str | None = None) -> DataFrame:
    """(group?, variable, <name>...) from the long quantile table (one small
    aggregation over at most #variables x #probs rows per group)."""
    keys = ([group] if group else []) + ["variable"]
    return q.groupBy(*keys).agg(*[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(name)
                                  for name, p in probs.items()])
