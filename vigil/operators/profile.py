"""Data profiles and grouped summaries (EDA and monitoring tables).

Every profile is one aggregation pass: all statistics of all columns are
computed by a single ``agg`` (partial aggregation on each partition, one small
final merge) and then unpivoted to one row per variable.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.functions.stats import safe_ratio, sample_kurtosis, sample_skewness
from vigil.operators.quantiles import exact_quantiles, quantile_columns, ranked_values

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
           T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def _number(c: str) -> Column:
    """A column as double; NaN is a missing value."""
    x = F.col(c).cast("double")
    return F.when(~F.isnan(x), x)


def _unpivot_single_row(row_df: DataFrame, cols: Sequence[str], stats: Sequence[str],
                        types: dict[str, str]) -> DataFrame:
    """One wide row with ``<col>__<stat>`` fields -> one row per column."""
    structs = [F.struct(F.lit(c).alias("variable"),
                        *[F.col(f"`{c}__{s}`").cast(types[s]).alias(s) for s in stats])
               for c in cols]
    return row_df.select(F.inline(F.array(*structs)))


def describe_numeric(df: DataFrame, cols: Sequence[str] | None = None,
                     exact: bool = True, accuracy: int = 100_000) -> DataFrame:
    """max, min, mean, std, q25, median, q75, skew, kurt, count, uniques,
    missings, prop_missings for each numeric column, one row per variable.

    ``exact=True`` uses exact percentiles and distinct counts; ``exact=False``
    switches to ``percentile_approx`` / HyperLogLog, whose aggregation buffers
    have a fixed size however large the table is.
    """
    cols = list(cols or numeric_columns(df))
    aggs: list[Column] = [F.count(F.lit(1)).alias("__rows")]
    for c in cols:
        x = F.col(c)
        if not exact:
            qs = F.percentile_approx(x, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), accuracy)
            aggs += [F.approx_count_distinct(x, 0.01).alias(f"{c}__uniques"), qs.alias(f"{c}__qs")]
        aggs += [F.max(x).alias(f"{c}__max"), F.min(x).alias(f"{c}__min"),
                 F.avg(x).alias(f"{c}__mean"), F.stddev_samp(x).alias(f"{c}__std"),
                 sample_skewness(x).alias(f"{c}__skew"),
                 sample_kurtosis(x).alias(f"{c}__kurt"), F.count(x).alias(f"{c}__count")]
    # each column is made a number once, before its statistics
    wide = df.select(*[_number(c).alias(c) for c in cols]).agg(*aggs)
    for c in cols:
        if not exact:
            wide = (wide.withColumn(f"{c}__q25", F.col(f"`{c}__qs`")[0])
                        .withColumn(f"{c}__median", F.col(f"`{c}__qs`")[1])
                        .withColumn(f"{c}__q75", F.col(f"`{c}__qs`")[2]))
        wide = (wide.withColumn(f"{c}__missings", F.col("__rows") - F.col(f"`{c}__count`"))
                    .withColumn(f"{c}__prop_missings",
                                safe_ratio(F.col(f"`{c}__missings`"), F.col("__rows")) * 100))
    stats = ["max", "min", "mean", "std", "skew", "kurt", "count", "missings", "prop_missings"]
    types = {s: "double" for s in stats + ["q25", "median", "q75"]}
    types.update(count="bigint", missings="bigint", uniques="bigint")
    if not exact:
        return _unpivot_single_row(wide, cols, stats + ["q25", "median", "q75", "uniques"], types)
    # exact quantiles by distributed rank selection (no column in one task); the
    # counted values that they are taken from give the distinct counts
    ranked = ranked_values(df, cols)
    uniques = ranked.groupBy("variable").agg(F.count(F.lit(1)).alias("uniques"))
    quants = quantile_columns(exact_quantiles(df, cols, [0.25, 0.5, 0.75], ranked=ranked),
                              {"q25": 0.25, "median": 0.5, "q75": 0.75})
    long = _unpivot_single_row(wide, cols, stats, types)
    order = ["variable", "max", "min", "mean", "std", "q25", "median", "q75", "skew", "kurt",
             "count", "uniques", "missings", "prop_missings"]
    # one row per variable on every side: tiny broadcast joins
    return (long.join(F.broadcast(uniques), "variable", "left")
                .join(F.broadcast(quants), "variable", "left")
                .withColumn("uniques", F.coalesce(F.col("uniques"), F.lit(0)).cast("bigint"))
                .select(*order))


def describe_categorical(df: DataFrame, cols: Sequence[str] | None = None,
                         exact: bool = True) -> DataFrame:
    """count, uniques, missings, prop_missings per text column. The list of
    unique values is the long table of ``distinct_values`` (one row per
    value), so no row ever holds an unbounded list."""
    cols = list(cols or string_columns(df))
    aggs: list[Column] = [F.count(F.lit(1)).alias("__rows")]
    for c in cols:
        aggs.append(F.count(F.col(c)).alias(f"{c}__count"))
        if not exact:
            aggs.append(F.approx_count_distinct(F.col(c), 0.01).alias(f"{c}__uniques"))
    wide = df.agg(*aggs)
    for c in cols:
        wide = (wide.withColumn(f"{c}__missings", F.col("__rows") - F.col(f"`{c}__count`"))
                    .withColumn(f"{c}__prop_missings",
                                safe_ratio(F.col(f"`{c}__missings`"), F.col("__rows")) * 100))
    types = {"count": "bigint", "uniques": "bigint", "missings": "bigint", "prop_missings": "double"}
    if not exact:
        return _unpivot_single_row(wide, cols, ["count", "uniques", "missings", "prop_missings"], types)
    # exact distinct counts: one explode + distinct of (variable, value)
    uniques = (distinct_values(df, cols).groupBy("variable")
                 .agg(F.count(F.lit(1)).alias("uniques")))
    long = _unpivot_single_row(wide, cols, ["count", "missings", "prop_missings"], types)
    return (long.join(F.broadcast(uniques), "variable", "left")
                .withColumn("uniques", F.coalesce(F.col("uniques"), F.lit(0)).cast("bigint"))
                .select("variable", "count", "uniques", "missings", "prop_missings"))


def distinct_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(variable, value) for every distinct non-null value of each column.
    One explode + one distinct shuffle; partial dedup happens map-side."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("variable"),
                                         F.col(c).cast("string").alias("value")) for c in cols]))
    return (df.select(pairs.alias("p")).select("p.*")
              .filter(F.col("value").isNotNull()).distinct())


def category_counts(df: DataFrame, cat: str, counted: str | None = None,
                    out: str = "n") -> DataFrame:
    """Non-null ``counted`` values per category, most frequent first
    (null categories are not a group)."""
    target = F.col(counted) if counted else F.lit(1)
    return (df.filter(F.col(cat).isNotNull()).groupBy(cat)
              .agg(F.count(target).alias(out))
              .orderBy(F.desc(out), F.asc(cat)))


def category_means(df: DataFrame, cat: str, value: str, out: str | None = None) -> DataFrame:
    """Mean of ``value`` per category, highest first."""
    out = out or f"mean_{value}"
    return (df.filter(F.col(cat).isNotNull()).groupBy(cat)
              .agg(F.avg(F.col(value)).alias(out))
              .orderBy(F.desc_nulls_last(out), F.asc(cat)))


def topn_ranking(df: DataFrame, n: int, cat1: str, cat2: str, value: str) -> DataFrame:
    """Top ``n`` (cat1, cat2) pairs by mean ``value`` (ties by the keys)."""
    out = f"mean_{value}"
    return (df.filter(F.col(cat1).isNotNull() & F.col(cat2).isNotNull())
              .groupBy(cat1, cat2).agg(F.avg(value).alias(out))
              .orderBy(F.desc_nulls_last(out), F.asc(cat1), F.asc(cat2)).limit(n))


def ordered_means(df: DataFrame, cat: str, value: str, order: Sequence[str]) -> DataFrame:
    """Mean of ``value`` for the listed categories, in the given order.
    The category list is a parameter (bounded), matched by ``array_position``
    so no join is needed."""
    pos = F.array_position(F.array(*[F.lit(v) for v in order]), F.col(cat))
    out = f"mean_{value}"
    return (df.filter(pos > 0).groupBy(cat).agg(F.avg(value).alias(out), F.first(pos).alias("posicion"))
              .select(F.col("posicion").cast("int").alias("posicion"), cat, out)
              .orderBy("posicion"))


def correlation_matrix(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of every pair (pairwise complete rows; NaN is missing),
    long form (var1, var2, corr); all pairs in a single aggregation pass."""
    cols = list(cols or numeric_columns(df))
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    # each column is made a number once, before the pairs
    wide = df.select(*[_number(c).alias(c) for c in cols]).agg(*[F.corr(a, b).alias(f"{a}__{b}") for a, b in pairs])
    structs = []
    for a, b in pairs:
        structs.append(F.struct(F.lit(a).alias("var1"), F.lit(b).alias("var2"),
                                F.col(f"`{a}__{b}`").alias("corr")))
        if a != b:
            structs.append(F.struct(F.lit(b).alias("var1"), F.lit(a).alias("var2"),
                                    F.col(f"`{a}__{b}`").alias("corr")))
    return wide.select(F.inline(F.array(*structs)))


def grouped_counts(df: DataFrame, keys: Sequence[str], out: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def rate_by(df: DataFrame, key: str, target: str = "target") -> DataFrame:
    """Positive count, negative count and positive share per key."""
    return df.groupBy(key).agg(F.sum(F.col(target)).cast("bigint").alias("positivos"),
                               F.sum(1 - F.col(target)).cast("bigint").alias("negativos"),
                               F.avg(F.col(target)).alias("tasa_positivos"))


def trend_by_code(df: DataFrame, year: str = "ano", month: str = "mes",
                  code: str = "clave") -> DataFrame:
    """Calls per month and closure class."""
    period = F.make_date(F.col(year).cast("int"), F.col(month).cast("int"), F.lit(1))
    return df.groupBy(period.alias("periodo"), F.col(code)).agg(F.count(F.lit(1)).alias("n"))


def describe_by_group(df: DataFrame, group: str, cols: Sequence[str]) -> DataFrame:
    """count, mean, std, min, quartiles, max per group and numeric column:
    one grouped aggregation for the moments plus the distributed exact
    quantile selection, joined on (group, variable)."""
    aggs = []
    for c in cols:
        x = _number(c)
        aggs += [F.count(x).alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__std"), F.min(x).alias(f"{c}__min"),
                 F.max(x).alias(f"{c}__max")]
    wide = df.groupBy(group).agg(*aggs)
    structs = [F.struct(F.lit(c).alias("variable"),
                        F.col(f"`{c}__count`").cast("bigint").alias("count"),
                        F.col(f"`{c}__mean`").alias("mean"), F.col(f"`{c}__std`").alias("std"),
                        F.col(f"`{c}__min`").alias("min"), F.col(f"`{c}__max`").alias("max"))
               for c in cols]
    moments = wide.select(group, F.inline(F.array(*structs)))
    quants = quantile_columns(exact_quantiles(df, cols, [0.25, 0.5, 0.75], group=group),
                              {"q25": 0.25, "q50": 0.5, "q75": 0.75}, group=group)
    return (moments.join(quants, [group, "variable"], "left")
                   .select(group, "variable", "count", "mean", "std", "min", "q25", "q50", "q75", "max"))


def describe_categorical_by_group(df: DataFrame, group: str, cols: Sequence[str]) -> DataFrame:
    """count, unique, top (most frequent, ties -> lowest value) and its
    frequency per group and text column. Values are counted per (group,
    variable, value) first — a partial aggregation — so a hot value never
    gathers its rows in one place."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("variable"),
                                         F.col(c).cast("string").alias("value")) for c in cols]))
    counts = (df.select(F.col(group), pairs.alias("p")).select(group, "p.*")
                .filter(F.col("value").isNotNull())
                .groupBy(group, "variable", "value").agg(F.count(F.lit(1)).alias("freq")))
    # min over (-freq, value) picks the most frequent value, ties -> lowest.
    best = F.min(F.struct((-F.col("freq")).alias("nf"), F.col("value").alias("top"),
                          F.col("freq").alias("f")))
    summary = counts.groupBy(group, "variable").agg(
        F.sum("freq").cast("bigint").alias("count"),
        F.count(F.lit(1)).cast("bigint").alias("unique"), best.alias("m"))
    return summary.select(group, "variable", "count", "unique", F.col("m.top").alias("top"),
                          F.col("m.f").cast("bigint").alias("freq"))


def positive_rate_by_group(df: DataFrame, origin: str, group: str, origins: Sequence[str],
                           target: str = "target") -> DataFrame:
    """Positive percentage per origin x group; a pair with no rows is null.

    The origins are a known, bounded list, so the grid comes from a pivot over
    them (no cross join): one grouped aggregation keyed by ``group``."""
    wide = df.groupBy(group).pivot(origin, list(origins)).agg(F.avg(F.col(target)) * 100)
    structs = [F.struct(F.lit(o).alias(origin), F.col(f"`{o}`").cast("double").alias("pct_positivos"))
               for o in origins]
    return wide.select(group, F.inline(F.array(*structs))).select(origin, group, "pct_positivos")


def score_histogram(df: DataFrame, score: str, origin: str | None = None,
                    bins: int = 50) -> DataFrame:
    """Histogram of a [0, 1] score with ``bins`` equal bins (1.0 falls in the
    last bin) and each bin's percentage of its origin."""
    b = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).cast("int")
    keys = [origin] if origin else []
    counts = df.filter(F.col(score).isNotNull()).groupBy(*keys, b.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    return counts.withColumn("pct", F.col("n") * 100.0 / F.sum("n").over(w)) \
                 .withColumn("bin_inicio", F.col("bin") / F.lit(float(bins)))


def table_shape(df: DataFrame) -> DataFrame:
    """Row and column count of a table as a one-row frame."""
    return df.agg(F.count(F.lit(1)).alias("filas")).withColumn("columnas", F.lit(len(df.columns)))


def column_types(df: DataFrame) -> DataFrame:
    rows = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "variable string, tipo string")
