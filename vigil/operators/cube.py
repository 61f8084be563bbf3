"""Monitoring cube: the few counts that the dashboard's tables are made of.

One aggregation with grouping sets over the scored rows gives a row per month,
origin and slice; the dashboard's charts read those rows only. The cube is
partitioned by month and a month that is scored again replaces its partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigil.functions.stats import safe_ratio

BINS = 50
MONTH = ("ano", "mes")
#: The slices: what a chart groups by besides month and origin.
SETS = {"delegacion": ("delegacion_inicio", "bin"), "canal": ("tipo_entrada",)}


def build(scored: DataFrame, origin: str = "Datos", bins: int = BINS) -> DataFrame:
    """(ano, mes, Datos, corte, delegacion_inicio, tipo_entrada, bin, n, positivos,
    suma): rows, predicted positives and summed probability of each cell of each
    slice; a score of 1 is in the last bin."""
    b = F.least(F.floor(F.col("y_proba_1") * bins), F.lit(bins - 1)).cast("int")
    rows = scored.select(*MONTH, origin, "delegacion_inicio", "tipo_entrada", b.alias("bin"), "y_etiqueta", "y_proba_1")
    common = [F.col(c) for c in (*MONTH, origin)]
    sets = [[*common, *map(F.col, s)] for s in SETS.values()]
    columns = [*common, *(F.col(c) for s in SETS.values() for c in s)]
    cells = rows.groupingSets(sets, *columns).agg(
        F.grouping("tipo_entrada").alias("_no_channel"), F.count(F.lit(1)).alias("n"),
        F.sum("y_etiqueta").cast("bigint").alias("positivos"), F.sum("y_proba_1").alias("suma"))
    names = list(SETS)
    return cells.select(*MONTH, origin, F.when(F.col("_no_channel") == 1, names[0]).otherwise(names[1]).alias("corte"),
                        "delegacion_inicio", "tipo_entrada", "bin", "n", "positivos", "suma")


def write(cube: DataFrame, path: str) -> None:
    """Replaces the months of ``cube`` and leaves the others as they are."""
    (cube.repartition(*MONTH).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*MONTH).parquet(path))


def read(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    return spark.read.schema(like.schema).parquet(path)


def histogram(cube: DataFrame, origin: str = "Datos", group: str | None = None, bins: int = BINS) -> DataFrame:
    """Score histogram per origin (of one borough: ``group``) with percentages."""
    cells = cube.filter((F.col("corte") == "delegacion") & F.col("bin").isNotNull())
    if group is not None:
        cells = cells.filter(F.col("delegacion_inicio") == group)
    counts = cells.groupBy(origin, "bin").agg(F.sum("n").alias("n"))
    return counts.withColumn("pct", F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy(origin))).withColumn(
        "bin_inicio", F.col("bin") / F.lit(float(bins)))


def positive_rate(cube: DataFrame, by: str, origin: str = "Datos") -> DataFrame:
    """Percentage of predicted positives and mean probability per origin and
    borough or channel."""
    cells = cube.filter(F.col("corte") == ("canal" if by == "tipo_entrada" else "delegacion"))
    out = cells.groupBy(origin, by).agg(F.sum("n").alias("n"), F.sum("positivos").alias("positivos"), F.sum("suma").alias("suma"))
    return out.select(origin, by, "n", (safe_ratio("positivos", "n") * 100).alias("pct_positivos"), safe_ratio("suma", "n").alias("media"))
