"""Query-side tables behind serving and monitoring: lookups, period slices,
ordered and top-k priority lists, cohort unions, key binds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def predict_lookup(df: DataFrame, values: Mapping[str, object], order_key: str = "folio") -> DataFrame:
    """First prediction matching every key (stable: lowest ``order_key``).
    ``orderBy + limit(1)`` plans as a per-partition top-1, never a full sort."""
    cond = F.lit(True)
    for c, v in values.items():
        cond = cond & (F.col(c) == F.lit(v))
    return df.filter(cond).orderBy(F.col(order_key)).limit(1)


def predict_by_period(df: DataFrame, year: int, month: int,
                      year_col: str = "ano", month_col: str = "mes") -> DataFrame:
    """A period's predictions; on a year/month partitioned table this is a
    partition-pruned scan."""
    return df.filter((F.col(year_col) == year) & (F.col(month_col) == month))


#: What a look-up names besides the period; files are sorted and filtered by it.
LOOKUP_KEYS = ("delegacion_inicio", "dia_semana", "tipo_entrada", "incidente_c4_rec", "hora")


def write_predictions(scored: DataFrame, path: str, keys: Sequence[str] = LOOKUP_KEYS) -> None:
    """The table that look-ups read: a partition per (ano, mes), replaced when it
    is scored again; rows sorted by the look-up keys, so that a file's statistics
    skip it, with Bloom filters on the text keys. A month with many rows is
    several ranges of keys."""
    out = scored.repartitionByRange("ano", "mes", *keys).sortWithinPartitions("ano", "mes", *keys).write.mode("overwrite")
    for c in keys:
        if dict(scored.dtypes)[c] == "string":
            out = out.option(f"parquet.bloom.filter.enabled#{c}", "true")
    out.option("partitionOverwriteMode", "dynamic").partitionBy("ano", "mes").parquet(path)


def read_predictions(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    return spark.read.schema(like.schema).parquet(path)


def prediction_list(df: DataFrame, cols: Sequence[str], digits: int = 2) -> DataFrame:
    """Predictions by hour, most probable first within the hour; the
    probabilities are rounded for presentation after the sort."""
    ordered = df.orderBy(F.asc("hora"), F.desc("y_proba_1"), F.asc("folio"))
    return ordered.select(*[F.round(F.col(c), digits).alias(c) if c.startswith("y_proba") else F.col(c)
                            for c in cols])


def priority_topk(df: DataFrame, k: int, score: str = "y_proba_1", key: str = "folio",
                  group: str | None = None) -> DataFrame:
    """The ``k`` most probable incidents (per ``group`` if given), ties broken
    by the key. Global top-k is a TakeOrderedAndProject (k rows kept per
    partition); per-group top-k uses row_number, which Spark limits per
    partition before the shuffle (WindowGroupLimit)."""
    if group is None:
        return df.orderBy(F.desc(score), F.asc(key)).limit(k)
    w = Window.partitionBy(group).orderBy(F.desc(score), F.asc(key))
    return df.withColumn("rango", F.row_number().over(w)).filter(F.col("rango") <= k)


def tag_source(df: DataFrame, col: str, value: str) -> DataFrame:
    return df.withColumn(col, F.lit(value))


def union_cohorts(hist: DataFrame, live: DataFrame, col: str = "Datos",
                  labels: tuple[str, str] = ("Historicos", "Nuevos")) -> DataFrame:
    """UNION ALL by column name with an origin tag (duplicates kept)."""
    return tag_source(hist, col, labels[0]).unionByName(tag_source(live, col, labels[1]),
                                                        allowMissingColumns=True)


def bind_by_key(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Column bind by row key (never by position)."""
    return left.join(right, key, "inner")
