"""Parse, type and clean raw incident documents.

One ``from_json`` pass with an explicit schema replaces per-field probing of
the document; Catalyst prunes the JSON fields no later step uses.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.catalog import RAW_FIELDS
from vigil.functions.stats import safe_ratio
from vigil.functions.text import remove_points, unaccent


def parse_documents(df: DataFrame, col: str = "registros",
                    schema: T.StructType = RAW_FIELDS, keep: Iterable[str] = ()) -> DataFrame:
    """Flatten JSON documents into typed columns; absent keys become null."""
    return df.select(*keep, F.from_json(F.col(col), schema).alias("_doc")).select(*keep, "_doc.*")


def json_extract(df: DataFrame, keys: Iterable[str], col: str = "registros",
                 keep: Iterable[str] = ()) -> DataFrame:
    """Each key of a JSON text column as a text column (null when absent)."""
    schema = T.StructType([T.StructField(k, T.StringType()) for k in keys])
    return parse_documents(df, col, schema, keep)


def valid_time(col: str = "hora_creacion") -> Column:
    return F.contains(F.col(col), F.lit(":"))


def valid_time_filter(df: DataFrame, col: str = "hora_creacion") -> DataFrame:
    """Keep rows whose time text contains ':' (nulls are dropped)."""
    return df.filter(valid_time(col))


def cast_columns(df: DataFrame, types: dict[str, str], lenient: bool = False) -> DataFrame:
    """Typed projection. Strict casts fail on bad input (ANSI); lenient ones
    give null instead."""
    cast = (lambda c, t: F.col(c).try_cast(t)) if lenient else (lambda c, t: F.col(c).cast(t))
    return df.select(*[cast(c, types[c]).alias(c) if c in types else F.col(c) for c in df.columns])


def clean_expressions() -> dict[str, Column]:
    """The cleaning rule of each field of the clean table."""
    low = F.lower
    return {
        "folio": F.col("folio"),
        "hora_creacion": F.col("hora_creacion"),
        "delegacion_inicio": remove_points(low(F.col("delegacion_inicio"))),
        "dia_semana": unaccent(low(F.col("dia_semana"))),
        "tipo_entrada": unaccent(low(F.col("tipo_entrada"))),
        "mes": F.col("mes").cast("smallint"),
        "latitud": F.col("latitud").cast("double"),
        "longitud": F.col("longitud").cast("double"),
        "ano": F.col("ano").cast("int"),
        "incidente_c4": unaccent(remove_points(low(F.col("incidente_c4")))),
        "codigo_cierre": unaccent(remove_points(low(F.col("codigo_cierre")))),
    }


def clean_incidents(df: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """Parsed raw incidents -> typed clean table (rows without a valid time
    are rejected)."""
    exprs = clean_expressions()
    return valid_time_filter(df).select(*keep, *[e.alias(c) for c, e in exprs.items()])


def clean_month(df: DataFrame, year: int, month: int) -> DataFrame:
    """Clean one month. If ``df`` still has the store's partition columns
    (year, month) these are filtered first and prune the scan; the record's own
    fields are compared as numbers, so ``04`` is month 4."""
    if {"year", "month"} <= set(df.columns):
        df = df.filter((F.col("year") == year) & (F.col("month") == month))
    number = lambda c: F.expr(f"try_cast({c} AS int)")
    return clean_incidents(df.filter((number("ano") == year) & (number("mes") == month)))


def recategorize(df: DataFrame, col: str = "incidente_c4", out: str = "incidente_c4_rec",
                 sep: str = "-") -> DataFrame:
    """Coarse category: the text before the first separator."""
    return df.withColumn(out, F.substring_index(F.col(col), sep, 1))


def hour_of_day(df: DataFrame, col: str = "hora_creacion", out: str = "hora") -> DataFrame:
    """Hour as an integer from ``HH:mm:ss`` text (lenient: null if not a number)."""
    return df.withColumn(out, F.substring_index(F.col(col), ":", 1).try_cast("int"))


def label_target(df: DataFrame, col: str = "codigo_cierre", positive: str = "a") -> DataFrame:
    """Class letter (second character) and the 0/1 target; null code -> 0."""
    clave = F.substring(F.col(col), 2, 1)
    return (df.withColumn("clave", clave)
              .withColumn("target", F.when(F.col("clave") == positive, 1).otherwise(0).cast("int")))


def preprocess(df: DataFrame) -> DataFrame:
    """clean -> processed: coarse category, hour, class letter, target."""
    return df.transform(recategorize).transform(hour_of_day).transform(label_target)


#: Rows without a borough go only while they are a smaller share than this.
NA_LIMIT = 0.03


def guarded_drop(df: DataFrame, col: str = "delegacion_inicio", value: str = "na",
                 limit: float = NA_LIMIT) -> DataFrame:
    """Drop rows equal to ``value`` only when their share is strictly below
    ``limit``; otherwise keep every row.

    The share is a global aggregate (partial aggregation on every partition)
    used as a scalar subquery: Spark evaluates it once and the filter reads
    the value, so the decision stays inside one plan with no join.
    """
    share = df.agg(safe_ratio(F.count(F.when(F.col(col) == value, 1)), F.count(F.lit(1)))
                   .alias("_share")).scalar()
    # the subquery is referenced once; an undefined share keeps every row
    keep = F.col(col).isNull() | (F.col(col) != value) | ~F.coalesce(share < limit, F.lit(False))
    return df.filter(keep)


def split_column(df: DataFrame, col: str, first: str, second: str, sep: str) -> DataFrame:
    """Split a text column in two at the first separator (rest goes to the
    second part; missing part -> null)."""
    parts = F.split(F.col(col), re.escape(sep), 2)
    return df.withColumn(first, F.get(parts, 0)).withColumn(second, F.get(parts, 1))


def drop_columns(df: DataFrame, *cols: str) -> DataFrame:
    return df.drop(*cols)


def lower_columns(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*[F.lower(F.col(c)).alias(c) if c in cols else F.col(c) for c in df.columns])
