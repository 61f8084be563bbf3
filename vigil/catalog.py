"""Table access and the fixed schemas of the data product."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """Scan one input table. Column pruning and filter pushdown reach the
    parquet reader through Catalyst, so callers just select/filter.

    ``spread=True`` is for fact tables followed by per-row work (JSON, text,
    statistics): a table stored as fewer splits than the cluster has cores
    (one file with one row group) would run every narrow step after the scan
    in that many tasks, so such an under-split input is spread round-robin
    over the cores. On a large table (thousands of splits) nothing is added.
    Dimension tables that end up broadcast are never spread."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    if spread:
        cores = spark.sparkContext.defaultParallelism
        if df.rdd.getNumPartitions() < cores:
            df = df.repartition(cores)
    return df


# Fields of one raw incident document (schema-on-read is replaced by this
# explicit schema so a single from_json pass parses every field).
RAW_FIELDS = T.StructType([
    T.StructField("folio", T.StringType()),
    T.StructField("hora_creacion", T.StringType()),
    T.StructField("delegacion_inicio", T.StringType()),
    T.StructField("dia_semana", T.StringType()),
    T.StructField("tipo_entrada", T.StringType()),
    T.StructField("mes", T.StringType()),
    T.StructField("ano", T.StringType()),
    T.StructField("incidente_c4", T.StringType()),
    T.StructField("codigo_cierre", T.StringType()),
    T.StructField("latitud", T.DoubleType()),
    T.StructField("longitud", T.DoubleType()),
    T.StructField("geopoint", T.ArrayType(T.StringType())),
])

# Typed clean table. `folio` is kept as the row key (identity never comes
# from row order).
CLEAN = T.StructType([
    T.StructField("folio", T.StringType()),
    T.StructField("hora_creacion", T.StringType()),
    T.StructField("delegacion_inicio", T.StringType()),
    T.StructField("dia_semana", T.StringType()),
    T.StructField("tipo_entrada", T.StringType()),
    T.StructField("mes", T.ShortType()),
    T.StructField("latitud", T.DoubleType()),
    T.StructField("longitud", T.DoubleType()),
    T.StructField("ano", T.IntegerType()),
    T.StructField("incidente_c4", T.StringType()),
    T.StructField("codigo_cierre", T.StringType()),
])

MODEL_CATEGORICAL = ("delegacion_inicio", "dia_semana", "tipo_entrada", "incidente_c4_rec")
MODEL_NUMERIC = ("mes", "hora")
MODEL_TARGET = "target"
# Columns of the model's input, in the order of its file (fixed values).
MODEL_INPUT = ("delegacion_inicio", "mes", "dia_semana", "hora", "tipo_entrada", "incidente_c4_rec",
               "target")
