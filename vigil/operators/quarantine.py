"""Records that do not fit the clean table, kept with their reasons.

Every field is read as text and cast on its own, so one bad value names its
column and neither stops the load nor hides the others.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.catalog import RAW_FIELDS
from vigil.operators.clean import clean_expressions, valid_time
from vigil.session import shared_dir

#: Fields of a record that are not text, and their types (fixed values).
TYPED = {"mes": "smallint", "ano": "int", "latitud": "double", "longitud": "double"}


def with_errors(raw: DataFrame, col: str = "registros", keep: Iterable[str] = (), schema: T.StructType = RAW_FIELDS,
                types: dict[str, str] = TYPED, rules: dict[str, Column] | None = None) -> DataFrame:
    """(keep..., registros, fields..., errores): each record's fields, the typed
    ones cast (null where they can't be), and what is wrong with it: ``json`` (the
    document is broken; its fields are null), a column whose text is no value of
    its type, or a rule that is not met. No record is lost or repeated."""
    text = T.StructType([*(T.StructField(f.name, T.StringType()) for f in schema.fields), T.StructField("_broken", T.StringType())])
    rules = rules if rules is not None else {"hora_creacion": valid_time()}
    doc = F.from_json(F.col(col), text, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"})
    fields = raw.select(*keep, col, doc.alias("_doc")).select(
        *keep, col, (F.col("_doc").isNull() | F.col("_doc._broken").isNotNull()).alias("_is_broken"), *[f"_doc.{f.name}" for f in schema.fields])
    bad = [F.when(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull(), F.lit(c)) for c, t in types.items()]
    unmet = [F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()]
    errors = F.when(F.col("_is_broken"), F.array(F.lit("json"))).otherwise(F.filter(F.array(*bad, *unmet), lambda e: e.isNotNull()))
    return fields.withColumn("errores", errors).select(
        *keep, col, *[F.col(f.name).try_cast(types[f.name]).alias(f.name) if f.name in types else F.col(f.name) for f in schema.fields], "errores")


def clean_or_reject(raw: DataFrame, keep: Iterable[str] = (), path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(clean table, rejected records) of one pass over ``raw``: both are written
    as the two partitions of one table, so that together they are the input
    whatever happens. Rejected rows have ``keep``, the record and ``errores``."""
    spark, keep = raw.sparkSession, list(keep)
    path = path or shared_dir(spark, "quarantine")
    rows = with_errors(raw, keep=keep)
    clean = clean_expressions()
    fine = F.size("errores") == 0
    out = rows.select(*[F.col(k).alias(f"_{k}") for k in keep], F.when(~fine, F.col("registros")).alias("registros"), "errores",
                      *[F.when(fine, e).alias(c) for c, e in clean.items()], (~fine).alias("rechazado"))
    out.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("rechazado").parquet(path)
    written = spark.read.schema(out.schema).parquet(path)
    kept = [F.col(f"_{k}").alias(f"{k}") for k in keep]
    names = [c for c in clean if c not in keep]
    return (written.filter(~F.col("rechazado")).select(*kept, *names),
            written.filter(F.col("rechazado")).select(*kept, "registros", "errores"))
