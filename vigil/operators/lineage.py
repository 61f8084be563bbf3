"""Lineage rows: one row per task run, built from aggregates of the data the
task produced plus execution literals (time, host, user are parameters)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RunInfo:
    """Execution fields recorded with every lineage and data-quality row."""
    fecha_ejecucion: str
    ip_address: str
    usuario: str

    def columns(self) -> list[Column]:
        return [F.lit(self.fecha_ejecucion).alias("fecha_ejecucion"),
                F.lit(self.ip_address).alias("ip_address"), F.lit(self.usuario).alias("usuario")]


def json_text(c: Column) -> Column:
    """A text value as a JSON string literal (quotes and backslashes escaped)."""
    escaped = F.regexp_replace(F.regexp_replace(c, r"\\", r"\\\\"), '"', '\\\\"')
    return F.concat(F.lit('"'), escaped, F.lit('"'))


def lineage_raw(raw: DataFrame, run: RunInfo, dataset: str, source: str,
                year: str = "year", month: str = "month", fmt: str = "json",
                quoted: bool = False, count: str | None = None) -> DataFrame:
    """One row per loaded month: rows loaded, request parameters, file name.
    ``count``: ``raw`` is counted already, that column holds the rows.
    ``quoted=True`` stores the request parameters JSON-encoded (``"2020"``),
    for consumers written against that layout; plain values by default."""
    per_month = raw.groupBy(year, month).agg((F.sum(count) if count else F.count(F.lit(1))).alias("rows"))
    name = F.format_string("%s_%04d_%02d.%s", F.lit(dataset), F.col(year), F.col(month), F.lit(fmt))
    enc = json_text if quoted else (lambda c: c)
    return per_month.select(
        F.lit(dataset).alias("dataset"), F.lit("UTC").alias("timezone"), "rows",
        enc(F.col(year).cast("string")).alias("refine_ano"),
        enc(F.col(month).cast("string")).alias("refine_mes"),
        enc(F.lit(source)).alias("parametro_url"), *run.columns(), name.alias("nombre_archivo"),
        F.lit(fmt).alias("formato_archivo"))


def lineage_clean(raw: DataFrame, kept: Column, run: RunInfo, task: str) -> DataFrame:
    """Clean-task row with the removed-row count: the raw rows that the cleaning
    rule ``kept`` does not keep, counted in one pass."""
    removed = F.count_if(~F.coalesce(kept, F.lit(False)))
    return raw.agg(removed.alias("n")).select(
        *run.columns(), F.lit(task).alias("id_tarea"), F.lit("completada").alias("estatus_tarea"),
        F.format_string("Deleted %d rows", F.col("n")).alias("registros_eliminados"),
        F.col("n").cast("bigint").alias("n_eliminados"))


def lineage_features(spark, run: RunInfo, task: str, generated, recoded, imputed, encoded) -> DataFrame:
    """Feature-task row: the column lists come from the pipeline definition."""
    row = [(run.fecha_ejecucion, run.ip_address, run.usuario, task, "completada",
            ",".join(generated), ",".join(recoded), ",".join(imputed), ",".join(encoded))]
    return spark.createDataFrame(row, "fecha string, ip string, usuario string, task_id string, "
                                      "task_status string, columnas_generadas string, "
                                      "columnas_recategorizadas string, columnas_imputadas string, "
                                      "columnas_one_hot_encoder string")


def with_run(df: DataFrame, run: RunInfo) -> DataFrame:
    """Execution fields on every row (the reference fills only row 0)."""
    return df.select(*run.columns(), *[F.col(c) for c in df.columns])
