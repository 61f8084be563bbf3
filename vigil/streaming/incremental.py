"""Incremental clean and scoring of newly landed raw months.

Two file-source streams with fixed schemas, triggered with ``availableNow``:
each run processes exactly the files that arrived since the last run (the
checkpoint is the marker that prevents a second run of a month).

The first reads the raw store: every month that has a new file is read whole and
replaces its partition of the clean table, so a month delivered again isn't
doubled, and one that has no valid record left is removed. The clean table has
the partitions of the raw store (year, month of the delivery, null ones too),
whatever month a record itself names, so a late record replaces nothing of its
own month. Each batch then adds the months that it has replaced to a change log.

The second reads that log: the months in it are scored again, whole, by the
stored model and replace their partitions of the prediction table.

All files that a run finds are one batch, so a month of many files is
rewritten once. The checkpoints live in the cluster's shared folder, so a lost
driver or executor resumes from the last committed batch; a batch that runs
again replaces the same partitions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.catalog import CLEAN
from vigil.operators.clean import clean_incidents, parse_documents
from vigil.session import materialize
from vigil.sources.files import PARTITIONS

_MONTH = [T.StructField("year", T.IntegerType()), T.StructField("month", T.IntegerType())]
RAW_STREAM_SCHEMA = T.StructType([T.StructField("value", T.StringType()), *_MONTH])
CLEAN_TABLE = T.StructType([*CLEAN.fields, *_MONTH])
CHANGES = T.StructType([*_MONTH, T.StructField("rows", T.LongType())])


def raw_stream(spark: SparkSession, raw_path: str) -> DataFrame:
    return spark.readStream.format("text").schema(RAW_STREAM_SCHEMA).load(raw_path)


def _any_of(months: list[Row]) -> Column:
    out = F.lit(False)
    for m in months:
        out = out | (F.col("year").eqNullSafe(m["year"]) & F.col("month").eqNullSafe(m["month"]))
    return out


def _remove(spark: SparkSession, table: str, month: Row) -> None:
    """Removes the partition of a month, if there is one."""
    name = lambda v: "__HIVE_DEFAULT_PARTITION__" if v is None else v
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{table}/year={name(month['year'])}/month={name(month['month'])}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def replace_months(rows: DataFrame, months: list[Row], table: str) -> list[tuple]:
    """The ``months`` of ``table`` become those of ``rows`` (which has year and
    month); a month without rows is removed. Returns (year, month, rows)."""
    spark = rows.sparkSession
    written = materialize(rows, "months")
    counts = {(r["year"], r["month"]): r["n"] for r in written.groupBy(*PARTITIONS).agg(F.count(F.lit(1)).alias("n")).collect()}
    written.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*PARTITIONS).parquet(table)
    for m in months:
        if (m["year"], m["month"]) not in counts:
            _remove(spark, table, m)
    return [(m["year"], m["month"], counts.get((m["year"], m["month"]), 0)) for m in months]


def _run(stream: DataFrame, checkpoint: str, handle: Callable[[SparkSession, list[Row]], None]) -> int:
    def batch(df: DataFrame, _: int) -> None:
        months = df.select(*PARTITIONS).distinct().collect()        # a row per delivered month
        if months:
            handle(df.sparkSession, months)

    query = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return len(query.recentProgress)


def run_incremental_clean(spark: SparkSession, raw_path: str, out_path: str, checkpoint: str, changes: str | None = None) -> int:
    """Process every raw file not seen yet; returns the number of batches.
    ``changes``: folder of the change log that ``run_scoring`` reads."""
    def clean(session: SparkSession, months: list[Row]) -> None:
        raw = session.read.schema(RAW_STREAM_SCHEMA).text(raw_path).filter(_any_of(months)).withColumnRenamed("value", "registros")
        done = replace_months(clean_incidents(parse_documents(raw, keep=PARTITIONS), keep=PARTITIONS), months, out_path)
        if changes:
            session.createDataFrame(done, CHANGES).coalesce(1).write.mode("append").json(changes)

    return _run(raw_stream(spark, raw_path), checkpoint, clean)


def run_scoring(spark: SparkSession, changes: str, clean_path: str, out_path: str, checkpoint: str,
                score: Callable[[DataFrame], DataFrame]) -> int:
    """Scores the months that the change log names and replaces their predictions;
    returns the number of batches. ``score`` gets rows of the clean table (with
    the delivery's year and month, which it keeps) and returns predictions."""
    def predict(session: SparkSession, months: list[Row]) -> None:
        rows = session.read.schema(CLEAN_TABLE).parquet(clean_path).filter(_any_of(months))
        replace_months(score(rows), months, out_path)

    return _run(spark.readStream.schema(CHANGES).json(changes), checkpoint, predict)


def read_clean(spark: SparkSession, out_path: str) -> DataFrame:
    """The streamed clean table with its declared types, without the
    delivery's year and month."""
    return spark.read.schema(CLEAN).parquet(out_path).select(*[F.col(f.name) for f in CLEAN.fields])
