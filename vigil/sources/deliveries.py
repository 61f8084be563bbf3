"""Atomic loads of the raw store: a delivery is seen whole or not at all.

A load writes its rows, counts what it has written, writes a metadata row per
month and, last, one manifest file that lists the months of the delivery.
Readers take only the rows and metadata of deliveries with a manifest, so a load
that stops anywhere before it leaves nothing to be seen, and running it again
under the same name is safe. Nothing is ever overwritten in place: a delivery that replaces a
month only hides the earlier rows of that month.

    <store>/rows/delivery=<name>/year=/month=     JSON lines
    <store>/metadata/delivery=<name>              a row per month
    <store>/manifest/delivery=<name>              a row per month, one file
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from vigil.operators.lineage import RunInfo, lineage_raw
from vigil.session import materialize
from vigil.sources.files import PARTITIONS, spread_by_partition

MANIFEST = T.StructType([T.StructField("delivery", T.StringType()), T.StructField("position", T.LongType()),
                         T.StructField("mode", T.StringType()), T.StructField("year", T.IntegerType()),
                         T.StructField("month", T.IntegerType()), T.StructField("rows", T.LongType())])
METADATA = T.StructType([T.StructField("delivery", T.StringType()),
                         *[T.StructField(c, T.LongType() if c == "rows" else T.StringType()) for c in (
                             "dataset", "timezone", "rows", "refine_ano", "refine_mes", "parametro_url", "fecha_ejecucion",
                             "ip_address", "usuario", "nombre_archivo", "formato_archivo")]])
ROWS = T.StructType([T.StructField("value", T.StringType()), T.StructField("delivery", T.StringType()),
                     T.StructField("year", T.IntegerType()), T.StructField("month", T.IntegerType())])


def _table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table whose folder may not be there yet."""
    jvm = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not jvm.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm):
        return spark.createDataFrame([], schema)
    # the partition column is declared as text: a name like 2020 stays one
    return spark.read.schema(schema).parquet(path)


def manifests(spark: SparkSession, store: str) -> DataFrame:
    """(delivery, position, mode, year, month, rows) of every committed delivery."""
    return _table(spark, f"{store}/manifest", MANIFEST)


def stage(raw: DataFrame, store: str, delivery: str, run: RunInfo, dataset: str, source: str) -> DataFrame:
    """Writes rows and metadata of a delivery (again, if it was staged before)
    and returns its rows per month. Both are counted in the written files: the
    source is read once and may change meanwhile. Nobody sees the rows yet."""
    spark = raw.sparkSession
    if not manifests(spark, store).where(F.col("delivery") == delivery).isEmpty():
        raise ValueError(f"delivery {delivery} is committed")
    path = f"{store}/rows/delivery={delivery}"
    (spread_by_partition(raw.select("registros", *PARTITIONS), list(PARTITIONS), F.xxhash64("registros")).write.mode("overwrite")
     .option("partitionOverwriteMode", "static").partitionBy(*PARTITIONS).text(path))
    # one level up, as a delivery without rows has no files of its own to read
    written = spark.read.schema(ROWS).text(f"{store}/rows").filter(F.col("delivery") == delivery)
    stored = materialize(written.groupBy(*PARTITIONS).agg(F.count(F.lit(1)).alias("rows")), "delivered-months")
    lineage_raw(stored, run, dataset, source, count="rows").select(
        *[F.col(f.name).cast(f.dataType) for f in METADATA.fields if f.name != "delivery"]).coalesce(1).write.mode("overwrite").parquet(
        f"{store}/metadata/delivery={delivery}")
    return stored


def commit(stored: DataFrame, store: str, delivery: str, mode: str = "append") -> None:
    """Writes the manifest of a staged delivery. ``mode``: ``append`` adds to the
    months delivered before, ``replace`` hides their earlier rows."""
    if mode not in ("append", "replace"):
        raise ValueError(mode)
    spark = stored.sparkSession
    position = (manifests(spark, store).agg(F.max("position")).first()[0] or 0) + 1
    (stored.select(F.lit(position).cast("long").alias("position"), F.lit(mode).alias("mode"), *PARTITIONS, "rows")
     .coalesce(1).write.mode("overwrite").parquet(f"{store}/manifest/delivery={delivery}"))      # one file: there or not


def load(raw: DataFrame, store: str, delivery: str, run: RunInfo, dataset: str, source: str, mode: str = "append") -> None:
    commit(stage(raw, store, delivery, run, dataset, source), store, delivery, mode)


def visible(spark: SparkSession, store: str) -> DataFrame:
    """(delivery, year, month, rows) whose rows count: of each month the last
    delivery that replaced it and those after that."""
    month = Window.partitionBy(*PARTITIONS)
    since = F.max(F.when(F.col("mode") == "replace", F.col("position"))).over(month)
    return manifests(spark, store).withColumn("since", F.coalesce(since, F.lit(0))).where(
        F.col("position") >= F.col("since")).select("delivery", *PARTITIONS, "rows")


def read_rows(spark: SparkSession, store: str, year: int | None = None, month: int | None = None) -> DataFrame:
    """(registros, year, month) of the visible rows. The list of visible months
    (a row per delivery and month) is joined on the partition columns, so that
    folders which it doesn't name are not read."""
    seen = visible(spark, store).select("delivery", *PARTITIONS)
    for c, v in (("year", year), ("month", month)):
        if v is not None:
            seen = seen.where(F.col(c) == v)
    if seen.isEmpty():
        return spark.createDataFrame([], "registros string, year int, month int")
    rows = spark.read.schema(ROWS).text(f"{store}/rows")
    for c, v in (("year", year), ("month", month)):
        rows = rows if v is None else rows.where(F.col(c) == v)
    rows = rows.alias("r")
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"s.{c}")) for c in PARTITIONS]
    on = (F.col("r.delivery") == F.col("s.delivery")) & same[0] & same[1]
    return rows.join(seen.alias("s"), on, "left_semi").select(F.col("value").alias("registros"), *PARTITIONS)


def read_metadata(spark: SparkSession, store: str) -> DataFrame:
    """Metadata rows of the committed deliveries, each as it was recorded."""
    committed = manifests(spark, store).select("delivery").distinct()
    return _table(spark, f"{store}/metadata", METADATA).join(committed, "delivery", "left_semi").drop("delivery")
