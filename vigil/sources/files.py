"""File sources and sinks.

The raw store is JSON lines partitioned ``year=/month=``: a monthly load
overwrites only its own partition (dynamic partition overwrite), so a
re-delivered month replaces itself and a rerun is idempotent; readers filter
on the partition columns and Spark prunes the other folders before listing
their files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.session import materialize

PARTITIONS = ("year", "month")


def land_api_records(src: DataFrame, path: str, key: str = "folio") -> None:
    """Write records the way the open-data API delivers them
    (``{"recordid": .., "fields": {..}}``) under ``YEAR=/MONTH=`` folders."""
    fields = [c for c in src.columns]
    out = src.select(F.col(key).alias("recordid"), F.struct(*fields).alias("fields"),
                     F.col("ano").cast("int").alias("YEAR"), F.col("mes").cast("int").alias("MONTH"))
    spread_by_partition(out, ["YEAR", "MONTH"], F.col("recordid")) \
        .write.mode("overwrite").partitionBy("YEAR", "MONTH").json(path)


def read_api_records(spark: SparkSession, path: str, fields: T.StructType,
                     year: int | None = None, month: int | None = None) -> DataFrame:
    """Landing records with an explicit schema; year/month prune folders."""
    schema = T.StructType([T.StructField("recordid", T.StringType()),
                           T.StructField("fields", fields),
                           T.StructField("YEAR", T.IntegerType()),
                           T.StructField("MONTH", T.IntegerType())])
    df = spark.read.schema(schema).json(path)
    if year is not None:
        df = df.filter(F.col("YEAR") == year)
    if month is not None:
        df = df.filter(F.col("MONTH") == month)
    return df


def to_raw(records: DataFrame) -> DataFrame:
    """Keep only ``fields`` as the JSON document ``registros``."""
    return records.select(F.to_json(F.col("fields")).alias("registros"),
                          F.col("YEAR").alias("year"), F.col("MONTH").alias("month"))


def write_raw(raw: DataFrame, path: str, mode: str = "append") -> None:
    """Append (or, with mode='overwrite', replace only the partitions present
    in ``raw``: dynamic partition overwrite) JSON lines under year=/month=."""
    (spread_by_partition(raw.select("registros", *PARTITIONS), list(PARTITIONS),
                         F.xxhash64("registros")).write.mode(mode)
        .option("partitionOverwriteMode", "dynamic").partitionBy(*PARTITIONS).text(path))


def spread_by_partition(df: DataFrame, parts: list[str], tiebreak) -> DataFrame:
    """Range-partition on (partition columns, tie-break) before a
    partitioned write: each task holds a contiguous run of months, so a month
    is written as few files, and a hot month (a third of all rows) is split
    across several tasks by the tie-break instead of landing on one."""
    return df.repartitionByRange(*[F.col(c) for c in parts], tiebreak)


def read_raw(spark: SparkSession, path: str, year: int | None = None,
             month: int | None = None) -> DataFrame:
    df = spark.read.text(path).withColumnRenamed("value", "registros")
    if year is not None:
        df = df.filter(F.col("year") == year)
    if month is not None:
        df = df.filter(F.col("month") == month)
    return df


def write_tsv(df: DataFrame, path: str, header: bool = True) -> None:
    df.write.mode("overwrite").option("sep", "\t").option("header", header).csv(path)


def read_tsv(spark: SparkSession, path: str, schema: T.StructType, header: bool = True) -> DataFrame:
    """TSV with an explicit schema (with header=False columns bind by position)."""
    return spark.read.schema(schema).option("sep", "\t").option("header", header).csv(path)


def flatten_structs(df: DataFrame, sep: str = "_") -> DataFrame:
    """Recursively lift nested struct fields to top-level columns named
    ``parent<sep>child`` (arrays are kept as they are)."""
    def walk(dtype: T.StructType, prefix: list[str]):
        for f in dtype.fields:
            path = prefix + [f.name]
            if isinstance(f.dataType, T.StructType):
                yield from walk(f.dataType, path)
            else:
                yield F.col(".".join(f"`{p}`" for p in path)).alias(sep.join(path))
    return df.select(*walk(df.schema, []))


def add_page_numbers(df: DataFrame, key: str, page_size: int, out: str = "pagina") -> DataFrame:
    """Fixed-size pages in key order without a single-partition window:
    range-partition and sort by key, take each row's position inside its
    partition from ``monotonically_increasing_id``, add the row count of the
    preceding partitions (a table with one row per partition), then
    page = floor(index / page_size). Rows of one key are ordered by a hash of
    all columns, so that a key with many rows is several ranges. The numbered
    rows are written once, as two runs of a range shuffle need not cut alike."""
    ties = F.xxhash64(*df.columns)
    ordered = df.repartitionByRange(F.col(key), ties).sortWithinPartitions(F.col(key), ties)
    ided = ordered.withColumn("_id", F.monotonically_increasing_id())
    ided = ided.withColumn("_pid", F.shiftright(F.col("_id"), 33)) \
               .withColumn("_local", F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)))
    ided = materialize(ided, "numbered")
    from pyspark.sql import Window
    counts = ided.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.withColumn(
        "_offset", F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)))
    offsets = offsets.select("_pid", F.coalesce(F.col("_offset"), F.lit(0)).alias("_offset"))
    idx = F.col("_offset") + F.col("_local")
    return (ided.join(F.broadcast(offsets), "_pid")
                .withColumn(out, F.floor(idx / page_size).cast("int"))
                .drop("_id", "_pid", "_local", "_offset"))
