"""Registry of fitted models: an append-only table beside the model files.

Every row is an event of one model version: ``cv`` rows hold the settings tried
(fold scores, fit and score times), the ``best`` row the chosen setting, its precision on the
test rows and where the model lies, a ``current`` row marks the version that
scores from then on. Files are written before their row, so a row is a whole
model; a version is found by look-up, never by the name of a file.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.operators.lineage import RunInfo
from vigil.operators.models import best_model

FOLDS = 10
EVENTS = T.StructType([
    T.StructField("version", T.IntegerType()), T.StructField("event", T.StringType()),
    *[T.StructField(c, T.StringType()) for c in ("fecha_ejecucion", "ip_address", "usuario", "modelo", "params", "archivo_modelo",
                                                 "archivo_metadatos", "path")],
    *[T.StructField(c, T.DoubleType()) for c in (
        "mean_fit_time", "std_fit_time", "mean_score_time", "std_score_time", *(f"split{k}_test_score" for k in range(FOLDS)),
        "mean_test_score", "std_test_score", "precision")],
    T.StructField("rank_test_score", T.IntegerType())])


def events(spark: SparkSession, root: str) -> DataFrame:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/events")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], EVENTS)
    return spark.read.schema(EVENTS).parquet(f"{root}/events")


def _append(rows: DataFrame, root: str) -> None:
    """Adds event rows; columns that they lack are null."""
    given = set(rows.columns)
    rows.select(*[(F.col(f.name) if f.name in given else F.lit(None)).cast(f.dataType).alias(f.name) for f in EVENTS.fields]) \
        .coalesce(1).write.mode("append").parquet(f"{root}/events")


def new_version(spark: SparkSession, root: str) -> int:
    return (events(spark, root).agg(F.max("version")).first()[0] or 0) + 1


def record_cv(cv: DataFrame, root: str, version: int, run: RunInfo) -> None:
    """A row per setting of the grid, with the names of its files."""
    name = F.concat(F.col("modelo"), F.lit("/"), F.col("params"))
    _append(cv.select("*", F.lit(version).alias("version"), F.lit("cv").alias("event"), *run.columns(),
                      name.alias("archivo_modelo"), F.concat(F.lit("metadata/"), name).alias("archivo_metadatos")), root)


def chosen(spark: SparkSession, root: str, version: int) -> Row:
    """The best setting of a version's grid: highest mean score, ties by name."""
    return best_model(events(spark, root).where((F.col("event") == "cv") & (F.col("version") == version))).first()


def record_best(spark: SparkSession, root: str, version: int, setting: Row, precision: float, run: RunInfo,
                save: Callable[[str], None]) -> str:
    """Saves the fitted model by ``save(path)``, then records it; returns the path."""
    path = f"{root}/files/v{version:06d}"
    save(path)
    row = {"version": version, "event": "best", "fecha_ejecucion": run.fecha_ejecucion, "ip_address": run.ip_address,
           "usuario": run.usuario, "path": path, "precision": precision}
    row |= {c: setting[c] for c in ("modelo", "params", "archivo_modelo", "archivo_metadatos", "mean_test_score", "std_test_score")}
    schema = T.StructType([f for f in EVENTS.fields if f.name in row])
    _append(spark.createDataFrame([tuple(row[f.name] for f in schema.fields)], schema), root)
    return path


def promote(spark: SparkSession, root: str, version: int, run: RunInfo) -> None:
    """From now on ``version`` scores. An unrecorded version can't be promoted."""
    if events(spark, root).where((F.col("event") == "best") & (F.col("version") == version)).isEmpty():
        raise ValueError(f"version {version} has no model")
    _append(spark.createDataFrame([(version, "current", run.fecha_ejecucion, run.ip_address, run.usuario)],
                                  "version int, event string, fecha_ejecucion string, ip_address string, usuario string"), root)


def current(spark: SparkSession, root: str) -> Row:
    """The best-model row of the version promoted last: the highest version with
    a marker (a version is promoted after those before it)."""
    all_events = events(spark, root)
    marked = all_events.where(F.col("event") == "current").orderBy(F.desc("version")).limit(1).select("version")
    row = all_events.where(F.col("event") == "best").join(marked, "version").first()
    if row is None:
        raise LookupError("no current model")
    return row
