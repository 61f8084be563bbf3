"""Data-quality checks as DataFrame operators. Each returns result rows
(test, test_status, level, error) plus the measured values; ``run_checks``
runs each by itself and ``dq_report`` unions them. The report never raises;
``raise_on_failure`` is the strict mode."""

from __future__ import annotations

import threading
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.functions.temporal import month_list
from vigil.operators.lineage import RunInfo
from vigil.session import materialize

RESULT_COLS = ("test", "test_status", "level", "error")


def _status(passed: Column, test: str, level: str, error: str) -> list[Column]:
    return [F.lit(test).alias("test"),
            F.when(passed, F.lit("passed")).otherwise(F.lit("failed")).alias("test_status"),
            F.lit(level).alias("level"),
            F.when(passed, F.lit(None).cast("string")).otherwise(F.lit(error)).alias("error")]


def dq_month_coverage(lineage: DataFrame, start: str, end: str, level: str = "extract") -> DataFrame:
    """Every month of [start, end] has a raw lineage row (spine anti-join), and
    no other month has; a month loaded twice counts once (``dq_month_once``)."""
    spark = lineage.sparkSession
    spine = spark.range(1).select(F.explode(month_list(F.lit(start).cast("date"),
                                                       F.lit(end).cast("date"))).alias("m"))
    loaded = lineage.select(F.make_date(F.col("refine_ano").cast("int"),
                                        F.col("refine_mes").cast("int"), F.lit(1)).alias("m")).distinct()
    missing = spine.join(loaded, "m", "left_anti")
    stats = spine.agg(F.count(F.lit(1)).alias("n_esperados")).select(
        "n_esperados", loaded.agg(F.count(F.lit(1))).scalar().alias("n_cargados"),
        missing.agg(F.count(F.lit(1))).scalar().alias("n_faltantes"))
    ok = (F.col("n_faltantes") == 0) & (F.col("n_esperados") == F.col("n_cargados"))
    return stats.select(*_status(ok, "month_coverage", level,
                                 "months in the period and months loaded differ"),
                        "n_esperados", "n_cargados", "n_faltantes")


def dq_month_once(lineage: DataFrame, level: str = "extract") -> DataFrame:
    """Each loaded month has exactly one lineage row."""
    per = lineage.groupBy("refine_ano", "refine_mes").agg(F.count(F.lit(1)).alias("n_cargas"))
    return per.select("refine_ano", "refine_mes", "n_cargas",
                      *_status(F.col("n_cargas") == 1, "month_loaded_once", level,
                               "month loaded more than once"))


def dq_row_count(lineage: DataFrame, raw: DataFrame, level: str = "extract") -> DataFrame:
    """Control total: rows declared by the lineage = rows stored."""
    stats = lineage.agg(F.sum("rows").cast("bigint").alias("n_declarados")).select(
        "n_declarados", raw.agg(F.count(F.lit(1))).scalar().alias("n_almacenados"))
    ok = F.col("n_declarados") == F.col("n_almacenados")
    return stats.select(*_status(ok, "row_count", level, "rows extracted and rows loaded differ"),
                        "n_declarados", "n_almacenados")


def dq_row_count_by_month(lineage: DataFrame, raw: DataFrame, year: str = "year",
                          month: str = "month", level: str = "extract") -> DataFrame:
    """Control totals per month: declared rows (lineage) against stored rows,
    a full outer join of two per-month aggregates, so a month present on one
    side only shows up as a failure."""
    declared = lineage.groupBy(F.col("refine_ano").cast("int").alias("y"),
                               F.col("refine_mes").cast("int").alias("m")).agg(
        F.sum("rows").cast("bigint").alias("n_declarados"))
    stored = raw.groupBy(F.col(year).cast("int").alias("y"), F.col(month).cast("int").alias("m")).agg(
        F.count(F.lit(1)).alias("n_almacenados"))
    both = declared.join(stored, ["y", "m"], "full_outer")
    ok = F.coalesce(F.col("n_declarados") == F.col("n_almacenados"), F.lit(False))
    return both.select(F.col("y").alias("ano"), F.col("m").alias("mes"),
                       *_status(ok, "row_count_month", level, "rows extracted and rows loaded differ"),
                       "n_declarados", "n_almacenados")


def dq_lowercase(df: DataFrame, cols: Sequence[str], level: str = "clean") -> DataFrame:
    """Every non-null value is lower case and has a letter; nulls counted."""
    aggs = []
    for c in cols:
        ok = (F.col(c) == F.lower(F.col(c))) & F.col(c).rlike(r"\p{L}")
        aggs += [F.bool_and(ok).alias(f"{c}__ok"), F.count_if(F.col(c).isNull()).alias(f"{c}__nulls")]
    wide = df.agg(*aggs)
    structs = [F.struct(F.lit(c).alias("columna"), F.coalesce(F.col(f"{c}__ok"), F.lit(True)).alias("ok"),
                        F.col(f"{c}__nulls").alias("n_nulos")) for c in cols]
    return (wide.select(F.inline(F.array(*structs)))
                .select("columna", *_status(F.col("ok"), "lowercase", level, "value not in lower case"),
                        "n_nulos"))


def dq_types(df: DataFrame, expected: T.StructType, level: str = "clean") -> DataFrame:
    """Schema compare: each expected column present with the expected type."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = [(f.name, f.dataType.simpleString(), actual.get(f.name)) for f in expected.fields]
    spark = df.sparkSession
    out = spark.createDataFrame(rows, "columna string, esperado string, actual string")
    return out.select("columna", *_status(F.col("actual").eqNullSafe(F.col("esperado")), "types",
                                          level, "unexpected column type"), "esperado", "actual")


def dq_column_count(before: DataFrame, after: DataFrame, added: int, level: str = "predict") -> DataFrame:
    spark = before.sparkSession
    out = spark.createDataFrame([(len(before.columns), len(after.columns))],
                                "n_inicial int, n_final int")
    ok = F.col("n_final") == F.col("n_inicial") + added
    return out.select(*_status(ok, "column_count", level, "unexpected number of columns"),
                      "n_inicial", "n_final")


def dq_true(df: DataFrame, condition: Column, test: str, level: str, error: str) -> DataFrame:
    """Every row meets a condition (nulls count as met)."""
    stats = df.agg(F.coalesce(F.bool_and(condition), F.lit(True)).alias("ok"))
    return stats.select(*_status(F.col("ok"), test, level, error))


def dq_cardinality(df: DataFrame, col: str, expected: int, level: str = "features") -> DataFrame:
    stats = df.agg(F.count_distinct(F.col(col)).alias("n_distintos"))
    return stats.select(*_status(F.col("n_distintos") == expected, f"cardinality_{col}", level,
                                 f"{col} does not have {expected} categories"), "n_distintos")


def dq_nulls(df: DataFrame, cols: Sequence[str] | None = None, level: str = "features") -> DataFrame:
    """Per column: zero nulls (one aggregation over all columns)."""
    cols = list(cols or df.columns)
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    structs = [F.struct(F.lit(c).alias("columna"), F.col(f"`{c}`").alias("n_nulos")) for c in cols]
    return (wide.select(F.inline(F.array(*structs)))
                .select("columna", *_status(F.col("n_nulos") == 0, "no_nulls", level, "column has nulls"),
                        "n_nulos"))


def dq_onehot_width(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                    width: int, level: str = "features") -> DataFrame:
    """numeric columns + sum of category counts = width of the encoded frame."""
    expected = F.lit(len(numeric))
    for c in categorical:
        expected = expected + F.count_distinct(F.col(c))
    stats = df.agg(expected.cast("bigint").alias("n_esperadas")).withColumn(
        "n_generadas", F.lit(width).cast("bigint"))
    return stats.select(*_status(F.col("n_esperadas") == F.col("n_generadas"), "onehot_width", level,
                                 "one-hot width differs from the category count"),
                        "n_esperadas", "n_generadas")


def dq_label_drift(new: DataFrame, history: DataFrame, new_col: str = "y_etiqueta",
                   hist_col: str = "target", tolerance: float = 0.2,
                   level: str = "predict") -> DataFrame:
    """Share of positives in the new predictions within +-tolerance of the
    historical share (two one-row averages)."""
    stats = new.agg((F.avg(F.col(new_col)) * 100).alias("pct_nuevos")).select(
        "pct_nuevos", history.agg(F.avg(F.col(hist_col)) * 100).scalar().alias("pct_historicos"))
    ok = F.col("pct_nuevos").between(F.col("pct_historicos") * (1 - tolerance),
                                     F.col("pct_historicos") * (1 + tolerance))
    return stats.select(*_status(F.coalesce(ok, F.lit(False)), "label_drift", level,
                                 "share of positive predictions far from history"),
                        "pct_nuevos", "pct_historicos")


def counted_once(df: DataFrame, name: str, lower: Sequence[str] = (), nulls: Sequence[str] = ()) -> tuple[DataFrame, dict]:
    """``df`` written once to the shared folder, and the numbers of one pass over
    it: rows, and per column the values that are not lower case (or have no
    letter) and the nulls. Every check of these reads the numbers, none the table."""
    written = materialize(df, name)
    bad = lambda c: ~((F.col(c) == F.lower(F.col(c))) & F.col(c).rlike(r"\p{L}"))
    row = written.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(bad(c)).alias(f"not_lower.{c}") for c in lower],
                      *[F.count_if(F.col(c).isNull()).alias(f"nulls.{c}") for c in dict.fromkeys([*lower, *nulls])]).first()
    return written, row.asDict()


def counted_checks(spark: SparkSession, metrics: dict, kind: str, test: str, level: str, error: str) -> DataFrame:
    """A result row per column from the numbers of ``counted_once``."""
    rows = [(c.split(".", 1)[1], int(n)) for c, n in metrics.items() if c.startswith(f"{kind}.")]
    return spark.createDataFrame(rows, "detalle string, n long").select(
        *_status(F.col("n") == 0, test, level, error), "detalle")


class Once:
    """What several checks share, made by the first that asks for it."""

    def __init__(self, make: Callable):
        self.make, self.lock, self.held = make, threading.Lock(), []

    def __call__(self):
        with self.lock:
            if not self.held:
                self.held.append(self.make())
            return self.held[0]


def run_checks(spark: SparkSession, checks: Sequence[tuple[str, str, Callable[[], DataFrame]]], run: RunInfo) -> DataFrame:
    """Every check by itself: (test, level, function returning its result rows).

    A check is one job whose rows are written to the shared folder; one that
    breaks, while it is planned or while it runs, becomes a ``failed`` row with
    its error and the others go on. ``detalle`` names the column or month of a
    result row."""
    def one(named: tuple[str, str, Callable[[], DataFrame]]) -> DataFrame:
        test, level, check = named
        try:
            result = check()
            detail = F.col("detalle") if "detalle" in result.columns else F.lit(None)
            return materialize(result.select(*RESULT_COLS, detail.cast("string").alias("detalle")), f"check-{test}")
        except Exception as e:  # noqa: BLE001  the report must go on
            kind = getattr(e, "getCondition", lambda: None)() or type(e).__name__
            return spark.createDataFrame([(test, "failed", level, f"check could not run: {kind}", None)],
                                         "test string, test_status string, level string, error string, detalle string")

    with ThreadPoolExecutor(max_workers=4) as pool:          # small jobs, side by side
        return dq_report(list(pool.map(one, checks)), run, "detalle")


def dq_report(checks: Sequence[DataFrame], run: RunInfo, *more: str) -> DataFrame:
    """All results in the DQ table layout (execution fields, test, status,
    level, error)."""
    parts = [c.select(*run.columns(), *RESULT_COLS, *more) for c in checks]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def raise_on_failure(report: DataFrame) -> None:
    """Raise if a check failed, with the number of failures of every check
    (one row per kind of check reaches the driver); ``report`` has the details."""
    failed = (report.filter(F.col("test_status") == "failed").groupBy("test")
              .agg(F.count(F.lit(1)).alias("n"), F.min("error").alias("error")).collect())
    if failed:
        raise AssertionError(f"{sum(r.n for r in failed)} data-quality checks failed: " + "; ".join(
            f"{r.test} ({r.n}): {r.error}" for r in sorted(failed, key=lambda r: r.test)))
