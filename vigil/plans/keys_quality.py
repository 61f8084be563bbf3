"""Query keys: data-quality checks (Q1-Q12), lineage rows (L1-L3) and the
calendar helpers (T1-T3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigil.catalog import MODEL_INPUT, table
from vigil.functions.temporal import closed_month, format_run_time, month_list
from vigil.operators import features as FE
from vigil.operators.clean import parse_documents, valid_time
from vigil.operators import lineage as L
from vigil.operators import quality as Q
from vigil.plans.frames import (clean_table, incident_source, new_predictions, newest_month, processed_table,
                                raw_documents, written_split)
from vigil.plans.present import round_cols, sround
from vigil.plans.registry import register
from vigil.plans.sql import with_clean, with_inc, with_proc, with_scored
from vigil.session import shared_dir
from vigil.sources import deliveries as DEL

# Execution fields of the registered runs (parameters of every lineage/DQ row).
RUN = L.RunInfo("02/12/2026 00:00:00", "127.0.0.1", "vigil")
PERIOD = ("1995-01-01", "2001-08-01")
LOWER_COLS = ("delegacion_inicio", "dia_semana", "tipo_entrada", "incidente_c4", "codigo_cierre")
ONEHOT_CATS = ("delegacion_inicio", "dia_semana", "tipo_entrada", "incidente_c4_rec")
RUN_SQL = f"'{RUN.fecha_ejecucion}' AS fecha_ejecucion, '{RUN.ip_address}' AS ip_address, " \
          f"'{RUN.usuario}' AS usuario"


def _lineage(spark, d):
    return L.lineage_raw(raw_documents(spark, d), RUN, "incidentes", "orders")


def _store(spark, d):
    """A raw store in which every month was delivered once and the newest closed
    month a second time, replacing its rows, with fewer records (those with a
    valid time): one month fails the checks. A third load of that month stopped
    before its manifest, so nobody sees it."""
    store, raw = shared_dir(spark, "raw-store"), raw_documents(spark, d)
    DEL.load(raw, store, "whole", RUN, "incidentes", "orders")
    again = DEL.read_rows(spark, store).filter(F.make_date("year", "month", F.lit(1)) == newest_month(spark, d)).filter(
        F.get_json_object("registros", "$.hora_creacion").contains(":"))
    DEL.load(again, store, "newest-again", RUN, "incidentes", "orders", mode="replace")
    DEL.stage(again, store, "stopped", RUN, "incidentes", "orders")
    return store


def _loaded(spark, d):
    """(metadata, rows) of ``_store`` as readers see it."""
    store = _store(spark, d)
    return DEL.read_metadata(spark, store), DEL.read_rows(spark, store)


LIN_CTE = f""", lin AS (
SELECT 'incidentes' AS dataset, 'UTC' AS timezone, cast(count(*) AS bigint) AS rows,
       cast(cast(ano AS integer) AS varchar) AS refine_ano, cast(cast(mes AS integer) AS varchar) AS refine_mes,
       'orders' AS parametro_url, {RUN_SQL},
       printf('%s_%04d_%02d.%s', 'incidentes', cast(ano AS integer), cast(mes AS integer), 'json') AS nombre_archivo,
       'json' AS formato_archivo
FROM inc GROUP BY cast(ano AS integer), cast(mes AS integer))"""

# metadata and store of ``_loaded``
LOADED_CTE = f"""{LIN_CTE},
again AS (SELECT * FROM inc WHERE make_date(cast(ano AS integer), cast(mes AS integer), 1)
          = (SELECT cast(date_trunc('month', max(o_orderdate)) - INTERVAL 1 MONTH AS date) FROM orders)),
loads AS (SELECT refine_ano, refine_mes, rows FROM lin UNION ALL
          SELECT ano, mes, count(*) FROM again WHERE contains(hora_creacion, ':') GROUP BY 1, 2),
store AS (SELECT ano, mes FROM inc WHERE folio NOT IN (SELECT folio FROM again WHERE NOT contains(hora_creacion, ':')))"""


@register("lineage_raw", with_inc(f"{LIN_CTE}\nSELECT * FROM lin"))
def q_lineage_raw(spark, d):
    return _lineage(spark, d)


@register("lineage_raw_quoted", with_inc(f"""{LIN_CTE}
SELECT * REPLACE ('"' || refine_ano || '"' AS refine_ano, '"' || refine_mes || '"' AS refine_mes,
                  '"' || parametro_url || '"' AS parametro_url) FROM lin"""))
def q_lineage_raw_quoted(spark, d):
    """Request parameters as JSON strings, for consumers of that layout."""
    return L.lineage_raw(raw_documents(spark, d), RUN, "incidentes", "orders", quoted=True)


@register("lineage_clean", with_clean(f"""
SELECT {RUN_SQL}, 'clean_incidents' AS id_tarea, 'completada' AS estatus_tarea,
       printf('Deleted %d rows', (SELECT count(*) FROM inc) - (SELECT count(*) FROM clean)) AS registros_eliminados,
       cast((SELECT count(*) FROM inc) - (SELECT count(*) FROM clean) AS bigint) AS n_eliminados"""))
def q_lineage_clean(spark, d):
    return L.lineage_clean(parse_documents(raw_documents(spark, d)), valid_time(), RUN, "clean_incidents")


@register("month_spine", """
SELECT cast(unnest(generate_series(date_trunc('month', min(o_orderdate))::date,
                                   date_trunc('month', max(o_orderdate))::date,
                                   INTERVAL 1 MONTH)) AS date) AS mes FROM orders""")
def q_month_spine(spark, d):
    bounds = table(spark, d, "orders").agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b"))
    return bounds.select(F.explode(month_list(F.to_date("a"), F.to_date("b"))).alias("mes"))


@register("closed_month", """
SELECT o_orderkey, cast(o_orderdate AS date) AS fecha,
       cast(date_trunc('month', cast(o_orderdate AS date) + CASE WHEN day(o_orderdate) > 15
            THEN INTERVAL '-1 month' ELSE INTERVAL '-2 month' END) AS date) AS mes_cerrado,
       strftime(o_orderdate, '%d/%m/%Y %H:%M:%S') AS fecha_texto
FROM orders""")
def q_closed_month(spark, d):
    o = table(spark, d, "orders")
    return o.select("o_orderkey", F.to_date("o_orderdate").alias("fecha"),
                    closed_month(F.to_date("o_orderdate")).alias("mes_cerrado"),
                    format_run_time("o_orderdate").alias("fecha_texto"))


@register("dq_month_coverage", with_inc(f"""{LOADED_CTE},
spine AS (SELECT cast(unnest(generate_series(DATE '{PERIOD[0]}', DATE '{PERIOD[1]}', INTERVAL 1 MONTH)) AS date) AS m),
loaded AS (SELECT DISTINCT make_date(cast(refine_ano AS integer), cast(refine_mes AS integer), 1) AS m FROM loads),
s AS (SELECT (SELECT count(*) FROM spine) AS n_esperados, (SELECT count(*) FROM loaded) AS n_cargados,
             (SELECT count(*) FROM spine WHERE m NOT IN (SELECT m FROM loaded)) AS n_faltantes)
SELECT 'month_coverage' AS test,
       CASE WHEN n_faltantes = 0 AND n_esperados = n_cargados THEN 'passed' ELSE 'failed' END AS test_status,
       'extract' AS level,
       CASE WHEN n_faltantes = 0 AND n_esperados = n_cargados THEN NULL
            ELSE 'months in the period and months loaded differ' END AS error,
       n_esperados, n_cargados, n_faltantes FROM s"""))
def q_dq_month_coverage(spark, d):
    return Q.dq_month_coverage(_loaded(spark, d)[0], *PERIOD)


@register("atomic_load", with_inc(f"""{LOADED_CTE},
v AS (SELECT cast(ano AS integer) AS year, cast(mes AS integer) AS month, count(*) AS n_visibles FROM store GROUP BY 1, 2)
SELECT v.*, (SELECT cast(sum(rows) AS bigint) FROM loads
             WHERE cast(refine_ano AS integer) = v.year AND cast(refine_mes AS integer) = v.month) AS n_declarados,
       (SELECT count(*) FROM loads
        WHERE cast(refine_ano AS integer) = v.year AND cast(refine_mes AS integer) = v.month) AS n_entregas FROM v"""))
def q_atomic_load(spark, d):
    """What readers see of the months after two loads and a stopped one."""
    metadata, rows = _loaded(spark, d)
    declared = metadata.groupBy(F.col("refine_ano").cast("int").alias("year"), F.col("refine_mes").cast("int").alias("month")).agg(
        F.sum("rows").alias("n_declarados"), F.count(F.lit(1)).alias("n_entregas"))
    return rows.groupBy("year", "month").agg(F.count(F.lit(1)).alias("n_visibles")).join(declared, ["year", "month"], "left")


@register("dq_month_once", with_inc(f"""{LOADED_CTE}
SELECT refine_ano, refine_mes, count(*) AS n_cargas, 'month_loaded_once' AS test,
       CASE WHEN count(*) = 1 THEN 'passed' ELSE 'failed' END AS test_status, 'extract' AS level,
       CASE WHEN count(*) = 1 THEN NULL ELSE 'month loaded more than once' END AS error
FROM loads GROUP BY 1, 2"""))
def q_dq_month_once(spark, d):
    return Q.dq_month_once(_loaded(spark, d)[0])


@register("dq_row_count", with_inc(f"""{LOADED_CTE},
s AS (SELECT (SELECT cast(sum(rows) AS bigint) FROM loads) AS n_declarados, (SELECT count(*) FROM store) AS n_almacenados)
SELECT 'row_count' AS test, CASE WHEN n_declarados = n_almacenados THEN 'passed' ELSE 'failed' END AS test_status,
       'extract' AS level,
       CASE WHEN n_declarados = n_almacenados THEN NULL ELSE 'rows extracted and rows loaded differ' END AS error,
       n_declarados, n_almacenados FROM s"""))
def q_dq_row_count(spark, d):
    return Q.dq_row_count(*_loaded(spark, d))


def _lower_sql(c):
    ok = f"coalesce(bool_and({c} = lower({c}) AND regexp_matches({c}, '\\p{{L}}')), true)"
    return (f"SELECT '{c}' AS columna, 'lowercase' AS test, CASE WHEN {ok} THEN 'passed' ELSE 'failed' END "
            f"AS test_status, 'clean' AS level, CASE WHEN {ok} THEN NULL ELSE 'value not in lower case' END "
            f"AS error, count(*) FILTER (WHERE {c} IS NULL) AS n_nulos FROM clean")


@register("dq_lowercase", with_clean("\nUNION ALL\n".join(_lower_sql(c) for c in LOWER_COLS)))
def q_dq_lowercase(spark, d):
    return Q.dq_lowercase(clean_table(spark, d), LOWER_COLS)


@register("dq_cardinality", with_proc("""
SELECT 'cardinality_incidente_c4_rec' AS test,
       CASE WHEN count(DISTINCT incidente_c4_rec) = 5 THEN 'passed' ELSE 'failed' END AS test_status,
       'features' AS level,
       CASE WHEN count(DISTINCT incidente_c4_rec) = 5 THEN NULL
            ELSE 'incidente_c4_rec does not have 5 categories' END AS error,
       count(DISTINCT incidente_c4_rec) AS n_distintos FROM proc"""))
def q_dq_cardinality(spark, d):
    return Q.dq_cardinality(processed_table(spark, d), "incidente_c4_rec", 5)


def _imputed_train(spark, d, split=None):
    split = split if split is not None else written_split(spark, d)
    train = split.filter(F.col("conjunto") == "train").select(*MODEL_INPUT)
    modes = FE.fit_modes(train, ["delegacion_inicio"])
    return FE.fill_with(train, modes, ["delegacion_inicio"])


IMPUTED_TRAIN = """
, tr AS (SELECT * FROM split WHERE conjunto = 'train'),
md AS (SELECT delegacion_inicio AS moda FROM tr WHERE delegacion_inicio IS NOT NULL
       GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
it AS (SELECT coalesce(delegacion_inicio, (SELECT moda FROM md)) AS delegacion_inicio, mes, dia_semana,
              hora, tipo_entrada, incidente_c4_rec, target FROM tr)"""


@register("dq_nulls", with_scored(IMPUTED_TRAIN + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS columna, 'no_nulls' AS test, CASE WHEN count(*) FILTER (WHERE {c} IS NULL) = 0 "
    f"THEN 'passed' ELSE 'failed' END AS test_status, 'features' AS level, "
    f"CASE WHEN count(*) FILTER (WHERE {c} IS NULL) = 0 THEN NULL ELSE 'column has nulls' END AS error, "
    f"count(*) FILTER (WHERE {c} IS NULL) AS n_nulos FROM it" for c in MODEL_INPUT)))
def q_dq_nulls(spark, d):
    return Q.dq_nulls(_imputed_train(spark, d))


_ONEHOT_CTE = """
w AS (SELECT 2 + """ + " + ".join(f"count(DISTINCT {c})" for c in ONEHOT_CATS) + """ AS n FROM it),
g AS (SELECT 2 + (SELECT count(*) FROM (""" + " UNION ALL ".join(
    f"(SELECT DISTINCT '{c}' AS variable, {c} AS level FROM it WHERE {c} IS NOT NULL)" for c in ONEHOT_CATS) + """)) AS generated)"""


@register("dq_onehot_width", with_scored(f"""{IMPUTED_TRAIN},{_ONEHOT_CTE}
SELECT 'onehot_width' AS test, CASE WHEN n = generated THEN 'passed' ELSE 'failed' END AS test_status, 'features' AS level,
       CASE WHEN n = generated THEN NULL ELSE 'one-hot width differs from the category count' END AS error,
       cast(n AS bigint) AS n_esperadas, cast(generated AS bigint) AS n_generadas FROM w, g"""))
def q_dq_onehot_width(spark, d):
    train = _imputed_train(spark, d)
    vocab = FE.fit_one_hot(train, ONEHOT_CATS)
    encoded = FE.one_hot(train, vocab, keep=["mes", "hora"])
    return Q.dq_onehot_width(train, ["mes", "hora"], ONEHOT_CATS, len(encoded.columns))


_DRIFT = """
s AS (SELECT (SELECT avg(y_etiqueta) * 100 FROM live) AS pct_nuevos,
             (SELECT avg(target) * 100 FROM split WHERE conjunto = 'train') AS pct_historicos),
r AS (SELECT *, coalesce(pct_nuevos BETWEEN pct_historicos * 0.8 AND pct_historicos * 1.2, false) AS ok FROM s)"""


@register("dq_label_drift", with_scored(f""",{_DRIFT}
SELECT 'label_drift' AS test, CASE WHEN ok THEN 'passed' ELSE 'failed' END AS test_status,
       'predict' AS level, CASE WHEN ok THEN NULL ELSE 'share of positive predictions far from history' END AS error,
       {sround("pct_nuevos")} AS pct_nuevos, {sround("pct_historicos")} AS pct_historicos FROM r"""))
def q_dq_label_drift(spark, d):
    split = written_split(spark, d)
    out = Q.dq_label_drift(new_predictions(spark, d, split), split.filter(F.col("conjunto") == "train"))
    return round_cols(out, ["pct_nuevos", "pct_historicos"])


def _result_sql(test, level, ok, error, detail="NULL", frm=""):
    """One check's result rows in SQL."""
    return (f"SELECT {RUN_SQL}, '{test}' AS test, CASE WHEN {ok} THEN 'passed' ELSE 'failed' END AS test_status, '{level}' AS level, "
            f"CASE WHEN {ok} THEN NULL ELSE '{error}' END AS error, cast({detail} AS varchar) AS detalle {frm}")


def _lower_ok(c):
    return f"(SELECT coalesce(bool_and({c} = lower({c}) AND regexp_matches({c}, '\\p{{L}}')), true) FROM clean)"


_MONTHS_LOADED = "SELECT cast(refine_ano AS integer) AS y, cast(refine_mes AS integer) AS m, rows FROM loads"
_REPORT_SQL = [
    _result_sql("month_coverage", "extract", f"""NOT EXISTS (
      (SELECT cast(unnest(generate_series(DATE '{PERIOD[0]}', DATE '{PERIOD[1]}', INTERVAL 1 MONTH)) AS date) EXCEPT SELECT make_date(y, m, 1) FROM ml)
      UNION ALL
      (SELECT make_date(y, m, 1) FROM ml EXCEPT SELECT cast(unnest(generate_series(DATE '{PERIOD[0]}', DATE '{PERIOD[1]}', INTERVAL 1 MONTH)) AS date)))""",
                "months in the period and months loaded differ"),
    _result_sql("month_loaded_once", "extract", "count(*) = 1", "month loaded more than once", "printf('%04d-%02d', y, m)",
                "FROM ml GROUP BY y, m"),
    _result_sql("row_count", "extract", "(SELECT sum(rows) FROM ml) = (SELECT count(*) FROM store)", "rows extracted and rows loaded differ"),
    _result_sql("row_count_month", "extract", "coalesce(a.n = b.n, false)", "rows extracted and rows loaded differ",
                "printf('%04d-%02d', coalesce(a.y, b.y), coalesce(a.m, b.m))",
                "FROM (SELECT y, m, sum(rows) AS n FROM ml GROUP BY 1, 2) a FULL JOIN (SELECT cast(ano AS integer) AS y, "
                "cast(mes AS integer) AS m, count(*) AS n FROM store GROUP BY 1, 2) b ON a.y = b.y AND a.m = b.m"),
    *[_result_sql("lowercase", "clean", _lower_ok(c), "value not in lower case", f"'{c}'") for c in LOWER_COLS],
    _result_sql("hour_strict", "clean", "false", "check could not run: CAST_INVALID_INPUT"),
    _result_sql("cardinality_incidente_c4_rec", "features", "(SELECT count(DISTINCT incidente_c4_rec) FROM model) = 5",
                "incidente_c4_rec does not have 5 categories"),
    *[_result_sql("no_nulls", "features", f"(SELECT count(*) FROM it WHERE {c} IS NULL) = 0", "column has nulls", f"'{c}'") for c in MODEL_INPUT],
    _result_sql("onehot_width", "features", "(SELECT n FROM w) = (SELECT generated FROM g)", "one-hot width differs from the category count"),
    _result_sql("label_drift", "predict", "(SELECT ok FROM r)", "share of positive predictions far from history"),
]


@register("dq_report", with_scored(f"""{LOADED_CTE}{IMPUTED_TRAIN},
ml AS ({_MONTHS_LOADED}),{_ONEHOT_CTE},{_DRIFT}
""" + "\nUNION ALL\n".join(_REPORT_SQL)))
def q_dq_report(spark, d):
    """Every check that reads rows, each by itself. One month fails those of the
    load, and ``hour_strict`` breaks while it runs: a strict cast of hours, which
    some records write with a point."""
    loaded = Q.Once(lambda: _loaded(spark, d))
    split = Q.Once(lambda: written_split(spark, d))
    clean = Q.Once(lambda: Q.counted_once(clean_table(spark, d), "dq-clean", lower=LOWER_COLS)[1])
    train = Q.Once(lambda: Q.counted_once(_imputed_train(spark, d, split()), "dq-train", nulls=MODEL_INPUT))
    month = lambda y, m: F.format_string("%04d-%02d", F.col(y).cast("int"), F.col(m).cast("int"))

    def hour_strict():
        hour = F.substring_index("hora_creacion", ":", 1).cast("int")
        return Q.dq_true(incident_source(spark, d), hour.between(0, 23), "hour_strict", "clean", "hour outside the day")

    def onehot_width():
        vocab = FE.fit_one_hot(train()[0], ONEHOT_CATS)
        return Q.dq_onehot_width(train()[0], ["mes", "hora"], ONEHOT_CATS, 2 + sum(map(len, vocab.values())))

    checks = [
        ("month_coverage", "extract", lambda: Q.dq_month_coverage(loaded()[0], *PERIOD)),
        ("month_loaded_once", "extract", lambda: Q.dq_month_once(loaded()[0]).withColumn("detalle", month("refine_ano", "refine_mes"))),
        ("row_count", "extract", lambda: Q.dq_row_count(*loaded())),
        ("row_count_month", "extract", lambda: Q.dq_row_count_by_month(*loaded()).withColumn("detalle", month("ano", "mes"))),
        ("lowercase", "clean", lambda: Q.counted_checks(spark, clean(), "not_lower", "lowercase", "clean", "value not in lower case")),
        ("hour_strict", "clean", hour_strict),
        ("cardinality_incidente_c4_rec", "features", lambda: Q.dq_cardinality(split(), "incidente_c4_rec", 5)),
        ("no_nulls", "features", lambda: Q.counted_checks(spark, train()[1], "nulls", "no_nulls", "features", "column has nulls")),
        ("onehot_width", "features", onehot_width),
        ("label_drift", "predict", lambda: Q.dq_label_drift(new_predictions(spark, d, split()), train()[0])),
    ]
    return Q.run_checks(spark, checks, RUN)


@register("dq_row_count_month", with_inc(f"""{LOADED_CTE},
dcl AS (SELECT cast(refine_ano AS integer) AS y, cast(refine_mes AS integer) AS m,
               cast(sum(rows) AS bigint) AS n_declarados FROM loads GROUP BY 1, 2),
sto AS (SELECT cast(ano AS integer) AS y, cast(mes AS integer) AS m, count(*) AS n_almacenados
        FROM store GROUP BY 1, 2)
SELECT coalesce(dcl.y, sto.y) AS ano, coalesce(dcl.m, sto.m) AS mes, 'row_count_month' AS test,
       CASE WHEN coalesce(n_declarados = n_almacenados, false) THEN 'passed' ELSE 'failed' END AS test_status,
       'extract' AS level,
       CASE WHEN coalesce(n_declarados = n_almacenados, false) THEN NULL
            ELSE 'rows extracted and rows loaded differ' END AS error,
       n_declarados, n_almacenados
FROM dcl FULL OUTER JOIN sto ON dcl.y = sto.y AND dcl.m = sto.m"""))
def q_dq_row_count_month(spark, d):
    return Q.dq_row_count_by_month(*_loaded(spark, d))
