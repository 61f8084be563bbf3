"""Query keys: profiles and grouped summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigil.catalog import table
from vigil.operators import cube as CU
from vigil.operators import profile as P
from vigil.operators import serving as S
from vigil.operators import sketches as SK
from vigil.plans.frames import (both_predictions, clean_table, historic_predictions,
                                new_predictions, processed_table)
from vigil.plans.present import round_cols, sround, sstd, zero_noise
from vigil.plans.registry import register
from vigil.plans.sql import with_clean, with_model, with_proc, with_scored
from vigil.session import materialize, shared_dir

# The numeric columns of lineitem, for the SQL only: the queries take them by type.
LINE_NUM = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
CLEAN_TEXT = ("folio", "hora_creacion", "delegacion_inicio", "dia_semana", "tipo_entrada",
              "incidente_c4", "codigo_cierre")
# Weekday order of the ordered-means chart (fixed values).
WEEK_ORDER = ("lunes", "martes", "miercoles", "jueves", "viernes", "sabado", "domingo")
ORIGINS = ("Historicos", "Nuevos")


def _round(df, cols):
    return round_cols(df, cols)


def _num_sql(c):
    x = f"cast({c} AS double)"
    return (f"SELECT '{c}' AS variable, {sround(f"max({x})")} AS max, {sround(f"min({x})")} AS min, "
            f"{sround(f"avg({x})")} AS mean, {sstd(f"stddev_samp({x})", f"avg({x})")} AS std, "
            f"{sround(f"quantile_cont({x}, 0.25)")} AS q25, {sround(f"quantile_cont({x}, 0.5)")} AS median, "
            f"{sround(f"quantile_cont({x}, 0.75)")} AS q75, {sround(f"skewness({x})")} AS skew, "
            f"{sround(f"kurtosis({x})")} AS kurt, count({x}) AS count, count(DISTINCT {x}) AS uniques, "
            f"count(*) - count({x}) AS missings, "
            f"{sround(f"(count(*) - count({x}))::double / count(*) * 100")} AS prop_missings FROM lineitem")


NUM_STATS = ("max", "min", "mean", "std", "q25", "median", "q75", "skew", "kurt", "prop_missings")


@register("describe_numeric", "\nUNION ALL\n".join(_num_sql(c) for c in LINE_NUM))
def q_describe_numeric(spark, d):
    li = table(spark, d, "lineitem", spread=True)
    return _round(zero_noise(P.describe_numeric(li), "std", "mean"), NUM_STATS)


def _cat_sql(c):
    return (f"SELECT '{c}' AS variable, count({c}) AS count, count(DISTINCT {c}) AS uniques, "
            f"count(*) - count({c}) AS missings, "
            f"{sround(f"(count(*) - count({c}))::double / count(*) * 100")} AS prop_missings FROM clean")


@register("describe_categorical", with_clean("\nUNION ALL\n".join(_cat_sql(c) for c in CLEAN_TEXT)))
def q_describe_categorical(spark, d):
    return _round(P.describe_categorical(clean_table(spark, d)), ("prop_missings",))


@register("distinct_values", with_clean("\nUNION\n".join(
    f"SELECT '{c}' AS variable, {c} AS value FROM clean WHERE {c} IS NOT NULL"
    for c in CLEAN_TEXT)))
def q_distinct_values(spark, d):
    clean = clean_table(spark, d)
    return P.distinct_values(clean, P.string_columns(clean))


@register("category_counts", with_proc("""
SELECT delegacion_inicio, count(folio) AS n FROM proc
WHERE delegacion_inicio IS NOT NULL GROUP BY 1"""))
def q_category_counts(spark, d):
    return P.category_counts(processed_table(spark, d), "delegacion_inicio", "folio")


@register("category_means", with_proc(f"""
SELECT tipo_entrada, {sround("avg(target)")} AS mean_target FROM proc
WHERE tipo_entrada IS NOT NULL GROUP BY 1"""))
def q_category_means(spark, d):
    return _round(P.category_means(processed_table(spark, d), "tipo_entrada", "target"),
                  ("mean_target",))


@register("topn_ranking", with_proc(f"""
SELECT delegacion_inicio, dia_semana, {sround("avg(target)")} AS mean_target FROM proc
WHERE delegacion_inicio IS NOT NULL AND dia_semana IS NOT NULL
GROUP BY 1, 2 ORDER BY avg(target) DESC, 1, 2 LIMIT 10"""))
def q_topn_ranking(spark, d):
    return _round(P.topn_ranking(processed_table(spark, d), 10, "delegacion_inicio", "dia_semana",
                                 "target"), ("mean_target",))


@register("ordered_means", with_proc(f"""
SELECT cast(list_position({list(WEEK_ORDER)}, dia_semana) AS integer) AS posicion, dia_semana,
       {sround("avg(target)")} AS mean_target
FROM proc WHERE list_position({list(WEEK_ORDER)}, dia_semana) > 0 GROUP BY 1, 2"""))
def q_ordered_means(spark, d):
    return _round(P.ordered_means(processed_table(spark, d), "dia_semana", "target", WEEK_ORDER),
                  ("mean_target",))


def _corr_sql():
    parts = []
    for a in LINE_NUM:
        for b in LINE_NUM:
            expr = f"corr(cast({a} AS double), cast({b} AS double))"
            parts.append(f"SELECT '{a}' AS var1, '{b}' AS var2, {sround(expr)} AS corr FROM lineitem")
    return "\nUNION ALL\n".join(parts)


@register("correlation_matrix", _corr_sql())
def q_correlation_matrix(spark, d):
    return _round(P.correlation_matrix(table(spark, d, "lineitem", spread=True)), ("corr",))


@register("counts_by_target", with_proc(
    "SELECT delegacion_inicio, target, count(*) AS n FROM proc GROUP BY 1, 2"))
def q_counts_by_target(spark, d):
    return P.grouped_counts(processed_table(spark, d), ["delegacion_inicio", "target"])


@register("counts_by_hour", with_proc("SELECT hora, count(*) AS n FROM proc GROUP BY 1"))
def q_counts_by_hour(spark, d):
    return P.grouped_counts(processed_table(spark, d), ["hora"])


@register("rate_by_channel", with_proc(f"""
SELECT tipo_entrada, cast(sum(target) AS bigint) AS positivos, cast(sum(1 - target) AS bigint) AS negativos,
       {sround("avg(target)")} AS tasa_positivos FROM proc GROUP BY 1"""))
def q_rate_by_channel(spark, d):
    return _round(P.rate_by(processed_table(spark, d), "tipo_entrada"), ("tasa_positivos",))


@register("counts_by_weekday", with_proc("SELECT dia_semana, count(*) AS n FROM proc GROUP BY 1"))
def q_counts_by_weekday(spark, d):
    return P.grouped_counts(processed_table(spark, d), ["dia_semana"])


@register("trend_by_code", with_proc("""
SELECT make_date(ano, mes, 1) AS periodo, clave, count(*) AS n FROM proc GROUP BY 1, 2"""))
def q_trend_by_code(spark, d):
    return P.trend_by_code(processed_table(spark, d))


def _cohorts(spark, d):
    return S.union_cohorts(*both_predictions(spark, d))


COHORTS_SQL = ("cohorts AS (SELECT *, 'Historicos' AS Datos FROM hist "
               "UNION ALL SELECT *, 'Nuevos' AS Datos FROM live)")


@register("union_cohorts", with_scored(f", {COHORTS_SQL} SELECT * FROM cohorts".replace(
    "\n, ", ", ")))
def q_union_cohorts(spark, d):
    return _cohorts(spark, d)


def _desc_origin_sql():
    parts = []
    for c in ("hora", "mes", "y_proba_1"):
        x = f"cast({c} AS double)"
        parts.append(
            f"SELECT Datos, '{c}' AS variable, count({x}) AS count, {sround(f"avg({x})")} AS mean, "
            f"{sstd(f"stddev_samp({x})", f"avg({x})")} AS std, {sround(f"min({x})")} AS min, "
            f"{sround(f"quantile_cont({x}, 0.25)")} AS q25, {sround(f"quantile_cont({x}, 0.5)")} AS q50, "
            f"{sround(f"quantile_cont({x}, 0.75)")} AS q75, {sround(f"max({x})")} AS max "
            f"FROM cohorts GROUP BY Datos")
    return "\nUNION ALL\n".join(parts)


@register("describe_by_origin", with_scored(f", {COHORTS_SQL}\n{_desc_origin_sql()}"))
def q_describe_by_origin(spark, d):
    out = P.describe_by_group(_cohorts(spark, d), "Datos", ["hora", "mes", "y_proba_1"])
    return _round(zero_noise(out, "std", "mean"), ("mean", "std", "min", "q25", "q50", "q75", "max"))


def _desc_cat_origin_sql():
    parts = []
    for c in ("delegacion_inicio", "dia_semana", "tipo_entrada", "incidente_c4_rec"):
        parts.append(f"""
SELECT Datos, '{c}' AS variable, cast(sum(freq) AS bigint) AS count, count(*) AS unique,
       arg_min(value, (-freq, value)) AS top, cast(max(freq) AS bigint) AS freq
FROM (SELECT Datos, {c} AS value, count(*) AS freq FROM cohorts WHERE {c} IS NOT NULL GROUP BY 1, 2)
GROUP BY Datos""")
    return "\nUNION ALL\n".join(parts)


@register("describe_cat_by_origin", with_scored(f", {COHORTS_SQL}\n{_desc_cat_origin_sql()}"))
def q_describe_cat_by_origin(spark, d):
    return P.describe_categorical_by_group(_cohorts(spark, d), "Datos",
                                           ["delegacion_inicio", "dia_semana", "tipo_entrada",
                                            "incidente_c4_rec"])


@register("positive_rate_by_group", with_scored(f""", {COHORTS_SQL},
o AS (SELECT unnest(['Historicos', 'Nuevos']) AS Datos),
g AS (SELECT DISTINCT delegacion_inicio FROM cohorts)
SELECT o.Datos, g.delegacion_inicio, {sround("avg(c.y_etiqueta) * 100")} AS pct_positivos
FROM o CROSS JOIN g LEFT JOIN cohorts c
  ON c.Datos = o.Datos AND c.delegacion_inicio IS NOT DISTINCT FROM g.delegacion_inicio
GROUP BY 1, 2"""))
def q_positive_rate_by_group(spark, d):
    out = P.positive_rate_by_group(_cohorts(spark, d), "Datos", "delegacion_inicio", ORIGINS,
                                   target="y_etiqueta")
    return _round(out, ("pct_positivos",))


@register("score_histogram", with_scored(f""", {COHORTS_SQL},
c AS (SELECT Datos, cast(least(floor(y_proba_1 * 50), 49) AS integer) AS bin, count(*) AS n
      FROM cohorts WHERE y_proba_1 IS NOT NULL GROUP BY 1, 2)
SELECT Datos, bin, n, {sround("n * 100.0 / sum(n) OVER (PARTITION BY Datos)")} AS pct,
       bin / 50.0 AS bin_inicio FROM c"""))
def q_score_histogram(spark, d):
    return _round(P.score_histogram(_cohorts(spark, d), "y_proba_1", "Datos"), ("pct",))


@register("table_shape", "SELECT count(*) AS filas, 6 AS columnas FROM orders")
def q_table_shape(spark, d):
    return P.table_shape(table(spark, d, "orders"))


@register("tag_source", with_scored(
    ", t AS (SELECT *, 'Historicos' AS Datos FROM hist) SELECT * FROM t"))
def q_tag_source(spark, d):
    return S.tag_source(historic_predictions(spark, d), "Datos", "Historicos")


@register("prediction_list", with_scored(f"""
SELECT folio, mes, dia_semana, hora, delegacion_inicio, tipo_entrada, incidente_c4_rec,
       round(y_proba_0, 2) AS y_proba_0, round(y_proba_1, 2) AS y_proba_1, y_etiqueta FROM live"""))
def q_prediction_list(spark, d):
    return S.prediction_list(new_predictions(spark, d),
                             ["folio", "mes", "dia_semana", "hora", "delegacion_inicio",
                              "tipo_entrada", "incidente_c4_rec", "y_proba_0", "y_proba_1", "y_etiqueta"])


@register("priority_topk", with_scored("""
SELECT * FROM hist ORDER BY y_proba_1 DESC, folio LIMIT 100"""))
def q_priority_topk(spark, d):
    return S.priority_topk(historic_predictions(spark, d), 100)


@register("priority_topk_by_group", with_scored("""
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY delegacion_inicio
                                            ORDER BY y_proba_1 DESC, folio) AS rango FROM hist)
WHERE rango <= 5"""))
def q_priority_topk_by_group(spark, d):
    return S.priority_topk(historic_predictions(spark, d), 5, group="delegacion_inicio")


def _served(spark, d):
    """The written prediction table of the test rows: look-ups read it and score nothing."""
    scored, path = historic_predictions(spark, d), shared_dir(spark, "predictions")
    S.write_predictions(scored, path)
    return S.read_predictions(spark, path, scored)


@register("predict_lookup", with_scored("""
SELECT * FROM hist WHERE mes = 10 AND hora = 18 AND delegacion_inicio = 'á nation_15'
  AND dia_semana = 'miercoles' AND tipo_entrada = 'llamada household' AND incidente_c4_rec = 'sismo'
ORDER BY folio LIMIT 1"""))
def q_predict_lookup(spark, d):
    return S.predict_lookup(_served(spark, d),
                            {"mes": 10, "hora": 18, "delegacion_inicio": "á nation_15",
                             "dia_semana": "miercoles", "tipo_entrada": "llamada household",
                             "incidente_c4_rec": "sismo"})


@register("predict_by_period", with_scored("SELECT * FROM hist WHERE ano = 2000 AND mes = 4"))
def q_predict_by_period(spark, d):
    return S.predict_by_period(_served(spark, d), 2000, 4)


@register("bind_by_key", with_scored("""
SELECT p.folio, p.tipo_entrada, p.hora, s.y_proba_1, s.y_etiqueta
FROM proc p JOIN hist s ON p.folio = s.folio"""))
def q_bind_by_key(spark, d):
    feats = processed_table(spark, d).select("folio", "tipo_entrada", "hora")
    scores = historic_predictions(spark, d).select("folio", "y_proba_1", "y_etiqueta")
    return S.bind_by_key(feats, scores, "folio")




@register("flagship", with_model("""
SELECT delegacion_inicio, tipo_entrada, count(*) AS llamadas,
       """ + sround("avg(target) * 100") + """ AS pct_confirmadas
FROM model GROUP BY 1, 2"""))
def q_flagship(spark, d):
    from vigil.plans.runs import flagship
    return _round(flagship(spark, d), ("pct_confirmadas",))


# Monitor slice: the histogram for one value picked in the dashboard's filter.
SLICE_VALUE = "á nation_10"


@register("score_histogram_slice", with_scored(f""", {COHORTS_SQL},
c AS (SELECT Datos, cast(least(floor(y_proba_1 * 50), 49) AS integer) AS bin, count(*) AS n
      FROM cohorts WHERE y_proba_1 IS NOT NULL AND delegacion_inicio = '{SLICE_VALUE}' GROUP BY 1, 2)
SELECT Datos, bin, n, {sround("n * 100.0 / sum(n) OVER (PARTITION BY Datos)")} AS pct,
       bin / 50.0 AS bin_inicio FROM c"""))
def q_score_histogram_slice(spark, d):
    return _round(CU.histogram(_cube(spark, d), group=SLICE_VALUE), ("pct",))


def _cube(spark, d):
    """The written monitoring cube of both origins."""
    cube, path = CU.build(_cohorts(spark, d)), shared_dir(spark, "cube")
    CU.write(cube, path)
    return CU.read(spark, path, cube)


@register("monitoring_cube", with_scored(f""", {COHORTS_SQL},
b AS (SELECT *, cast(least(floor(y_proba_1 * 50), 49) AS integer) AS bin FROM cohorts)
SELECT ano, mes, Datos, CASE WHEN GROUPING(tipo_entrada) = 1 THEN 'delegacion' ELSE 'canal' END AS corte, delegacion_inicio, tipo_entrada,
       bin, count(*) AS n, cast(sum(y_etiqueta) AS bigint) AS positivos, {sround("sum(y_proba_1)")} AS suma
FROM b GROUP BY GROUPING SETS ((ano, mes, Datos, delegacion_inicio, bin), (ano, mes, Datos, tipo_entrada))"""))
def q_monitoring_cube(spark, d):
    return _round(_cube(spark, d), ("suma",))


@register("cube_histogram", with_scored(f""", {COHORTS_SQL},
c AS (SELECT Datos, cast(least(floor(y_proba_1 * 50), 49) AS integer) AS bin, count(*) AS n
      FROM cohorts WHERE y_proba_1 IS NOT NULL GROUP BY 1, 2)
SELECT Datos, bin, n, {sround("n * 100.0 / sum(n) OVER (PARTITION BY Datos)")} AS pct, bin / 50.0 AS bin_inicio FROM c"""))
def q_cube_histogram(spark, d):
    return _round(CU.histogram(_cube(spark, d)), ("pct",))


@register("cube_rate_by_channel", with_scored(f""", {COHORTS_SQL}
SELECT Datos, tipo_entrada, count(*) AS n, {sround("avg(y_etiqueta) * 100")} AS pct_positivos, {sround("avg(y_proba_1)")} AS media
FROM cohorts GROUP BY 1, 2"""))
def q_cube_rate_by_channel(spark, d):
    return _round(CU.positive_rate(_cube(spark, d), "tipo_entrada"), ("pct_positivos", "media"))


def _sketch_sql(c):
    x = f"cast({c} AS double)"
    return (f"SELECT '{c}' AS variable, count(*) AS rows, count({x}) AS count, count(*) - count({x}) AS missings, {sround(f'min({x})')} AS min, "
            f"{sround(f'max({x})')} AS max, {sround(f'avg({x})')} AS mean, {sround(f'stddev_samp({x})')} AS std, "
            "true AS uniques_ok, true AS q25_ok, true AS q50_ok, true AS q75_ok FROM lineitem")


@register("profile_sketches", "\nUNION ALL\n".join(_sketch_sql(c) for c in LINE_NUM))
def q_profile_sketches(spark, d):
    """The profile of all months merged from monthly sketches, and whether its
    quantiles and distinct counts are within the sketches' bounds of the exact ones."""
    li = table(spark, d, "lineitem").withColumn("mes", F.trunc("l_shipdate", "month"))
    cols = P.numeric_columns(li)
    profile = materialize(SK.profile(materialize(SK.monthly(li, "mes", cols), "sketches")), "sketch-profile")
    probs = (0.25, 0.5, 0.75)
    found = {r["variable"]: r for r in profile.collect()}      # a row per column
    below = [F.avg((F.col(c).cast("double") < found[c][f"q{round(p * 100)}"]).cast("double")).alias(f"{c}_lo{p}") for c in cols for p in probs]
    upto = [F.avg((F.col(c).cast("double") <= found[c][f"q{round(p * 100)}"]).cast("double")).alias(f"{c}_hi{p}") for c in cols for p in probs]
    exact = li.agg(*below, *upto).first()
    uniques = {r["variable"]: r["n"] for r in P.distinct_values(li, cols).groupBy("variable").agg(F.count(F.lit(1)).alias("n")).collect()}
    e = SK.rank_error()
    ok = [(c, abs(found[c]["uniques"] / uniques[c] - 1) <= 0.03,
           *[bool(exact[f"{c}_lo{p}"] - e <= p <= exact[f"{c}_hi{p}"] + e) for p in probs]) for c in cols]
    flags = spark.createDataFrame(ok, "variable string, uniques_ok boolean, q25_ok boolean, q50_ok boolean, q75_ok boolean")
    out = profile.select("variable", "rows", "count", "missings", "min", "max", "mean", "std").join(F.broadcast(flags), "variable")
    return _round(out, ("min", "max", "mean", "std"))
