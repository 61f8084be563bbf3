"""Query keys: fairness audit (B1-B10) and classification metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigil.operators import fairness as B
from vigil.operators import significance as SG
from vigil.operators.lineage import with_run
from vigil.plans.frames import historic_predictions
from vigil.plans.keys_quality import RUN, RUN_SQL
from vigil.plans.present import round_cols, sround
from vigil.plans.registry import register
from vigil.plans.sql import with_scored

ATTRS = ("delegacion_inicio", "dia_semana", "tipo_entrada")
REF_GROUPS = {"delegacion_inicio": "á nation_10", "dia_semana": "lunes",
              "tipo_entrada": "llamada building"}
M = B.DISPARITY_METRICS


def _input(spark, d):
    return historic_predictions(spark, d).select(
        *ATTRS, F.col("y_etiqueta").alias("score"), F.col("y_test").alias("label_value"))


def _xtab(spark, d):
    return B.group_crosstab(_input(spark, d), ATTRS)


def _metrics(spark, d):
    return B.group_metrics(_xtab(spark, d))


# ---- SQL twins -------------------------------------------------------------
_UNPIVOT = "\nUNION ALL\n".join(
    f"SELECT '{a}' AS attribute_name, cast({a} AS varchar) AS attribute_value, "
    f"y_etiqueta AS score, y_test AS label_value FROM hist" for a in ATTRS)

XTAB_CTE = f""", u AS ({_UNPIVOT}),
c AS (SELECT attribute_name, attribute_value,
             cast(sum(CASE WHEN score = 1 AND label_value = 1 THEN 1 ELSE 0 END) AS bigint) AS tp,
             cast(sum(CASE WHEN score = 1 AND label_value = 0 THEN 1 ELSE 0 END) AS bigint) AS fp,
             cast(sum(CASE WHEN score = 0 AND label_value = 0 THEN 1 ELSE 0 END) AS bigint) AS tn,
             cast(sum(CASE WHEN score = 0 AND label_value = 1 THEN 1 ELSE 0 END) AS bigint) AS fn,
             count(*) AS group_size
      FROM u GROUP BY 1, 2),
x AS (SELECT *, tp + fp AS pp, tn + fn AS pn, tp + fn AS group_label_pos, tn + fp AS group_label_neg,
             cast(sum(group_size) OVER (PARTITION BY attribute_name) AS bigint) AS total_entities,
             cast(sum(tp + fp) OVER (PARTITION BY attribute_name) AS bigint) AS total_pp FROM c)"""

XTAB_COLS = ("attribute_name, attribute_value, tp, fp, tn, fn, group_size, pp, pn, group_label_pos, "
             "group_label_neg, total_entities, total_pp")


def _rate(num, den):
    return f"({num})::double / nullif(({den})::double, 0)"


_METRIC_EXPRS = {"ppr": _rate("pp", "total_pp")}
_METRIC_EXPRS.update({m: _rate(n, d) for m, (n, d) in B.RATES.items()})
METRIC_CTE = ", m AS (SELECT *, " + ", ".join(
    f'{e} AS "{m}"' for m, e in _METRIC_EXPRS.items()) + " FROM x)"
METRIC_NAMES = list(_METRIC_EXPRS)


def _q(m):
    return f'"{m}"'


def _metric_select(prefix=""):
    return ", ".join(f'{sround(prefix + _q(m))} AS {_q(m)}' for m in METRIC_NAMES)


@register("group_crosstab", with_scored(f"{XTAB_CTE}\nSELECT {XTAB_COLS} FROM x"))
def q_group_crosstab(spark, d):
    return _xtab(spark, d).select(*[c.strip() for c in XTAB_COLS.split(",")])


@register("group_metrics", with_scored(
    f"{XTAB_CTE}{METRIC_CTE}\nSELECT attribute_name, attribute_value, {_metric_select()} FROM m"))
def q_group_metrics(spark, d):
    out = _metrics(spark, d).select("attribute_name", "attribute_value", *METRIC_NAMES)
    return round_cols(out, METRIC_NAMES)


_REF_VALUES = ", ".join(f"('{a}', '{v}')" for a, v in REF_GROUPS.items())


def _disp_select(ref_alias="r"):
    return ", ".join(
        f'{sround(f"m.{_q(k)} / nullif({ref_alias}.{_q(k)}, 0)")} AS "{k}_disparity"' for k in M)


@register("fairness_disparity", with_scored(f"""{XTAB_CTE}{METRIC_CTE},
refs(attribute_name, attribute_value) AS (VALUES {_REF_VALUES}),
r AS (SELECT m.* FROM m JOIN refs USING (attribute_name, attribute_value))
SELECT m.attribute_name, m.attribute_value, {_disp_select()}
FROM m LEFT JOIN r ON m.attribute_name = r.attribute_name"""))
def q_fairness_disparity(spark, d):
    out = B.disparity_predefined(_metrics(spark, d), REF_GROUPS)
    cols = [f"{k}_disparity" for k in M]
    return round_cols(out.select("attribute_name", "attribute_value", *cols), cols)


@register("disparity_major", with_scored(f"""{XTAB_CTE}{METRIC_CTE},
r AS (SELECT * FROM (SELECT m.*, row_number() OVER (PARTITION BY attribute_name
                                   ORDER BY group_size DESC, attribute_value ASC NULLS LAST) AS rn FROM m) WHERE rn = 1)
SELECT m.attribute_name, m.attribute_value, r.attribute_value AS ref_group_value, {_disp_select()}
FROM m LEFT JOIN r ON m.attribute_name = r.attribute_name"""))
def q_disparity_major(spark, d):
    out = B.disparity_major(_metrics(spark, d))
    cols = [f"{k}_disparity" for k in M]
    return round_cols(out.select("attribute_name", "attribute_value", "ref_group_value", *cols), cols)


@register("disparity_min", with_scored(f"""{XTAB_CTE}{METRIC_CTE}
SELECT attribute_name, attribute_value, """ + ", ".join(
    f'{sround(f"{_q(k)} / nullif(min({_q(k)}) OVER (PARTITION BY attribute_name), 0)")} AS "{k}_disparity"'
    for k in M) + " FROM m"))
def q_disparity_min(spark, d):
    out = B.disparity_min(_metrics(spark, d))
    cols = [f"{k}_disparity" for k in M]
    return round_cols(out.select("attribute_name", "attribute_value", *cols), cols)


def _p_sql():
    """p-values of every group and rate: Levene's test around the medians decides
    between the pooled and Welch's t-test; Student's distribution is integrated
    by Simpson's rule over the angle atan(t / sqrt(freedom))."""
    counts = " UNION ALL ".join(
        f"SELECT m.attribute_name, m.attribute_value, '{k}' AS metric, m.{B.RATES[k][0]}::DOUBLE AS k, m.{B.RATES[k][1]}::DOUBLE AS n, "
        f"r.{B.RATES[k][0]}::DOUBLE AS k0, r.{B.RATES[k][1]}::DOUBLE AS n0 FROM m LEFT JOIN r USING (attribute_name)" for k in SG.METRICS)

    def tail(t, freedom):
        angle = f"atan({t} / sqrt({freedom}))"
        return (f"1 - 2 * exp(lgamma(({freedom} + 1) / 2) - lgamma({freedom} / 2)) / sqrt(pi()) * {angle} / 3000 * list_sum(list_transform(range(1001), "
                f"lambda i: (CASE WHEN i = 0 OR i = 1000 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END) * pow(cos(i * {angle} / 1000), {freedom} - 1)))")

    centred = lambda k, n: f"CASE WHEN 2 * {k} = {n} THEN 0.5 ELSE least({k}, {n} - {k}) / {n} END"
    within = lambda k, n, z: f"CASE WHEN 2 * {k} = {n} THEN 0.0 ELSE {n} * {z} * (1 - {z}) END"
    return f"""
sc AS (SELECT *, n > 0 AND n0 > 0 AND n + n0 > 2 AS known, {centred('k', 'n')} AS z, {centred('k0', 'n0')} AS z0 FROM ({counts})),
lv AS (SELECT *, (n * z + n0 * z0) / (n + n0) AS zm, {within('k', 'n', 'z')} + {within('k0', 'n0', 'z0')} AS inside FROM sc),
lt AS (SELECT *, n * pow(z - zm, 2) + n0 * pow(z0 - zm, 2) AS between_, n + n0 - 2 AS df FROM lv),
le AS (SELECT *, sqrt(df * between_ / nullif(inside, 0)) AS tl, k / n * (1 - k / n) * n AS sq, k0 / n0 * (1 - k0 / n0) * n0 AS sq0 FROM lt),
eq AS (SELECT *, CASE WHEN NOT known THEN NULL WHEN inside = 0 THEN between_ < 1e-24 ELSE {tail('tl', 'df')} >= {SG.ALPHA} END AS same FROM le),
er AS (SELECT *, CASE WHEN same THEN (sq + sq0) / df * (1 / n + 1 / n0) WHEN n > 1 AND n0 > 1 THEN sq / (n - 1) / n + sq0 / (n0 - 1) / n0 END AS error,
              CASE WHEN same THEN df ELSE pow(sq / (n - 1) / n + sq0 / (n0 - 1) / n0, 2) / nullif(pow(sq / (n - 1) / n, 2) / (n - 1)
                                          + pow(sq0 / (n0 - 1) / n0, 2) / (n0 - 1), 0) END AS freedom FROM eq),
pv AS (SELECT attribute_name, attribute_value, metric, CASE WHEN NOT known OR error IS NULL THEN NULL
              WHEN error <= 0 THEN CASE WHEN k / n <> k0 / n0 THEN 0.0 END
              ELSE {tail('abs(k / n - k0 / n0) / sqrt(error)', 'freedom')} END AS p FROM er)"""


_SIG_CTE = f"""{XTAB_CTE}{METRIC_CTE},
refs(attribute_name, attribute_value) AS (VALUES {_REF_VALUES}),
r AS (SELECT m.* FROM m JOIN refs USING (attribute_name, attribute_value)),{_p_sql()}"""


def _significance(spark, d, mask):
    out = SG.with_significance(B.disparity_predefined(_metrics(spark, d), REF_GROUPS), mask=mask)
    return out.select("attribute_name", "attribute_value", *[f"{k}_significance" for k in SG.METRICS])


@register("disparity_significance", with_scored(f"{_SIG_CTE}\nSELECT attribute_name, attribute_value, " + ", ".join(
    f"coalesce(bool_or(p < {SG.ALPHA}) FILTER (WHERE metric = '{k}'), false) AS \"{k}_significance\"" for k in SG.METRICS)
    + " FROM pv GROUP BY 1, 2"))
def q_disparity_significance(spark, d):
    """The masked form: is the rate different from the reference group's?"""
    return _significance(spark, d, True)


@register("disparity_p_values", with_scored(f"{_SIG_CTE}\nSELECT attribute_name, attribute_value, " + ", ".join(
    f"round(max(p) FILTER (WHERE metric = '{k}'), 6) AS \"{k}_significance\"" for k in SG.METRICS) + " FROM pv GROUP BY 1, 2"))
def q_disparity_p_values(spark, d):
    out = _significance(spark, d, False)
    return out.select("attribute_name", "attribute_value", *[F.round(f"{k}_significance", 6).alias(f"{k}_significance") for k in SG.METRICS])


def _parity_cte():
    flags = ", ".join(
        f'CASE WHEN "{k}_disparity" IS NOT NULL THEN "{k}_disparity" BETWEEN {B.PARITY_TAU} AND '
        f'{1.0 / B.PARITY_TAU} END AS "{k}_parity"' for k in M)
    raw = ", ".join(f'm.{_q(k)} / nullif(r.{_q(k)}, 0) AS "{k}_disparity"' for k in M)
    return f"""{XTAB_CTE}{METRIC_CTE},
refs(attribute_name, attribute_value) AS (VALUES {_REF_VALUES}),
r AS (SELECT m.* FROM m JOIN refs USING (attribute_name, attribute_value)),
dd AS (SELECT m.attribute_name, m.attribute_value, {raw}
       FROM m LEFT JOIN r ON m.attribute_name = r.attribute_name),
pf AS (SELECT attribute_name, attribute_value, {flags} FROM dd)"""


def _flags(spark, d):
    return B.parity_flags(B.disparity_predefined(_metrics(spark, d), REF_GROUPS))


@register("parity_flags", with_scored(f"{_parity_cte()}\nSELECT * FROM pf"))
def q_parity_flags(spark, d):
    return _flags(spark, d).select("attribute_name", "attribute_value", *[f"{k}_parity" for k in M])


@register("parity_attribute", with_scored(f"{_parity_cte()}\nSELECT attribute_name, " + ", ".join(
    f'bool_and("{k}_parity") AS "{k}_parity"' for k in M) + " FROM pf GROUP BY 1"))
def q_parity_attribute(spark, d):
    return B.parity_attribute(_flags(spark, d))


@register("parity_overall", with_scored(f"{_parity_cte()},\npo AS (SELECT " + ", ".join(
    f'bool_and("{k}_parity") AS "{k}_parity"' for k in M) + " FROM pf)\nSELECT *, " + " AND ".join(
    f'coalesce("{k}_parity", true)' for k in M) + " AS overall_parity FROM po"))
def q_parity_overall(spark, d):
    return B.parity_overall(_flags(spark, d))


_FTAB = f"""{XTAB_CTE}{METRIC_CTE},
refs(attribute_name, attribute_value) AS (VALUES ('delegacion_inicio', '{REF_GROUPS["delegacion_inicio"]}')),
r AS (SELECT m.* FROM m JOIN refs USING (attribute_name, attribute_value)),
ft AS (SELECT m.attribute_value, m."for", m.fnr, m."for" / nullif(r."for", 0) AS for_disparity,
              m.fnr / nullif(r.fnr, 0) AS fnr_disparity
       FROM m LEFT JOIN r ON m.attribute_name = r.attribute_name
       WHERE m.attribute_name = 'delegacion_inicio')"""


@register("fairness_table", with_scored(f"""{_FTAB}
SELECT attribute_value, {sround('"for"')} AS "for", {sround("fnr")} AS fnr,
       {sround("for_disparity")} AS for_disparity, {sround("fnr_disparity")} AS fnr_disparity FROM ft"""))
def q_fairness_table(spark, d):
    disp = B.disparity_predefined(_metrics(spark, d), {"delegacion_inicio": REF_GROUPS["delegacion_inicio"]})
    cols = ["for", "fnr", "for_disparity", "fnr_disparity"]
    return round_cols(B.fairness_table(disp, "delegacion_inicio"), cols)


_SUMMARY_SQL = f"""arg_min(attribute_value, (-"for", attribute_value IS NULL, attribute_value)) FILTER (WHERE "for" IS NOT NULL) AS delegacion_max_FOR,
       arg_min(attribute_value, (-fnr, attribute_value IS NULL, attribute_value)) FILTER (WHERE fnr IS NOT NULL) AS delegacion_max_FNR,
       {sround('avg("for")')} AS promedio_FOR, {sround("avg(fnr)")} AS promedio_FNR,
       arg_min(attribute_value, ("for", attribute_value IS NULL, attribute_value)) FILTER (WHERE "for" IS NOT NULL) AS delegacion_min_FOR,
       arg_min(attribute_value, (fnr, attribute_value IS NULL, attribute_value)) FILTER (WHERE fnr IS NOT NULL) AS delegacion_min_FNR"""


@register("fairness_summary", with_scored(f"{_FTAB}\nSELECT {_SUMMARY_SQL} FROM ft"))
def q_fairness_summary(spark, d):
    disp = B.disparity_predefined(_metrics(spark, d), {"delegacion_inicio": REF_GROUPS["delegacion_inicio"]})
    return round_cols(B.fairness_summary(B.fairness_table(disp, "delegacion_inicio")),
                      ["promedio_FOR", "promedio_FNR"])


@register("lineage_fairness", with_scored(f"{_FTAB}\nSELECT {RUN_SQL}, {_SUMMARY_SQL} FROM ft"))
def q_lineage_fairness(spark, d):
    """The audit's summary row with the execution fields."""
    return with_run(q_fairness_summary(spark, d), RUN)


@register("confusion_matrix", with_scored("""
SELECT * FROM (VALUES (1, 1), (1, 0), (0, 1), (0, 0)) v(y_real, y_predicho),
LATERAL (SELECT count(*) AS n FROM hist WHERE y_test = v.y_real AND y_etiqueta = v.y_predicho)"""))
def q_confusion_matrix(spark, d):
    return B.confusion_matrix(historic_predictions(spark, d))


@register("precision_metric", with_scored(f"""
SELECT {sround("coalesce(sum(CASE WHEN y_test = 1 AND y_etiqueta = 1 THEN 1 ELSE 0 END)::double / nullif(sum(CASE WHEN y_etiqueta = 1 THEN 1 ELSE 0 END), 0), 0.0)")} AS precision,
       cast(sum(CASE WHEN y_test = 1 AND y_etiqueta = 1 THEN 1 ELSE 0 END) AS bigint) AS tp,
       cast(sum(CASE WHEN y_etiqueta = 1 THEN 1 ELSE 0 END) AS bigint) AS pp FROM hist"""))
def q_precision_metric(spark, d):
    return round_cols(B.precision_metric(historic_predictions(spark, d)), ["precision"])


# Length rule audited across languages and sources: a document is predicted
# to be of good quality when it has at least this many characters.
DOC_MIN_CHARS = 2000
DOC_ATTRS = ("lang", "source")


def _doc_sql():
    unpivot = "\nUNION ALL\n".join(
        f"SELECT '{a}' AS attribute_name, cast({a} AS varchar) AS attribute_value, "
        f"y_etiqueta AS score, y_test AS label_value FROM dl" for a in DOC_ATTRS)
    xtab = XTAB_CTE.replace(_UNPIVOT, unpivot)
    return f"""WITH dl AS (SELECT d.lang, d.source,
                   CASE WHEN d.n_chars >= {DOC_MIN_CHARS} THEN 1 ELSE 0 END AS y_etiqueta,
                   l.quality AS y_test
            FROM documents d JOIN labels l ON d.doc_id = l.doc_id){xtab}{METRIC_CTE}
SELECT attribute_name, attribute_value, group_size, tp, fp, tn, fn, {_metric_select()} FROM m"""


@register("fairness_documents", _doc_sql())
def q_fairness_documents(spark, d):
    from vigil.catalog import table
    docs = table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars")
    labels = table(spark, d, "labels").select("doc_id", "quality")
    audit = docs.join(labels, "doc_id").select(
        *DOC_ATTRS, (F.col("n_chars") >= DOC_MIN_CHARS).cast("int").alias("score"),
        F.col("quality").alias("label_value"))
    out = B.group_metrics(B.group_crosstab(audit, DOC_ATTRS)).select(
        "attribute_name", "attribute_value", "group_size", "tp", "fp", "tn", "fn", *METRIC_NAMES)
    return round_cols(out, METRIC_NAMES)
