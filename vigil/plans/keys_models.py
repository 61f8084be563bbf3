"""Query keys: cross-validation, model choice, scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigil.catalog import MODEL_CATEGORICAL, MODEL_NUMERIC
from vigil.operators import model_store as ST
from vigil.operators import models as MD
from vigil.operators.features import fill_with, fit_modes, impute_mode, sql_digest_bucket
from vigil.operators.lineage import with_run
from vigil.operators.scoring import apply_rate_model, fit_rate_model, rate_precision
from vigil.operators.clean import preprocess
from vigil.plans.frames import newest_month, raw_documents, written_split
from vigil.plans.keys_quality import RUN, RUN_SQL
from vigil.plans.present import round_cols, sround
from vigil.plans.registry import register
from vigil.plans.sql import with_scored
from vigil.session import materialize, shared_dir
from vigil.sources import files as SRC
from vigil.streaming import incremental as INC

FOLDS = 10
# Grid of the cell-rate scorer: key set and decision threshold per entry.
RATE_GRID = {
    "canal_incidente_t040": (("tipo_entrada", "incidente_c4_rec"), 0.40),
    "canal_incidente_hora_t040": (("tipo_entrada", "incidente_c4_rec", "hora"), 0.40),
    "canal_incidente_hora_t050": (("tipo_entrada", "incidente_c4_rec", "hora"), 0.50),
    "delegacion_dia_t040": (("delegacion_inicio", "dia_semana"), 0.40),
}
SCORE_COLS = [f"split{k}_test_score" for k in range(FOLDS)] + ["mean_test_score", "std_test_score"]


def _train(spark, d, s=None):
    s = s if s is not None else written_split(spark, d)
    train, test = s.filter(F.col("conjunto") == "train"), s.filter(F.col("conjunto") == "test")
    return impute_mode(train, test, ["delegacion_inicio"])


def _new_month(spark, d, s):
    """The month to score, imputed with the modes of the training rows."""
    modes = fit_modes(s.filter(F.col("conjunto") == "train"), ["delegacion_inicio"])
    return fill_with(s.filter(F.col("conjunto") == "nuevo"), modes, ["delegacion_inicio"])


def _rate_cv(spark, d, split=None):
    split = split if split is not None else written_split(spark, d)
    train = split.filter(F.col("conjunto") == "train")
    train = train.withColumn("fold", MD.fold_column("folio", FOLDS, method="digest"))
    return MD.cv_rate_model(train, RATE_GRID, "fold", FOLDS)


def _cv_sql():
    fold = sql_digest_bucket("folio", FOLDS, "fold0")
    parts = [f""", tr AS (SELECT *, {fold} AS fold
       FROM split WHERE conjunto = 'train'),
g AS (SELECT fold, sum(target)::double AS P_f, count(*) AS N_f FROM tr GROUP BY fold),
gt AS (SELECT fold, (sum(P_f) OVER () - P_f) / nullif((sum(N_f) OVER () - N_f)::double, 0) AS grate FROM g)"""]
    selects = []
    for i, (name, (keys, thr)) in enumerate(RATE_GRID.items()):
        k = ", ".join(keys)
        parts.append(f""",
s{i} AS (SELECT {k}, fold, sum(target)::double AS pos_f, count(*) AS n_f FROM tr GROUP BY ALL),
w{i} AS (SELECT s{i}.*, sum(pos_f) OVER (PARTITION BY {k}) AS pos_t, sum(n_f) OVER (PARTITION BY {k}) AS n_t,
                coalesce((sum(pos_f) OVER (PARTITION BY {k}) - pos_f)
                         / nullif((sum(n_f) OVER (PARTITION BY {k}) - n_f)::double, 0), gt.grate) >= {thr} AS pred
         FROM s{i} JOIN gt USING (fold)),
f{i} AS (SELECT '{name}' AS params, fold,
                coalesce(sum(CASE WHEN pred THEN pos_f ELSE 0 END) / nullif(sum(CASE WHEN pred THEN n_f ELSE 0 END), 0), 0.0) AS score
         FROM w{i} GROUP BY fold)""")
        selects.append(f"SELECT * FROM f{i}")
    splits = ", ".join(f"max(score) FILTER (WHERE fold = {k}) AS split{k}_test_score" for k in range(FOLDS))
    mean = " + ".join(f"split{k}_test_score" for k in range(FOLDS))
    var = " + ".join(f"(split{k}_test_score - mean_test_score) ^ 2" for k in range(FOLDS))
    parts.append(f""",
sc AS ({" UNION ALL ".join(selects)}),
wd AS (SELECT params, {splits} FROM sc GROUP BY params),
mn AS (SELECT *, ({mean}) / {FOLDS} AS mean_test_score FROM wd),
cv AS (SELECT *, sqrt(({var}) / {FOLDS}) AS std_test_score,
              cast(rank() OVER (ORDER BY mean_test_score DESC) AS integer) AS rank_test_score FROM mn)""")
    return "".join(parts)


CV_CTE = _cv_sql()
_ROUNDED = ", ".join(f"{sround(c)} AS {c}" for c in SCORE_COLS)


@register("cv_results", with_scored(f"{CV_CTE}\nSELECT params, {_ROUNDED}, rank_test_score FROM cv"))
def q_cv_results(spark, d):
    return round_cols(_rate_cv(spark, d), SCORE_COLS)


@register("best_model", with_scored(f"""{CV_CTE}
SELECT params, {_ROUNDED}, rank_test_score FROM cv
WHERE mean_test_score IS NOT NULL AND NOT isnan(mean_test_score)
ORDER BY mean_test_score DESC, params LIMIT 1"""))
def q_best_model(spark, d):
    return round_cols(MD.best_model(_rate_cv(spark, d)), SCORE_COLS)


@register("model_ranking", with_scored(f"{CV_CTE}\nSELECT params, {sround('mean_test_score')} AS "
                                       "mean_test_score, rank_test_score FROM cv"))
def q_model_ranking(spark, d):
    out = MD.model_ranking(_rate_cv(spark, d)).select("params", "mean_test_score", "rank_test_score")
    return round_cols(out, ["mean_test_score"])


def _ml_cv(kind):
    def run(spark, d):
        train, _ = _train(spark, d)
        return MD.cross_validate_ml(train, kind, MODEL_CATEGORICAL, MODEL_NUMERIC, folds=FOLDS)
    return run


register("cv_logistic")(_ml_cv("logistic"))
register("cv_random_forest")(_ml_cv("random_forest"))
register("cv_gbt")(_ml_cv("gbt"))

# Entry of the logistic grid used for the refit of the scoring keys.
LOGISTIC_CHOICE = "penalty=l2,C=1.0"
KEEP = ["folio", "mes", "hora", "delegacion_inicio", "dia_semana", "tipo_entrada", "incidente_c4_rec",
        "ano"]


@register("score_test")
def q_score_test(spark, d):
    train, test = _train(spark, d)
    model = MD.fit_best(train, "logistic", LOGISTIC_CHOICE, MODEL_CATEGORICAL, MODEL_NUMERIC)
    return MD.score(model, test, KEEP + ["target"])


def _with_logistic(spark, root, split, train):
    """Fits the chosen logistic regression and records it as the current model."""
    model = MD.fit_best(train, "logistic", LOGISTIC_CHOICE, MODEL_CATEGORICAL, MODEL_NUMERIC)
    test = split.filter(F.col("conjunto") == "test")
    precision = MD.precision_of(model.transform(fill_with(test, fit_modes(train, ["delegacion_inicio"]), ["delegacion_inicio"])))
    version = ST.new_version(spark, root)
    setting = {"modelo": "logistic", "params": LOGISTIC_CHOICE, "archivo_modelo": f"logistic/{LOGISTIC_CHOICE}",
               "archivo_metadatos": f"metadata/logistic/{LOGISTIC_CHOICE}", "mean_test_score": None, "std_test_score": None}
    ST.record_best(spark, root, version, setting, precision, RUN, lambda path: MD.save_model(model, path))
    ST.promote(spark, root, version, RUN)


def _with_cell_rate(spark, root, d, split):
    """Cross-validates the cell-rate scorer, fits the best setting and records
    grid, model and test precision; its version becomes the current one."""
    version = ST.new_version(spark, root)
    ST.record_cv(_rate_cv(spark, d, split).withColumn("modelo", F.lit("cell_rate")), root, version, RUN)
    setting = ST.chosen(spark, root, version)
    keys, threshold = RATE_GRID[setting["params"]]
    model = materialize(fit_rate_model(split.filter(F.col("conjunto") == "train"), keys), "rate-model")
    precision = rate_precision(split.filter(F.col("conjunto") == "test"), model, keys, threshold)
    ST.record_best(spark, root, version, setting, precision, RUN, lambda path: model.write.parquet(path))
    ST.promote(spark, root, version, RUN)


@register("score_month")
def q_score_month(spark, d):
    """The newest month by the model that the registry names as current."""
    split, root = written_split(spark, d), shared_dir(spark, "models")
    train, _ = _train(spark, d, split)
    _with_cell_rate(spark, root, d, split)
    _with_logistic(spark, root, split, train)
    found = ST.current(spark, root)
    return MD.score(MD.load_model(found["path"], found["modelo"]), _new_month(spark, d, split), KEEP)


_CV_COLS = [*[f"split{k}_test_score" for k in range(FOLDS)], "mean_test_score", "std_test_score"]
_FILES_SQL = "concat('cell_rate/', params) AS archivo_modelo, concat('metadata/cell_rate/', params) AS archivo_metadatos"


def _predictions_sql(rows="split", columns="s.conjunto, "):
    """Rows of every grid entry's scorer, as ``pr``; ``best`` names one entry."""
    parts = ["""
best AS (SELECT params FROM cv WHERE mean_test_score IS NOT NULL AND NOT isnan(mean_test_score)
         ORDER BY mean_test_score DESC, params LIMIT 1),
gr AS (SELECT avg(cast(target AS double)) AS rate FROM split WHERE conjunto = 'train')"""]
    for i, (name, (keys, threshold)) in enumerate(RATE_GRID.items()):
        same = " AND ".join(f"s.{k} = t.{k}" for k in keys)
        parts.append(f"""
y{i} AS (SELECT '{name}' AS params, s.folio, {columns}s.target, s.ano, s.mes,
                CASE WHEN coalesce(t.rate, (SELECT rate FROM gr)) >= {threshold} THEN 1 ELSE 0 END AS y
         FROM {rows} s LEFT JOIN (SELECT {", ".join(keys)}, avg(cast(target AS double)) AS rate
                                 FROM split WHERE conjunto = 'train' GROUP BY ALL) t ON {same})""")
    every = " UNION ALL ".join(f"SELECT * FROM y{i}" for i in range(len(RATE_GRID)))
    parts.append(f"\npr AS (SELECT p.* FROM ({every}) p JOIN best USING (params))")
    return ",".join(parts)


@register("lineage_model", with_scored(f"""{CV_CTE}
SELECT {RUN_SQL}, {_FILES_SQL}, params, {", ".join(f"{sround(c)} AS {c}" for c in _CV_COLS)}, rank_test_score, 'cell_rate' AS modelo FROM cv"""))
def q_lineage_model(spark, d):
    """The grid's rows as the registry holds them."""
    root = shared_dir(spark, "models")
    _with_cell_rate(spark, root, d, written_split(spark, d))
    rows = ST.events(spark, root).filter(F.col("event") == "cv").select(
        "fecha_ejecucion", "ip_address", "usuario", "archivo_modelo", "archivo_metadatos", "params", *_CV_COLS, "rank_test_score", "modelo")
    return round_cols(rows, _CV_COLS)


@register("lineage_best_model", with_scored(f"""{CV_CTE},{_predictions_sql()}
SELECT {RUN_SQL}, {_FILES_SQL},
       {sround("(SELECT coalesce(sum(target) FILTER (WHERE y = 1) / nullif(sum(y), 0), 0.0) FROM pr WHERE conjunto = 'test')")} AS precision,
       params AS parametros FROM best"""))
def q_lineage_best_model(spark, d):
    """The current model's row: its files, test precision and parameters."""
    root = shared_dir(spark, "models")
    _with_cell_rate(spark, root, d, written_split(spark, d))
    version = ST.current(spark, root)["version"]
    rows = ST.events(spark, root).filter((F.col("event") == "best") & (F.col("version") == version)).select(
        "fecha_ejecucion", "ip_address", "usuario", "archivo_modelo", "archivo_metadatos", "precision", F.col("params").alias("parametros"))
    return round_cols(rows, ["precision"])


@register("fairness_model")
def q_fairness_model(spark, d):
    """Fairness of a fitted model: the single boosted tree is trained on the
    training split, scores the test split, and the audit reports FOR/FNR per
    borough against the largest borough."""
    from vigil.operators import fairness as B
    train, test = _train(spark, d)
    model = MD.fit_best(train, "gbt_single", "n_estimators=1,learning_rate=0.25,max_depth=10",
                        MODEL_CATEGORICAL, MODEL_NUMERIC)
    scored = MD.score(model, test, ["delegacion_inicio", "target"])
    audit = scored.select("delegacion_inicio", F.col("y_etiqueta").alias("score"),
                          F.col("target").alias("label_value"))
    disp = B.disparity_major(B.group_metrics(B.group_crosstab(audit, ["delegacion_inicio"])))
    return B.fairness_table(disp, "delegacion_inicio")


@register("lineage_prediction", with_scored(f"""{CV_CTE},{_predictions_sql()}
SELECT {RUN_SQL}, (SELECT concat('cell_rate/', params) FROM best) AS archivo_modelo, max(cast(mes AS varchar)) AS mes_de_prediccion,
       max(cast(ano AS varchar)) AS ano_de_prediccion, count(*) AS registros_predichos, cast(sum(y) AS bigint) AS etiquetas_positivas
FROM pr WHERE conjunto = 'nuevo'"""))
def q_lineage_prediction(spark, d):
    """Prediction-task row: the model found in the registry, predicted month and
    year, rows scored by the stored model and the execution fields."""
    root, split = shared_dir(spark, "models"), written_split(spark, d)
    _with_cell_rate(spark, root, d, split)
    found = ST.current(spark, root)
    keys, threshold = RATE_GRID[found["params"]]
    stored = spark.read.parquet(found["path"])
    scored = apply_rate_model(split.filter(F.col("conjunto") == "nuevo"), stored, keys, threshold)
    row = scored.agg(F.max(F.col("mes").cast("string")).alias("mes_de_prediccion"),
                     F.max(F.col("ano").cast("string")).alias("ano_de_prediccion"),
                     F.count(F.lit(1)).alias("registros_predichos"),
                     F.sum("y_etiqueta").cast("bigint").alias("etiquetas_positivas"))
    return with_run(row.select(F.lit(found["archivo_modelo"]).alias("archivo_modelo"), "*"), RUN)


@register("scoring_stream", with_scored(f"""{CV_CTE},{_predictions_sql("proc", "")}
SELECT folio, ano, mes, y AS y_etiqueta FROM pr
WHERE NOT (make_date(ano, mes, 1) = (SELECT cast(date_trunc('month', max(o_orderdate)) - INTERVAL 1 MONTH AS date) FROM orders)
           AND folio::bigint % 2 = 1)"""))
def q_scoring_stream(spark, d):
    """Predictions kept up to date by two streams: all months are delivered,
    cleaned and scored by the current model; then the newest closed month comes
    again with half of its records and replaces its predictions."""
    root, split = shared_dir(spark, "models"), written_split(spark, d)
    _with_cell_rate(spark, root, d, split)
    raw, clean, changes, out = (shared_dir(spark, n) for n in ("raw", "clean", "changes", "predictions"))
    marks = [shared_dir(spark, "ckpt") for _ in range(2)]

    def score(rows):
        found = ST.current(rows.sparkSession, root)
        keys, threshold = RATE_GRID[found["params"]]
        scored = apply_rate_model(preprocess(rows), rows.sparkSession.read.parquet(found["path"]), keys, threshold)
        return scored.select("folio", "ano", F.col("mes").cast("int").alias("mes"), "y_etiqueta", "year", "month")

    def deliver(records, mode):
        SRC.write_raw(records, raw, mode)
        INC.run_incremental_clean(spark, raw, clean, marks[0], changes)
        INC.run_scoring(spark, changes, clean, out, marks[1], score)

    records = raw_documents(spark, d)
    deliver(records, "append")
    newest = F.make_date("year", "month", F.lit(1)) == newest_month(spark, d)
    deliver(records.filter(newest & (F.get_json_object("registros", "$.folio").cast("bigint") % 2 == 0)), "overwrite")
    return spark.read.schema("folio string, ano int, mes int, y_etiqueta int").parquet(out).select("folio", "ano", "mes", "y_etiqueta")
