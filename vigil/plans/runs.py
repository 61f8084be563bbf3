"""End-to-end compositions: the flagship query, the training run (E1), the
monthly scoring run (E2) and the monitoring tables (E3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.catalog import MODEL_CATEGORICAL, MODEL_NUMERIC
from vigil.operators import fairness as B
from vigil.operators import model_store as ST
from vigil.operators import models as MD
from vigil.operators import profile as P
from vigil.operators import quality as Q
from vigil.operators import serving as S
from vigil.operators.clean import clean_month, guarded_drop, parse_documents, preprocess
from vigil.operators.features import fill_with, fit_modes, impute_mode
from vigil.operators.lineage import RunInfo
from vigil.plans.frames import model_table, written_split
from vigil.sources import files as SRC


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Confirmed-call rate (%) and calls per borough and entry channel over
    the whole cleaned, labelled population, highest rate first."""
    df = model_table(spark, sf_dir)
    return (df.groupBy("delegacion_inicio", "tipo_entrada")
              .agg(F.count(F.lit(1)).alias("llamadas"),
                   (F.avg("target") * 100).alias("pct_confirmadas"))
              .orderBy(F.desc("pct_confirmadas"), F.asc_nulls_last("delegacion_inicio"),
                       F.asc("tipo_entrada")))


def training_run(spark: SparkSession, sf_dir: str, out_dir: str, run: RunInfo,
                 kind: str = "logistic", folds: int = 10) -> dict[str, DataFrame]:
    """Clean -> features -> grid search -> best model -> scores -> fairness ->
    DQ, on the records before the newest month, which E2 scores. Stage outputs
    are written to ``out_dir`` (the cluster's shared folder), which also cuts the
    lineage between stages; the model becomes the current one of the registry
    ``out_dir``/models."""
    written_split(spark, sf_dir).write.mode("overwrite").parquet(f"{out_dir}/population")
    population, models = spark.read.parquet(f"{out_dir}/population"), f"{out_dir}/models"
    train = population.filter(F.col("conjunto") == "train")
    test = population.filter(F.col("conjunto") == "test")
    train, test = impute_mode(train, test, ["delegacion_inicio"])
    cv = MD.cross_validate_ml(train, kind, MODEL_CATEGORICAL, MODEL_NUMERIC, folds=folds)
    cv.write.mode("overwrite").parquet(f"{out_dir}/cv")
    cv = spark.read.parquet(f"{out_dir}/cv")
    version = ST.new_version(spark, models)
    ST.record_cv(cv, models, version, run)
    best = ST.chosen(spark, models, version)
    model = MD.fit_best(train, kind, best.params, MODEL_CATEGORICAL, MODEL_NUMERIC)
    scores = MD.score(model, test, ["folio", "delegacion_inicio", "dia_semana", "tipo_entrada",
                                    "target"])
    scores.write.mode("overwrite").parquet(f"{out_dir}/scores")
    scores = spark.read.parquet(f"{out_dir}/scores")
    precision = B.precision_metric(scores, label="target").first()["precision"]
    ST.record_best(spark, models, version, best, precision, run, lambda path: MD.save_model(model, path))
    ST.promote(spark, models, version, run)
    audit_in = scores.select("delegacion_inicio", F.col("y_etiqueta").alias("score"),
                             F.col("target").alias("label_value"))
    metrics = B.group_metrics(B.group_crosstab(audit_in, ["delegacion_inicio"]))
    disp = B.disparity_major(metrics)
    summary = B.fairness_summary(B.fairness_table(disp, "delegacion_inicio"))
    dq = Q.run_checks(spark, [
        ("no_nulls", "features", lambda: Q.dq_nulls(train.select(*MODEL_CATEGORICAL, *MODEL_NUMERIC)).withColumn("detalle", F.col("columna"))),
        ("cardinality_incidente_c4_rec", "features", lambda: Q.dq_cardinality(train, "incidente_c4_rec", 5))], run)
    return {"cv": cv, "scores": scores, "fairness": disp, "fairness_summary": summary, "dq": dq}


def monthly_scoring(spark: SparkSession, raw_path: str, models: str, year: int, month: int,
                    history: DataFrame) -> dict[str, DataFrame]:
    """Clean one month (partition-pruned read), impute it with the modes of
    ``history`` (the training rows), score it with the current model of the
    registry ``models``, check label drift against history."""
    raw = SRC.read_raw(spark, raw_path, year, month)
    df = guarded_drop(preprocess(clean_month(parse_documents(raw, keep=SRC.PARTITIONS), year, month)))
    df = fill_with(df, fit_modes(history, ["delegacion_inicio"]), ["delegacion_inicio"])
    found = ST.current(spark, models)
    scored = MD.score(MD.load_model(found["path"], found["modelo"]), df,
                      ["folio", "mes", "hora", "delegacion_inicio", "dia_semana", "tipo_entrada",
                       "incidente_c4_rec", "ano"])
    drift = Q.dq_label_drift(scored, history)
    return {"predictions": scored, "drift": drift}


def monitoring_tables(hist: DataFrame, live: DataFrame) -> dict[str, DataFrame]:
    """Cohort union and the dashboard tables."""
    both = S.union_cohorts(hist, live)
    return {
        "describe": P.describe_by_group(both, "Datos", ["hora", "mes", "y_proba_1"]),
        "describe_cat": P.describe_categorical_by_group(both, "Datos", ["delegacion_inicio",
                                                                         "tipo_entrada"]),
        "rate": P.positive_rate_by_group(both, "Datos", "delegacion_inicio",
                                         ("Historicos", "Nuevos"), target="y_etiqueta"),
        "histogram": P.score_histogram(both, "y_proba_1", "Datos"),
    }
