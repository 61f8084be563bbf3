"""Shared derived frames for the registered queries and the runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vigil.operators.clean import NA_LIMIT, clean_incidents, guarded_drop, parse_documents, preprocess
from vigil.plans.incidents import incident_source, raw_documents


def parsed_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw JSON documents parsed back into fields (one from_json pass)."""
    return parse_documents(raw_documents(spark, sf_dir))


def clean_table_from_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full ingest path: JSON documents -> parse -> clean."""
    return clean_incidents(parsed_incidents(spark, sf_dir))


def clean_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed clean table for the analytic frames. The clean rules apply to the
    incident fields directly: analytics read typed columns, as they would
    read the persisted clean table, and skip a JSON write/parse per row
    (``from_json(to_json(x))`` is ``x``; the JSON path is exercised by the
    ingest and parse keys, see ``clean_table_from_raw``)."""
    return clean_incidents(incident_source(spark, sf_dir))


def processed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """clean + incidente_c4_rec, hora, clave, target."""
    return preprocess(clean_table(spark, sf_dir))


def model_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Processed rows after the guarded 'na' drop: the modelling population."""
    return guarded_drop(processed_table(spark, sf_dir))


__all__ = ["incident_source", "raw_documents", "parsed_incidents", "clean_table",
           "processed_table", "model_table"]


# --- scored incidents (baseline cell-rate scorer) -----------------------------
from pyspark.sql import functions as F  # noqa: E402

from vigil.catalog import table  # noqa: E402
from vigil.operators.features import fill_with, fit_modes, tag_split  # noqa: E402
from vigil.session import materialize  # noqa: E402
from vigil.operators.scoring import apply_rate_model, fit_rate_model  # noqa: E402

SCORE_KEYS = ("tipo_entrada", "incidente_c4_rec", "hora")
PREDICTION_COLS = ("folio", "mes", "hora", "delegacion_inicio", "dia_semana", "tipo_entrada",
                   "incidente_c4_rec", "ano", "y_proba_0", "y_proba_1", "y_etiqueta")


# What models, scores and checks read of a processed row.
POPULATION = ("folio", "mes", "ano", "hora", "delegacion_inicio", "dia_semana", "tipo_entrada", "incidente_c4_rec", "target")


def newest_month(spark: SparkSession, sf_dir: str):
    """The month that the monthly run scores, as a date: the last closed month,
    which is the one before the month of the newest record."""
    last = table(spark, sf_dir, "orders").agg(F.to_date(F.max("o_orderdate")).alias("last"))
    return F.lit(last.select(F.add_months(F.trunc("last", "month"), -1)).first()[0]).cast("date")


def written_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The model population (after the guarded 'na' drop) with its set: records
    before the newest month are 70/30 train and test by key, those of the month
    are ``nuevo`` and those after it ``posterior``, so that no scored record was
    trained on.

    The processed rows are written to the shared folder once; their number and
    that of the 'na' rows come from one column of the written table."""
    month = F.make_date(F.col("ano"), F.col("mes").cast("int"), F.lit(1))
    population = materialize(processed_table(spark, sf_dir).select(*POPULATION), "population")
    counted = population.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("delegacion_inicio") == "na").alias("na")).first()
    if counted["n"] and counted["na"] < NA_LIMIT * counted["n"]:
        population = population.filter(F.col("delegacion_inicio").isNull() | (F.col("delegacion_inicio") != "na"))
    newest = newest_month(spark, sf_dir)
    return tag_split(population, "folio", method="digest").withColumn(
        "conjunto", F.when(month == newest, F.lit("nuevo")).when(month > newest, F.lit("posterior")).otherwise(F.col("conjunto")))


def scored_table(spark: SparkSession, sf_dir: str, split: DataFrame | None = None) -> DataFrame:
    """Every row of the population (``split``: its written table), its borough
    imputed with the training mode, scored by the cell-rate model fit on the
    training rows."""
    df = split if split is not None else written_split(spark, sf_dir)
    train = df.filter(F.col("conjunto") == "train")
    model = materialize(fit_rate_model(train, SCORE_KEYS), "rate-model")
    df = fill_with(df, fit_modes(train, ["delegacion_inicio"]), ["delegacion_inicio"])
    return apply_rate_model(df, model, SCORE_KEYS).withColumn("mes", F.col("mes").cast("int"))


def _cohort(scored: DataFrame, name: str) -> DataFrame:
    return scored.filter(F.col("conjunto") == name).select(*PREDICTION_COLS, F.col("target").alias("y_test"))


def historic_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test-set predictions (the history the monitor compares against)."""
    return _cohort(scored_table(spark, sf_dir), "test")


def new_predictions(spark: SparkSession, sf_dir: str, split: DataFrame | None = None) -> DataFrame:
    """Predictions of the newest month."""
    return _cohort(scored_table(spark, sf_dir, split), "nuevo")


def both_predictions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Historic and new predictions from one scored table."""
    scored = scored_table(spark, sf_dir)
    return _cohort(scored, "test"), _cohort(scored, "nuevo")
