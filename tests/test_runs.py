from pyspark.sql import functions as F

from tests.conftest import SF
from vigil.operators.lineage import RunInfo
from vigil.plans import runs as PL
from vigil.plans.frames import incident_source, newest_month
from vigil.session import shared_dir
from vigil.sources import files as S

RUN = RunInfo("01/01/2026 00:00:00", "127.0.0.1", "test")


def test_training_then_monthly_scoring(spark):
    out_dir = shared_dir(spark, "e1")
    res = PL.training_run(spark, SF, out_dir, RUN, kind="logistic", folds=3)
    cv = res["cv"].collect()
    assert len(cv) == 6 and {r.rank_test_score for r in cv} >= {1}
    assert res["fairness_summary"].count() == 1
    assert res["dq"].filter(F.col("test_status") == "failed").count() == 0

    # monthly run: land the newest closed month, read it back partition-pruned, score it
    newest = spark.range(1).select(newest_month(spark, SF)).first()[0]
    population = spark.read.parquet(f"{out_dir}/population")
    history = population.filter("conjunto = 'train'")
    assert history.filter(F.make_date("ano", F.col("mes").cast("int"), F.lit(1)) >= F.lit(newest)).isEmpty()
    landing, raw = shared_dir(spark, "landing"), shared_dir(spark, "raw")
    S.land_api_records(incident_source(spark, SF), landing)
    from vigil.catalog import RAW_FIELDS
    S.write_raw(S.to_raw(S.read_api_records(spark, landing, RAW_FIELDS, newest.year, newest.month)), raw)
    month = PL.monthly_scoring(spark, raw, f"{out_dir}/models", newest.year, newest.month, history)
    preds = month["predictions"]
    assert preds.count() > 0
    assert preds.filter((F.col("ano") != newest.year) | (F.col("mes") != newest.month)).count() == 0
    assert month["drift"].count() == 1


def test_training_with_boosted_trees_is_found_in_the_registry(spark):
    from vigil.operators import model_store as ST
    out_dir = shared_dir(spark, "e1")
    res = PL.training_run(spark, SF, out_dir, RUN, kind="gbt", folds=2)
    cv = res["cv"].collect()
    assert len(cv) == 2 and all(r.mean_fit_time > 0 for r in cv)
    found = ST.current(spark, f"{out_dir}/models")
    assert found["modelo"] == "gbt" and 0 <= found["precision"] <= 1


def test_monitoring_tables(spark):
    from vigil.plans.frames import historic_predictions, new_predictions
    tabs = PL.monitoring_tables(historic_predictions(spark, SF), new_predictions(spark, SF))
    hist = tabs["histogram"].groupBy("Datos").agg(F.sum("pct").alias("p")).collect()
    assert all(abs(r.p - 100.0) < 1e-9 for r in hist)
    assert tabs["describe"].count() == 6
