from pyspark.sql import functions as F

from tests.conftest import SF
from vigil.operators import models as MD
from vigil.session import shared_dir
from vigil.sources import files as S


def test_partition_overwrite_is_idempotent(spark):
    path = shared_dir(spark, "raw-test")
    a = spark.createDataFrame([("{}", 2020, 1), ("{}", 2020, 2)], "registros string, year int, month int")
    S.write_raw(a, path)
    S.write_raw(a.filter("month = 2"), path, "overwrite")
    S.write_raw(a.filter("month = 2"), path, "overwrite")
    got = sorted((r.month, r.n) for r in S.read_raw(spark, path).groupBy("month").agg(F.count("*").alias("n")).collect())
    assert got == [(1, 1), (2, 1)]


def test_page_numbers_match_row_number(spark):
    df = spark.range(0, 2500, 1, 7).select((F.col("id") * 3).alias("k"))
    got = {r.k: r.pagina for r in S.add_page_numbers(df, "k", 100).collect()}
    assert all(got[k * 3] == k // 100 for k in range(2500))


def test_rate_cv_matches_brute_force(spark):
    import pandas as pd
    from vigil.plans.frames import written_split
    df = written_split(spark, SF).filter("conjunto = 'train'").withColumn(
        "fold", MD.fold_column("folio", 10, method="digest"))
    grid = {"t": (("tipo_entrada",), 0.3)}
    res = MD.cv_rate_model(df, grid, "fold", 10).first()
    pdf = df.select("tipo_entrada", "fold", "target").toPandas()
    for k in range(10):
        tr, va = pdf[pdf.fold != k], pdf[pdf.fold == k]
        rates = tr.groupby("tipo_entrada").target.mean()
        pred = va.tipo_entrada.map(rates).fillna(tr.target.mean()) >= 0.3
        pp = pred.sum()
        prec = (va.target[pred] == 1).sum() / pp if pp else 0.0
        assert abs(res[f"split{k}_test_score"] - prec) < 1e-12
    del pd


def test_logistic_scores_are_probabilities(spark):
    from vigil.catalog import MODEL_CATEGORICAL, MODEL_NUMERIC
    from vigil.operators.features import impute_mode
    from vigil.plans.frames import written_split
    s = written_split(spark, SF)
    tr, te = impute_mode(s.filter("conjunto = 'train'"), s.filter("conjunto = 'test'"), ["delegacion_inicio"])
    model = MD.fit_best(tr, "logistic", "penalty=l2,C=1.0", MODEL_CATEGORICAL, MODEL_NUMERIC)
    out = MD.score(model, te, ["folio"])
    r = out.agg(F.min("y_proba_1").alias("lo"), F.max("y_proba_1").alias("hi"),
                F.max(F.abs(F.col("y_proba_0") + F.col("y_proba_1") - 1)).alias("err")).first()
    assert 0 <= r.lo <= r.hi <= 1 and r.err < 1e-9
    assert out.count() == te.count()


def test_lineage_raw_quoted_values(spark):
    import json
    from vigil.operators.lineage import RunInfo, lineage_raw
    raw = spark.createDataFrame([("{}", 2020, 4), ("{}", 2020, 4)], "registros string, year int, month int")
    run = RunInfo("01/01/2026 00:00:00", "127.0.0.1", "t")
    r = lineage_raw(raw, run, "d", 'src "x"\\y', quoted=True).first()
    assert (r.refine_ano, r.refine_mes, r.rows) == ('"2020"', '"4"', 2)
    assert json.loads(r.parametro_url) == 'src "x"\\y'
    p = lineage_raw(raw, run, "d", "s").first()
    assert (p.refine_ano, p.refine_mes) == ("2020", "4")
