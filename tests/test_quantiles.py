import numpy as np
import pandas as pd

from vigil.operators.quantiles import exact_quantiles


def test_exact_quantiles_match_pandas(spark):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, 3000).astype(str),
                        "a": rng.normal(size=3000).round(2),
                        "b": rng.integers(0, 7, 3000).astype(float)})
    pdf.loc[::17, "a"] = None
    # one value holding a third of the rows (a hot value)
    pdf.loc[:999, "b"] = 3.0
    df = spark.createDataFrame(pdf).repartition(5)
    for r in exact_quantiles(df, ["a", "b"], [0.0, 0.25, 0.5, 0.75, 1.0]).collect():
        assert abs(pdf[r.variable].quantile(r.prob) - r.value) < 1e-12
    for r in exact_quantiles(df, ["a", "b"], [0.25, 0.5, 0.75], group="g").collect():
        assert abs(pdf[pdf.g == r.g][r.variable].quantile(r.prob) - r.value) < 1e-12


def test_single_value_and_all_null(spark):
    df = spark.createDataFrame([(5.0, None), (None, None)], "a double, b double")
    got = {(r.variable, r.prob): r.value for r in exact_quantiles(df, ["a", "b"], [0.5]).collect()}
    assert got == {("a", 0.5): 5.0}


def test_paging_and_quantiles_hold_without_exchange_reuse(spark):
    from vigil.operators.quantiles import exact_quantiles
    from vigil.sources.files import add_page_numbers
    old = {k: spark.conf.get(k) for k in ("spark.sql.exchange.reuse", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.exchange.reuse", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        rng = np.random.default_rng(2)
        pdf = pd.DataFrame({"k": rng.permutation(5000), "pay": rng.normal(size=5000), "text": ["t" * (i % 50) for i in range(5000)]})
        df = spark.createDataFrame(pdf).repartition(7)
        paged = add_page_numbers(df, "k", 300).toPandas()
        assert len(paged) == 5000 and (paged.pagina == paged.k // 300).all()
        for r in exact_quantiles(df, ["pay"], [0.25, 0.5, 0.75]).collect():
            assert abs(pdf.pay.quantile(r.prob) - r.value) < 1e-12
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
