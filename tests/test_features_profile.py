import pytest
from pyspark.sql import functions as F

from vigil.operators import features as FE
from vigil.operators import profile as P


def test_mode_tie_lowest(spark):
    train = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "d string")
    test = spark.createDataFrame([(None,), ("c",)], "d string")
    tr, te = FE.impute_mode(train, test, ["d"])
    assert sorted(r.d for r in te.collect()) == ["a", "c"]
    assert tr.filter(F.col("d").isNull()).count() == 0


def test_unseen_category_counted_not_error(spark):
    train = spark.createDataFrame([("x",), ("y",)], "c string")
    test = spark.createDataFrame([("x",), ("z",), (None,)], "c string")
    vocab = FE.fit_one_hot(train, ["c"])
    enc = FE.one_hot(test, vocab)
    assert enc.columns == ["c_x", "c_y"]
    assert [tuple(r) for r in enc.collect()] == [(1, 0), (0, 0), (0, 0)]
    assert [(r.level, r.n) for r in FE.unseen_levels(test, FE.fit_levels(train, ["c"]), ["c"]).collect()] == [("z", 1)]


def test_align_and_inverse(spark):
    df = spark.createDataFrame([(1, 0, 1)], "k int, c_a int, c_c int")
    al = FE.align_features(df, ["c_a", "c_b"], keep=["k"])
    assert al.columns == ["k", "c_a", "c_b"] and tuple(al.first()) == (1, 0, 0)
    assert FE.one_hot_inverse(df, {"c": ["a", "c"]}, keep=["k"]).first().c == "c"
    # a variable whose name begins with another's
    both = spark.createDataFrame([(0, 1)], "a_x int, a_b_x int")
    assert tuple(FE.one_hot_inverse(both, {"a": ["x"], "a_b": ["x"]}).first()) == (None, "x")


def test_split_independent_of_partitioning(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("k"))
    a, _ = FE.train_test_split(df.repartition(1), "k")
    b, _ = FE.train_test_split(df.repartition(7), "k")
    assert sorted(r.k for r in a.collect()) == sorted(r.k for r in b.collect())
    assert 0.6 < a.count() / 2000 < 0.8


def test_histogram_probability_one_in_last_bin(spark):
    df = spark.createDataFrame([(1.0,), (0.0,), (0.999,)], "p double")
    bins = sorted((r.bin, r.n) for r in P.score_histogram(df, "p").collect())
    assert bins == [(0, 1), (49, 2)]


def test_describe_numeric_matches_pandas(spark):
    import pandas as pd
    pdf = pd.DataFrame({"x": [1.0, 2.0, 2.0, 3.0, 7.0, None], "y": [1, 5, 2, 2, 9, 4]})
    df = spark.createDataFrame(pdf)
    got = {r.variable: r for r in P.describe_numeric(df, ["x", "y"]).collect()}
    for c in ("x", "y"):
        s = pdf[c].astype(float)
        assert got[c]["mean"] == pytest.approx(s.mean())
        assert got[c]["std"] == pytest.approx(s.std())
        assert got[c]["q25"] == pytest.approx(s.quantile(0.25))
        assert got[c]["median"] == pytest.approx(s.median())
        assert got[c]["skew"] == pytest.approx(s.skew())
        assert got[c]["kurt"] == pytest.approx(s.kurt())
        assert got[c]["uniques"] == s.nunique()
        assert got[c]["missings"] == s.isnull().sum()


def test_positive_rate_grid_has_null_for_absent_pair(spark):
    df = spark.createDataFrame([("H", "a", 1), ("H", "b", 0), ("N", "a", 0)], "o string, g string, t int")
    got = {(r.o, r.g): r.pct_positivos for r in
           P.positive_rate_by_group(df, "o", "g", ["H", "N"], target="t").collect()}
    assert got[("N", "b")] is None and got[("H", "a")] == 100.0


def test_empty_input_keeps_schema(spark):
    empty = spark.createDataFrame([], "g string, t int")
    out = P.category_means(empty, "g", "t")
    assert out.count() == 0 and out.columns == ["g", "mean_t"]
