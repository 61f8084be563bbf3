"""The accent fold of long and odd texts; logistic folds side by side."""

import threading
import unicodedata

from pyspark.sql import functions as F

from vigil.functions.text import ascii_fold
from vigil.operators import cell_trees as CT
from vigil.operators import models as MD


def nfkd(t):
    return unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode()


def test_fold_needs_no_table_of_characters(spark):
    df = spark.createDataFrame([(1, "a")], "i int, t string").select(ascii_fold("t"))
    assert len(df._jdf.queryExecution().analyzed().toString()) < 2000


def test_fold_of_long_odd_and_missing_texts(spark):
    texts = ["½…ﬁ éñ™ " * 20000, "漢字かな交じり文Ａ" * 5000, "plain " * 30000, "", None, "\x00a\x7f", "ñ", "ẹ́x"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(3)
    got = {r.i: r.a for r in df.select("i", ascii_fold("t").alias("a")).collect()}
    assert got == {i: t if t is None else nfkd(t) for i, t in enumerate(texts)}


def test_fold_drops_bytes_that_are_no_text(spark):
    df = spark.createDataFrame([(bytearray(b"a\xffb\xc3\xa9\x80c"),)], "b binary")
    assert df.select(ascii_fold(F.expr("cast(b as string)")).alias("a")).first().a == "abec"


def test_folds_of_a_linear_model_run_side_by_side(spark, monkeypatch):
    import random
    r = random.Random(1)
    data = [(r.choice("pq"), float(r.randrange(3)), int(r.random() < 0.6), i % 3) for i in range(120)]
    df = spark.createDataFrame(data, "a string, x double, target int, k int")
    cells = CT.feature_cells(df, ["a"], ["x"], "target", "k", 3)
    together, stages = threading.Barrier(MD.FOLDS_AT_ONCE, timeout=60), MD.feature_stages
    monkeypatch.setattr(MD, "feature_stages", lambda *a: together.wait() >= 0 and stages(*a))
    rows = MD._fold_scores(spark, cells, "logistic", ["a"], ["x"], 3, "target", 6)
    assert len(rows) == 18 and {x[1] for x in rows} == {0, 1, 2} and all(0 <= x[2] <= 1 for x in rows)
    assert [x[1] for x in rows] == sorted(x[1] for x in rows)
