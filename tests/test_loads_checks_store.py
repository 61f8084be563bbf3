"""Atomic loads, checks that cannot end the report, the model registry."""

import pytest
from pyspark.sql import functions as F

from vigil.operators import model_store as ST
from vigil.operators import quality as Q
from vigil.operators.lineage import RunInfo
from vigil.session import shared_dir
from vigil.sources import deliveries as DEL

RUN = RunInfo("01/01/2026 00:00:00", "127.0.0.1", "test")
RAW = "registros string, year int, month int"


def rows(spark, *months, text="{}", n=2):
    return spark.createDataFrame([(f"{text}{i}", y, m) for y, m in months for i in range(n)], RAW)


def seen(spark, store):
    return {(r.year, r.month): r.n for r in DEL.read_rows(spark, store).groupBy("year", "month").agg(F.count("*").alias("n")).collect()}


def declared(spark, store):
    return sorted(((r.refine_ano, r.refine_mes, r.rows) for r in DEL.read_metadata(spark, store).collect()), key=str)


def test_a_load_is_seen_whole_or_not_at_all(spark):
    store = shared_dir(spark, "store")
    assert seen(spark, store) == {} and declared(spark, store) == []
    DEL.load(rows(spark, (2020, 1), (2020, 2), (None, None)), store, "a", RUN, "d", "s")
    before = {(2020, 1): 2, (2020, 2): 2, (None, None): 2}
    assert seen(spark, store) == before
    stored = DEL.stage(rows(spark, (2020, 2), (2020, 3), n=5), store, "b", RUN, "d", "s")     # stopped before its manifest
    assert seen(spark, store) == before and len(declared(spark, store)) == 3
    stored = DEL.stage(rows(spark, (2020, 2), (2020, 3), n=3), store, "b", RUN, "d", "s")     # run again under its name
    DEL.commit(stored, store, "b", "replace")
    assert seen(spark, store) == {(2020, 1): 2, (2020, 2): 3, (2020, 3): 3, (None, None): 2}
    assert ("2020", "2", 2) in declared(spark, store) and ("2020", "2", 3) in declared(spark, store)
    DEL.load(rows(spark, (2020, 2), n=1), store, "c", RUN, "d", "s")
    assert seen(spark, store)[2020, 2] == 4
    DEL.load(rows(spark, (None, None), n=1), store, "d", RUN, "d", "s", mode="replace")
    assert seen(spark, store)[None, None] == 1
    with pytest.raises(ValueError, match="committed"):
        DEL.stage(rows(spark, (2020, 2)), store, "b", RUN, "d", "s")
    assert [r.registros for r in DEL.read_rows(spark, store, 2020, 3).orderBy("registros").collect()] == ["{}0", "{}1", "{}2"]


def test_an_empty_load_and_a_numeric_name(spark):
    store = shared_dir(spark, "store")
    DEL.load(rows(spark, (2020, 1)), store, "2020", RUN, "d", "s")
    DEL.load(spark.createDataFrame([], RAW), store, "none", RUN, "d", "s")
    DEL.load(spark.createDataFrame([], RAW), store, "none", RUN, "d", "s")
    assert seen(spark, store) == {(2020, 1): 2} and len(declared(spark, store)) == 1


def test_stopped_months_are_not_read(spark):
    store = shared_dir(spark, "store")
    DEL.load(rows(spark, (2020, 1), (2020, 2)), store, "a", RUN, "d", "s")
    DEL.stage(rows(spark, (2021, 1), n=50), store, "b", RUN, "d", "s")
    df = DEL.read_rows(spark, store)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruningexpression(delivery" in plan
    assert "year" in DEL.read_rows(spark, store, 2020, 1)._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]
    assert df.count() == 4


def test_checks_go_on_after_one_that_breaks(spark):
    df = spark.createDataFrame([("a", "1"), ("B", None), ("c", "x")], "s string, n string")
    _, counted = Q.counted_once(df, "counted", lower=["s"], nulls=["n"])
    assert counted == {"rows": 3, "not_lower.s": 1, "nulls.s": 0, "nulls.n": 1}
    checks = [("plan", "clean", lambda: Q.dq_nulls(df.select("absent"))),
              ("run", "clean", lambda: Q.dq_true(df, F.col("n").cast("int") > 0, "run", "clean", "bad")),
              ("python", "clean", lambda: 1 / 0),
              ("lowercase", "clean", lambda: Q.counted_checks(spark, counted, "not_lower", "lowercase", "clean", "upper")),
              ("no_nulls", "clean", lambda: Q.counted_checks(spark, counted, "nulls", "no_nulls", "clean", "nulls")),
              ("card", "clean", lambda: Q.dq_cardinality(df, "s", 3))]
    got = {(r.test, r.detalle): (r.test_status, r.error) for r in Q.run_checks(spark, checks, RUN).collect()}
    assert got["plan", None][0] == "failed" and "UNRESOLVED_COLUMN" in got["plan", None][1]
    assert got["run", None] == ("failed", "check could not run: CAST_INVALID_INPUT")
    assert got["python", None] == ("failed", "check could not run: ZeroDivisionError")
    assert got["lowercase", "s"] == ("failed", "upper") and got["no_nulls", "n"][0] == "failed"
    assert got["no_nulls", "s"] == ("passed", None) and got["cardinality_s", None][0] == "passed"
    with pytest.raises(AssertionError, match="check could not run"):
        Q.raise_on_failure(Q.run_checks(spark, checks, RUN))


def test_shared_input_is_made_once():
    made = []
    one = Q.Once(lambda: made.append(1) or len(made))
    assert one() == one() == 1


def test_models_are_found_by_look_up(spark):
    root = shared_dir(spark, "models")
    with pytest.raises(LookupError):
        ST.current(spark, root)
    cv = spark.createDataFrame([("a", 0.2, 2, "k"), ("b", 0.5, 1, "k"), ("c", 0.5, 1, "k"), ("d", float("nan"), 3, "k")],
                               "params string, mean_test_score double, rank_test_score int, modelo string")
    files = spark.createDataFrame([(1,)], "x int")
    for version in (1, 2):
        assert ST.new_version(spark, root) == version
        ST.record_cv(cv, root, version, RUN)
        setting = ST.chosen(spark, root, version)
        assert setting["params"] == "b" and setting["archivo_modelo"] == "k/b"
        ST.record_best(spark, root, version, setting, 0.25 * version, RUN, lambda path: files.write.parquet(path))
        if version == 1:
            ST.promote(spark, root, version, RUN)
        found = ST.current(spark, root)
        assert found["version"] == 1 and found["precision"] == 0.25           # the second version is not promoted
    ST.promote(spark, root, 2, RUN)
    assert ST.current(spark, root)["precision"] == 0.5
    assert spark.read.parquet(ST.current(spark, root)["path"]).count() == 1
    with pytest.raises(ValueError):
        ST.promote(spark, root, 9, RUN)
    assert ST.events(spark, root).filter("event = 'cv'").count() == 8
