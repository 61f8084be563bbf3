"""Quarantine, prediction table, monitoring cube, sketches, significance, fold, missing numbers."""

import json
import math
import random
import re
import sys
import unicodedata

import numpy as np
from pyspark.sql import functions as F

from vigil.functions.text import ascii_fold
from vigil.operators import cube as CU
from vigil.operators import profile as P
from vigil.operators import serving as S
from vigil.operators import significance as SG
from vigil.operators import sketches as SK
from vigil.operators.quarantine import clean_or_reject
from vigil.session import shared_dir
from vigil.sources.files import add_page_numbers


def test_every_record_is_clean_or_rejected_with_its_reasons(spark):
    doc = lambda **k: json.dumps({"folio": "f", "hora_creacion": "1:00", "mes": "4", "ano": "2020", "latitud": 1.5} | k)
    rows = [(1, doc()), (2, doc(mes="x")), (3, doc(mes="x", latitud="y", hora_creacion="1")), (4, doc()[:20]), (5, None), (6, ""),
            (7, doc(mes=None, latitud=None)), (8, doc(mes="99999")), (9, "[]"), (10, "{}"), (1, doc())]
    df = spark.createDataFrame([(*r, "x") for r in rows], "k int, registros string, errores string").select("k", "registros")
    clean, rejected = clean_or_reject(df.repartition(3), keep=["k"])
    got = {r.k: r.errores for r in rejected.collect()}
    assert got == {2: ["mes"], 3: ["mes", "latitud", "hora_creacion"], 4: ["json"], 5: ["json"], 6: ["json"], 8: ["mes"],
                   9: got[9], 10: ["hora_creacion"]} and got[9]
    assert sorted(r.k for r in clean.collect()) == [1, 1, 7]
    one = clean.filter("k = 7").first()
    assert (one.mes, one.ano, one.latitud, one.folio) == (None, 2020, None, "f")
    assert {r.registros for r in rejected.filter("k = 4").collect()} == {doc()[:20]}
    empty = clean_or_reject(df.limit(0), keep=["k"])
    assert empty[0].count() == empty[1].count() == 0


SCORED = ("folio string, ano int, mes int, hora int, delegacion_inicio string, dia_semana string, tipo_entrada string, "
          "incidente_c4_rec string, y_proba_1 double, y_etiqueta int, Datos string")


def scored(spark, n=600, months=(1, 2, 3), seed=0):
    r = random.Random(seed)
    rows = [(str(i), 2020, r.choice(months), r.randrange(24), r.choice(["a", "b", None]), r.choice("xy"), r.choice(["c1", "c2"]), "t",
             r.choice([0.0, 0.5, 1.0, r.random()]), r.randrange(2), r.choice(["Historicos", "Nuevos"])) for i in range(n)]
    return spark.createDataFrame(rows, SCORED)


def test_look_ups_read_their_partition_and_filter_in_the_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    df, path = scored(spark), shared_dir(spark, "served")
    S.write_predictions(df, path)
    table = S.read_predictions(spark, path, df)
    key = {"mes": 2, "hora": 5, "delegacion_inicio": "a", "dia_semana": "x", "tipo_entrada": "c1", "incidente_c4_rec": "t"}
    found = S.predict_lookup(table, key)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*\(mes#\d+ = 2\)", plan) and "EqualTo(delegacion_inicio,a)" in plan
    assert "Join" not in plan and "Python" not in plan     # it scores nothing
    want = sorted((r for r in df.collect() if all(r[k] == v for k, v in key.items())), key=lambda r: r.folio)[:1]
    assert [r.folio for r in found.collect()] == [r.folio for r in want]
    assert S.predict_by_period(table, 2020, 3).count() == df.filter("mes = 3").count()
    S.write_predictions(scored(spark, 50, (3,), 9), path)  # a month that is scored again replaces itself only
    table = S.read_predictions(spark, path, df)
    assert table.filter("mes = 3").count() == 50 and table.filter("mes < 3").count() == df.filter("mes < 3").count()


def test_cube_slices_equal_the_direct_tables(spark):
    df, path = scored(spark), shared_dir(spark, "cube")
    cube = CU.build(df)
    CU.write(cube, path)
    table = CU.read(spark, path, cube)
    rows = lambda d: sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in d.collect())
    for group in (None, "a"):
        slice_ = df if group is None else df.filter(F.col("delegacion_inicio") == group)
        assert rows(CU.histogram(table, group=group)) == rows(P.score_histogram(slice_, "y_proba_1", "Datos"))
    direct = df.groupBy("Datos", "tipo_entrada").agg(F.count("*").alias("n"), (F.avg("y_etiqueta") * 100).alias("p"), F.avg("y_proba_1").alias("m"))
    assert rows(CU.positive_rate(table, "tipo_entrada")) == rows(direct)
    again = scored(spark, 40, (2,), 5)
    CU.write(CU.build(again), path)
    whole, table = df.filter("mes <> 2").unionByName(again), CU.read(spark, path, cube)
    assert rows(CU.histogram(table)) == rows(P.score_histogram(whole, "y_proba_1", "Datos"))
    plan = CU.histogram(table)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "y_proba_1" not in plan


def test_merged_sketches_are_within_their_bounds(spark):
    r = np.random.default_rng(0)
    x = np.concatenate([r.exponential(5, 3000), np.full(1500, 7.0), 1e9 + r.normal(size=500)])
    rows = [(i % 12, float(v), str(int(v))) for i, v in enumerate(x)] + [(3, None, None), (3, float("nan"), "z")]
    df = spark.createDataFrame(rows, "m int, x double, t string")
    months = SK.monthly(df, "m", ["x"], ["t"])
    got = {row["variable"]: row for row in SK.profile(months).collect()}
    p = got["x"]
    assert (p["rows"], p["count"], p["missings"], p["min"], p["max"]) == (5002, 5000, 2, x.min(), x.max())
    assert math.isclose(p["mean"], x.mean(), rel_tol=1e-12) and math.isclose(p["std"], x.std(ddof=1), rel_tol=1e-9)
    assert abs(p["uniques"] / len(set(x)) - 1) < 0.03 and abs(got["t"]["uniques"] / len({t for *_, t in rows if t}) - 1) < 0.03
    for q in (25, 50, 75):
        v, e = p[f"q{q}"], SK.rank_error()
        assert (x < v).mean() - e <= q / 100 <= (x <= v).mean() + e
    assert got["t"]["q50"] is None and got["t"]["std"] is None
    assert SK.profile(SK.monthly(df.limit(0), "m", ["x"])).count() == 0


def tail(t, freedom):
    """Two-sided p by numeric integration of Student's density over atan(t / sqrt(freedom))."""
    angle = np.linspace(0, math.atan(t / math.sqrt(freedom)), 100_001)
    y = np.cos(angle) ** (freedom - 1)
    area = (y[0] + y[-1] + 4 * y[1:-1:2].sum() + 2 * y[2:-1:2].sum()) * (angle[1] - angle[0]) / 3
    return 1 - 2 * math.exp(math.lgamma((freedom + 1) / 2) - math.lgamma(freedom / 2)) / math.sqrt(math.pi) * area


def direct_p(a, b):
    """The two tests on the samples themselves."""
    za, zb = np.abs(a - np.median(a)), np.abs(b - np.median(b))
    n, m = len(a), len(b)
    every = np.concatenate([za, zb]).mean()
    between = n * (za.mean() - every) ** 2 + m * (zb.mean() - every) ** 2
    inside = ((za - za.mean()) ** 2).sum() + ((zb - zb.mean()) ** 2).sum()
    same = between < 1e-24 if inside == 0 else tail(math.sqrt((n + m - 2) * between / inside), n + m - 2) >= 0.05
    if same:
        freedom = n + m - 2
        error = (((a - a.mean()) ** 2).sum() + ((b - b.mean()) ** 2).sum()) / freedom * (1 / n + 1 / m)
    else:
        va, vb = a.var(ddof=1) / n, b.var(ddof=1) / m
        error = va + vb
        freedom = error ** 2 / (va ** 2 / (n - 1) + vb ** 2 / (m - 1)) if error else 1
    if error <= 0:
        return 0.0 if a.mean() != b.mean() else None
    return tail(abs(a.mean() - b.mean()) / math.sqrt(error), freedom)


def test_p_values_equal_tests_on_the_samples():
    r = random.Random(0)
    seen = set()
    for _ in range(300):
        n, m = r.randint(2, 60), r.randint(2, 400)
        k, j = r.choice([0, n, n // 2, r.randint(0, n)]), r.choice([0, m, m // 2, r.randint(0, m)])
        a, b = np.array([1.0] * k + [0.0] * (n - k)), np.array([1.0] * j + [0.0] * (m - j))
        got, want = SG.p_value(k, n, j, m), direct_p(a, b)
        seen.add(SG.equal_variances(k, n, j, m))
        assert math.isnan(got) if want is None else abs(got - want) < 1e-8, (k, n, j, m)
    assert seen == {True, False}
    assert math.isnan(SG.p_value(0, 0, 1, 5)) and math.isnan(SG.p_value(1, 1, 1, 1))


def test_mask_hides_the_p_values(spark):
    from vigil.operators import fairness as B
    rows = [("g1", 1, 1)] * 30 + [("g1", 0, 0)] * 30 + [("g2", 1, 0)] * 25 + [("g2", 0, 1)] * 20 + [("g3", 0, 0)]
    df = spark.createDataFrame(rows, "g string, score int, label_value int")
    disp = B.disparity_predefined(B.group_metrics(B.group_crosstab(df, ["g"])), {"g": "g1"})
    p = {x.attribute_value: x.fnr_significance for x in SG.with_significance(disp, mask=False).collect()}
    masked = {x.attribute_value: x.fnr_significance for x in SG.with_significance(disp).collect()}
    assert p["g3"] is None and masked == {"g1": False, "g2": True, "g3": False}
    assert p["g2"] < 0.05 and p["g1"] is None              # no variance and equal means: undefined
    absent = B.disparity_predefined(B.group_metrics(B.group_crosstab(df, ["g"])), {"g": "none"})
    assert {x.fnr_significance for x in SG.with_significance(absent, mask=False).collect()} == {None}


def test_fold_equals_nfkd_on_every_code_point(spark):
    points = [c for c in range(1, sys.maxunicode + 1) if not 0xD800 <= c <= 0xDFFF]
    df = spark.createDataFrame([(c, f"a{chr(c)}b") for c in points], "c int, t string").repartition(4)
    wrong = [r.c for r in df.select("c", ascii_fold("t").alias("f")).toLocalIterator()
             if r.f != unicodedata.normalize("NFKD", f"a{chr(r.c)}b").encode("ascii", "ignore").decode()]
    # a mark after "a" composes with it only where both decompose again, so folding by characters is exact
    assert wrong == []


def test_nan_is_missing_in_groups_and_correlations(spark):
    df = spark.createDataFrame([("g", v, w) for v, w in ((1.0, 2.0), (2.0, 4.0), (float("nan"), 1.0), (None, 3.0), (5.0, 10.0))], "g string, x double, y double")
    row = P.describe_by_group(df, "g", ["x"]).first()
    assert (row["count"], row["max"], row["q50"]) == (3, 5.0, 2.0) and abs(row["mean"] - 8 / 3) < 1e-12
    corr = {(r.var1, r.var2): r.corr for r in P.correlation_matrix(df).collect()}
    assert abs(corr["x", "y"] - 1) < 1e-12
    d = P.describe_numeric(df).collect()
    assert {r.variable: (r["count"], r.uniques, r.median) for r in d} == {"x": (3, 3, 2.0), "y": (5, 5, 3.0)}


def test_pages_of_a_hot_key(spark):
    df = spark.range(0, 3000, 1, 5).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), "id")
    pages = add_page_numbers(df, "k", 100).collect()
    assert sorted(r.pagina for r in pages) == [i // 100 for i in range(3000)]
    order = sorted(pages, key=lambda r: (r.k, r.pagina))
    assert [r.pagina for r in order] == sorted(r.pagina for r in pages)
