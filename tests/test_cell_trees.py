"""Trees on weighted cells against trees on rows and against a plain recursion."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest

from vigil.operators import cell_trees as CT
from vigil.operators import models as MD
from vigil.session import shared_dir

CAT, NUM = ["a", "b"], ["x"]


def rows(n, seed=0):
    r = random.Random(seed)
    out = []
    for _ in range(n):
        a, b, x = r.choice("pqrs") if r.random() > 0.03 else None, r.choice("uv"), float(r.randrange(6)) if r.random() > 0.03 else None
        odds = (a == "p") * 0.4 + (b == "u" and (x or 0) > 2) * 0.4 + 0.1
        out.append((a, b, x, int(r.random() < odds)))
    return out


def design(data, compressed):
    """The rows as cells: one per row, or one per distinct features."""
    if compressed:
        cells = {}
        for *k, y in data:
            n, p = cells.get(tuple(k), (0, 0))
            cells[tuple(k)] = (n + 1, p + y)
        data = [(*k, n, p) for k, (n, p) in cells.items()]
    else:
        data = [(*k, 1, y) for *k, y in data]
    random.Random(7).shuffle(data)
    a, b, x, n, p = zip(*data, strict=True)
    d = CT.Design(pa.table({"a": pa.array(a, pa.string()), "b": pa.array(b, pa.string()), "x": pa.array(x, pa.float64()),
                            "n": pa.array([[v] for v in n]), "pos": pa.array([[v] for v in p])}), CAT, NUM)
    return d, d.counts("n")[:, 0], d.counts("pos")[:, 0]


def by_features(d, p):
    keys = zip(d.table["a"].to_pylist(), d.table["b"].to_pylist(), d.table["x"].to_pylist(), strict=True)
    return {k: round(float(v), 9) for k, v in zip(keys, p, strict=True)}


SPLITS = ([("a", v) for v in "pqrs"] + [("b", v) for v in "uv"] + [("x", float(v)) for v in range(6)])


def right(split, row):
    f, v = split
    value = row["abx".index(f)]
    return value == v if f != "x" else value is None or value > v


def plain_tree(data, target, max_depth, min_split, min_leaf):
    """Splits of lowest squared error by recursion over rows; returns row -> leaf (the row numbers in it)."""
    leaf = {}

    def go(own, depth):
        t = [target[i] for i in own]
        mean = sum(t) / len(t)
        best = None
        if depth < max_depth and len(own) >= min_split and sum((v - mean) ** 2 for v in t) / len(t) > 1e-13:
            for s in SPLITS:
                sides = [[i for i in own if right(s, data[i]) == r] for r in (False, True)]
                if min(map(len, sides)) >= min_leaf:
                    gain = sum(sum(target[i] for i in side) ** 2 / len(side) for side in sides)
                    if best is None or gain > best[0] + 1e-9 * (1 + abs(gain)):
                        best = (gain, sides)
        if best is None:
            leaf.update((i, tuple(own)) for i in own)
        else:
            for side in best[1]:
                go(side, depth + 1)

    go(list(range(len(data))), 0)
    return leaf


def plain_boosting(data, trees, rate, depth):
    y = [r[-1] for r in data]
    prior = sum(y) / len(y)
    raw = [math.log(prior / (1 - prior))] * len(y)
    for _ in range(trees):
        p = [1 / (1 + math.exp(-v)) for v in raw]
        leaf = plain_tree(data, [a - b for a, b in zip(y, p, strict=True)], depth, 2, 1)
        step = {own: sum(y[i] - p[i] for i in own) / sum(p[i] * (1 - p[i]) for i in own) for own in set(leaf.values())}
        raw = [v + rate * step[leaf[i]] for i, v in enumerate(raw)]
    return {tuple(r[:-1]): round(1 / (1 + math.exp(-v)), 9) for r, v in zip(data, raw, strict=True)}


def test_boosting_on_cells_equals_rows_and_recursion():
    data = rows(300)
    want = plain_boosting(data, 6, 0.25, 4)
    for compressed in (True, False):
        d, n, pos = design(data, compressed)
        _, _, p = CT.fit_boosted(d, n, pos, n_estimators=6, learning_rate=0.25, max_depth=4)
        got = by_features(d, p)
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-8 for k in got)


@pytest.mark.parametrize("min_split", [2, 25, 60])
@pytest.mark.parametrize("min_leaf", [1, 10, 20])
def test_single_tree_keeps_least_sizes(min_split, min_leaf):
    data = rows(400, 3)
    d, n, pos = design(data, True)
    tree, leaf = CT.grow(d, n, pos, pos, 100, min_split, min_leaf)
    want = plain_tree(data, [r[-1] for r in data], 100, min_split, min_leaf)
    rate = {tuple(data[i][:-1]): round(sum(data[j][-1] for j in own) / len(own), 9) for i, own in want.items()}
    up, down = (np.bincount(leaf, x, len(tree.feature)) for x in (pos, n))
    assert by_features(d, (up / np.maximum(down, 1))[leaf]) == rate
    assert down[np.unique(leaf)].min() >= min_leaf


def test_depth_has_no_limit_of_its_own():
    n = 200                                                 # each level of the tree peels one more value off
    d = CT.Design(pa.table({"x": pa.array([float(i) for i in range(n)]), "n": [[1]] * n, "pos": [[0]] * n}), [], ["x"])
    total = 4.0 ** np.arange(n)
    ones = np.ones(n)
    for limit, deep in ((50, 50), (100, 100)):
        tree, _ = CT.grow(d, ones, total / total.max(), (total / total.max()) ** 2 + 1, limit)
        depth = np.zeros(len(tree.feature), int)
        for i in np.flatnonzero(tree.feature >= 0):
            depth[tree.child[i]:tree.child[i] + 2] = depth[i] + 1
        assert depth.max() == deep


def test_forest_draws_as_many_rows_and_few_columns():
    data = rows(500, 5)
    d, n, pos = design(data, True)
    one, two = (CT.fit_forest(d, n, pos, 5, 50, 10, 10) for _ in range(2))
    assert (one[2] == two[2]).all() and len(one[0]) == 5    # the same trees on a rerun
    assert len({(int(t.feature[0]), int(t.bound[0])) for t in CT.fit_forest(d, n, pos, 40, 1, 2, 1)[0]}) > 1
    assert 0 <= one[2].min() and one[2].max() <= 1
    high = one[2][[i for i, k in enumerate(by_features(d, pos)) if k[0] == "p"]].mean()
    assert high > one[2].mean()


def test_grids_have_the_wanted_settings():
    forest = [s for _, s in CT.tree_grid("random_forest")]
    assert len({str(s) for s in forest}) == 8
    assert {s["min_samples_leaf"] for s in forest} == {10, 20} and {s["min_samples_split"] for s in forest} == {10, 25}
    assert {s["max_depth"] for s in forest} == {50, 100}
    assert [s["max_depth"] for _, s in CT.tree_grid("gbt")] == [10, 15]


def test_cross_validation_by_spark_equals_direct_fits(spark):
    data = rows(240, 9)
    df = spark.createDataFrame([(*r, i % 3) for i, r in enumerate(data)], "a string, b string, x double, target int, k int").repartition(4)
    cells = CT.feature_cells(df, CAT, NUM, "target", "k", 3)
    assert cells.selectExpr("sum(n[0] + n[1] + n[2])").first()[0] == 240
    grid = [("d2", dict(n_estimators=3, learning_rate=0.25, max_depth=2)), ("d5", dict(n_estimators=3, learning_rate=0.25, max_depth=5))]
    got = {(r["params"], r["_fold"]): (r["tp"], r["pp"]) for r in CT.cross_validate(cells, "gbt", CAT, NUM, 3, grid).collect()}
    for name, s in grid:
        for k in range(3):
            model = plain_boosting([r for i, r in enumerate(data) if i % 3 != k], 3, 0.25, s["max_depth"])
            held = [r for i, r in enumerate(data) if i % 3 == k and tuple(r[:-1]) in model]
            called = [r for r in held if model[tuple(r[:-1])] > 0.5]
            unseen = sum(1 for i, r in enumerate(data) if i % 3 == k) - len(held)
            assert abs(got[name, k][1] - len(called)) <= unseen and abs(got[name, k][0] - sum(r[-1] for r in called)) <= unseen


def test_model_is_stored_and_scores_unseen_values(spark):
    data = rows(300, 2)
    df = spark.createDataFrame(data, "a string, b string, x double, target int").repartition(3)
    for kind, params in (("gbt", dict(n_estimators=4, learning_rate=0.25, max_depth=4)),
                         ("random_forest", dict(n_estimators=4, max_depth=50, min_samples_split=10, min_samples_leaf=10))):
        model = CT.CellModel.fit(df, kind, params, CAT, NUM)
        path = shared_dir(spark, "cell-model")
        MD.save_model(model, path)
        again = MD.load_model(path, kind)
        d, n, pos = design(data, True)
        _, _, p = CT.FITS[kind](d, n, pos, **params)
        want = by_features(d, p)
        new = spark.createDataFrame([*[(*k, 1) for k in want], ("zz", None, 9.5, 1), (None, None, None, 1)], "a string, b string, x double, id int")
        got = {(r.a, r.b, r.x): r for r in MD.score(again, new, ["a", "b", "x"]).collect()}
        assert {k: round(got[k].y_proba_1, 9) for k in want} == want
        assert all(abs(r.y_proba_0 + r.y_proba_1 - 1) < 1e-12 and r.y_etiqueta == (r.y_proba_1 > 0.5) for r in got.values())
    assert MD.score(again, new.limit(0), ["a"]).count() == 0


def test_logistic_on_cells_equals_rows(spark):
    data = [r for r in rows(400, 4) if r[0] and r[2] is not None]
    df = spark.createDataFrame(data, "a string, b string, x double, target int")
    model = MD.fit_best(df, "logistic", "penalty=l2,C=1.0", CAT, NUM)
    from pyspark.ml import Pipeline
    est = MD.classifier("logistic")
    grid = dict(MD.param_grid("logistic", len(data), est))
    direct = Pipeline(stages=MD.feature_stages(CAT, NUM) + [est.copy(grid["penalty=l2,C=1.0"])]).fit(df)
    a, b = model.stages[-1].coefficients.toArray(), direct.stages[-1].coefficients.toArray()
    assert np.allclose(a, b, atol=1e-4)


def test_only_smaller_children_are_counted(monkeypatch):
    data = rows(3000, 11)
    d, n, pos = design(data, False)
    counted, count = [], CT.Design.histogram
    monkeypatch.setattr(CT.Design, "histogram", lambda self, at, cell, x, nodes: counted.append(len(cell)) or count(self, at, cell, x, nodes))
    tree, leaf = CT.grow(d, n, pos, pos, 6)
    assert counted[0] == len(data) and len(counted) > 3    # weights and targets in one pass
    assert all(c <= len(data) / 2 for c in counted[1:])
    assert sorted(np.unique(leaf)) == sorted(np.flatnonzero(tree.feature < 0))


def test_many_nodes_are_weighed_in_parts(monkeypatch):
    d, n, pos = design(rows(900, 12), True)
    residual = pos - n * 0.37                               # not whole: weights and targets apart
    for total, square in ((pos, pos), (residual, pos * 0.63 ** 2 + (n - pos) * 0.37 ** 2)):
        monkeypatch.setattr(CT, "NODES_AT_ONCE", 2048)
        want, leaf = CT.grow(d, n, total, square, 30)
        monkeypatch.setattr(CT, "NODES_AT_ONCE", 3)
        got, again = CT.grow(d, n, total, square, 30)
        assert (leaf == again).all() and all((getattr(want, c) == getattr(got, c)).all() for c in ("feature", "bound", "child"))


def test_each_fit_gets_a_partition_and_its_own_counts(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(*r, i % 3) for i, r in enumerate(rows(240, 9))], "a string, b string, x double, target int, k int")
    cells = CT.feature_cells(df, CAT, NUM, "target", "k", 3)
    grid = [(f"d{i}", dict(n_estimators=1, learning_rate=0.25, max_depth=i)) for i in range(1, 8)]
    out = CT.cross_validate(cells, "gbt", CAT, NUM, 3, grid)
    assert len({r.p for r in out.select(F.spark_partition_id().alias("p")).collect()}) == 21
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "rangepartitioning" not in plan


def test_shallower_forests_are_the_tops_of_deeper_ones():
    d, n, pos = design(rows(600, 6), True)
    depths = [2, 50, 4]
    shared = CT.fit_forests(d, n, pos, 7, depths, 2, 1)
    for depth, (trees, _, p) in zip(depths, shared, strict=True):
        want, _, q = CT.fit_forest(d, n, pos, 7, depth, 2, 1)
        assert (p == q).all()
        for a, b in zip(trees, want, strict=True):
            assert all((getattr(a, c) == getattr(b, c)).all() for c in ("feature", "bound", "child", "value"))


def test_settings_that_differ_in_depth_are_fitted_once(spark):
    names = [[name for name, _ in own] for own in CT._fits("random_forest", CT.tree_grid("random_forest"))]
    assert sorted(map(len, names)) == [2, 2, 2, 2] and len(CT._fits("gbt", CT.tree_grid("gbt"))) == 2
    df = spark.createDataFrame([(*r, i % 2) for i, r in enumerate(rows(300, 8))], "a string, b string, x double, target int, k int")
    cells = CT.feature_cells(df, CAT, NUM, "target", "k", 2)
    grid = [(f"m{m}d{k}", dict(n_estimators=3, max_depth=k, min_samples_split=2, min_samples_leaf=m)) for m in (1, 5) for k in (2, 9)]
    got = {(r["params"], r["_fold"]): (r["tp"], r["pp"]) for r in CT.cross_validate(cells, "random_forest", CAT, NUM, 2, grid).collect()}
    alone = {(r["params"], r["_fold"]): (r["tp"], r["pp"]) for one in grid
             for r in CT.cross_validate(cells, "random_forest", CAT, NUM, 2, [one]).collect()}
    assert len(got) == 8 and got == alone


def fits_here(monkeypatch, cells, kind, folds, grid):
    """What each fit is sent, and the fit as a call in this process."""
    from pyspark.sql.group import GroupedData
    caught = []
    with monkeypatch.context() as m:
        m.setattr(GroupedData, "applyInArrow", lambda self, f, schema: caught.append((f, self._df.toArrow())))
        CT.cross_validate(cells, kind, CAT, NUM, folds, grid)
    run, sent = caught[0]
    return [(part := sent.filter(pa.compute.equal(sent["fit"], k)), lambda part=part: run(part)) for k in range(len(set(sent["fit"].to_pylist())))]


@pytest.mark.parametrize("kind", ["random_forest", "gbt"])
def test_a_fit_holds_one_tree_at_a_time(spark, monkeypatch, kind):
    import tracemalloc
    r = random.Random(1)
    data = [(str(r.randrange(40)), str(r.randrange(30)), float(r.randrange(9)), r.randrange(2), i % 2) for i in range(20000)]
    cells = CT.feature_cells(spark.createDataFrame(data, "a string, b string, x double, target int, k int"), CAT, NUM, "target", "k", 2)

    def peak(trees):
        setting = dict(max_depth=60, min_samples_split=2, min_samples_leaf=1) if kind == "random_forest" else dict(max_depth=60, learning_rate=0.1)
        (_, fit), *_ = fits_here(monkeypatch, cells, kind, 2, [("one", dict(n_estimators=trees, **setting))])
        tracemalloc.start()
        try:
            assert fit().num_rows == 1
            return tracemalloc.get_traced_memory()[1]
        finally:
            tracemalloc.stop()

    peak(1)
    assert peak(30) < 1.3 * peak(3)


def test_fits_are_sent_blocks_of_codes(spark, monkeypatch):
    data = [(f"a long name of a level {i % 50}", f"another long name of a level {i // 50}", float(i % 7), i % 2, i % 3) for i in range(2500)]
    cells = CT.feature_cells(spark.createDataFrame(data, "a string, b string, x double, target int, k int"), CAT, NUM, "target", "k", 3)
    grid = [(f"d{i}", dict(n_estimators=1, learning_rate=0.25, max_depth=i)) for i in (1, 2)]
    fits = fits_here(monkeypatch, cells, "gbt", 3, grid)
    assert len(fits) == 6
    for sent, fit in fits:
        assert sent.num_rows <= cells.rdd.getNumPartitions() and sent.nbytes < 25 * 2500
        assert fit().num_rows == 1


def test_coded_features_make_the_same_design():
    nan = float("nan")
    names = {"a": pa.array(["z", None, "b", "a", None, "b"]), "b": pa.array([None] * 6, pa.string()),
             "x": pa.array([2.0, nan, None, -1.5, 2.0, nan])}
    table = pa.table(names | {"n": pa.array(range(6))})
    parts = [pa.table({c: t[c].dictionary_encode() if c != "n" else t[c] for c in t.column_names}) for t in (table[4:], table[:1], table[1:4])]
    want, got = CT.Design(table, CAT, NUM), CT.Design(pa.concat_tables(parts), CAT, NUM)
    assert want.values == got.values == [["a", "b", "z"], [], [-1.5, 2.0]]
    assert (want.codes == got.codes).all() and want.table["n"].to_pylist() == got.table["n"].to_pylist()
    assert dict(zip(want.table["n"].to_pylist(), want.codes.T.tolist(), strict=True)) == {
        0: [2, 0, 1], 1: [3, 0, 2], 2: [1, 0, 2], 3: [0, 0, 0], 4: [3, 0, 1], 5: [1, 0, 2]}


@pytest.mark.parametrize("most", [1, 40, 400])
def test_trees_do_not_depend_on_the_sums_that_are_kept(monkeypatch, most):
    d, n, pos = design(rows(2000, 13), True)
    want = CT.fit_forest(d, n, pos, 4, 40, 2, 1)
    monkeypatch.setattr(CT, "MOST_SUMS", most)
    got = CT.fit_forest(d, n, pos, 4, 40, 2, 1)
    assert (got[2] == want[2]).all()
    for a, b in zip(got[0], want[0], strict=True):
        assert all((getattr(a, c) == getattr(b, c)).all() for c in ("feature", "bound", "child", "value"))
