"""Centroids, embedding near-duplicates and the prefix trie against brute force."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from vigil.llm import centroids, embedding_dedup, prefix_trie, queries

ODD = [(None, [1.0] * 6), (900, None), (901, []), (902, [0.0] * 6), (903, [float("nan")] * 6), (904, [None] * 6), (905, [1e300] * 6),
       (906, [1e300] * 5 + [0.9e300]), (907, [1e-300] * 6), (908, [1.0, 2.0]), (909, [2.0, 4.1]), (910, [float("inf")] + [1.0] * 5)]


# ---- centroids -----------------------------------------------------------------------
def test_equal_average_search_is_exact_and_skips():
    r = np.random.default_rng(0)
    for _ in range(30):
        c, x = r.integers(-9, 9, (r.integers(1, 40), 8)), r.integers(-9, 9, (200, 8))
        number, distance = centroids.EqualAverageIndex(c).nearest(x)
        d = ((x[:, None] - c[None]) ** 2).sum(2)
        assert (distance == d.min(1)).all() and (number == d.argmin(1)).all()     # argmin: the smaller of ties
    c = r.integers(-5, 5, (64, 8)) + r.integers(-400, 400, (64, 1))               # means far apart
    index = centroids.EqualAverageIndex(c)
    index.nearest(c + 1)
    assert index.compared < 64 * 64 / 4


def whole(rows, dim, scale=64.0):
    return [(i, [math.floor(scale * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) and abs(math.floor(scale * x)) < 2 ** 27 for x in v)]


def brute_clusters(rows, k, rounds, dim):
    kept = whole(rows, dim)
    order = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    c = [v for _, v in order[:k]]
    nearest = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, m, strict=True)), j) for j, m in enumerate(c))
    for _ in range(rounds):
        own = defaultdict(list)
        for _, v in kept:
            own[nearest(v)[1]].append(v)
        c = [[sum(x) // len(own[j]) for x in zip(*own[j], strict=True)] if own[j] else m for j, m in enumerate(c)]
    at = [(i, *nearest(v)) for i, v in kept]
    inertia = defaultdict(int)
    for _, d, j in at:
        inertia[j] += d
    sha = lambda j: hashlib.sha256(",".join(map(str, c[j])).encode()).hexdigest()
    return sorted(str((i, j, d, inertia[j], sum(inertia.values()), sha(j))) for i, d, j in at)


@pytest.mark.parametrize("hot", [False, True])
def test_clusters_match_brute_force(spark, hot):
    r = np.random.default_rng(3)
    rows = [(i, r.normal(0, 0.4, 6).round(3).tolist()) for i in range(250)] + ODD + [(5, [0.1] * 6), (5, [0.1] * 6), (6, [0.2] * 6)]
    if hot:                                               # a third of the rows are one vector, a third have no id
        rows += [(1000 + i, rows[0][1]) for i in range(250)] + [(None, v) for _, v in rows[:250]]
    df = spark.createDataFrame([(*x, "c") for x in rows], "vec_id long, embedding array<double>, cluster string")
    for parts in (3, 7):
        got = centroids.cluster(df.repartition(parts), dim=6)
        assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
        assert sorted(str(tuple(x)) for x in got.collect()) == brute_clusters(rows, 16, 3, 6)


def test_clusters_of_few_or_no_vectors(spark):
    d = "vec_id long, embedding array<float>"
    assert centroids.cluster(spark.createDataFrame([], d)).count() == 0
    assert centroids.cluster(spark.createDataFrame([(1, None), (2, [1.0])], d), dim=3).count() == 0
    rows = [(1, [0.5, 0.25, 1.0]), (2, [1.0, 0.0, 0.0]), (2, [1.0, 0.0, 0.0])]
    got = centroids.cluster(spark.createDataFrame(rows, d), dim=3)
    assert sorted(str(tuple(x)) for x in got.collect()) == brute_clusters(rows, 16, 3, 3)


# ---- embedding near-duplicates --------------------------------------------------------
def test_bounds_hold():
    r = np.random.default_rng(1)
    u = embedding_dedup.unit_rows(np.concatenate([r.normal(size=(60, 64)), r.normal(size=(60, 64)) ** 9, np.eye(64)]))
    t = embedding_dedup.QuantisedTile(u)
    assert t.rows.dtype == np.int8
    about = (t.wide @ t.wide.T).astype(float) * (t.scale[:, None] * t.scale)
    assert (np.abs(about - u @ u.T) <= t.error[:, None] + (1 + t.error)[:, None] * t.error).all()
    near = np.concatenate([u, embedding_dedup.unit_rows(u + 0.45 / 8 * r.normal(size=u.shape))])
    t = embedding_dedup.QuantisedTile(near)
    found, full = embedding_dedup.linked(t, slice(0, len(near)), t, 0.9)
    assert (found == (near @ near.T >= 0.9)).all() and 0 < full < found.size / 20    # few pairs are computed in full


def brute_links(rows, least=0.9):
    n = len(rows)
    ok = [i is not None and v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v) for i, v in rows]
    unit = [np.array(v, float) / np.abs(v).max() if k else None for (_, v), k in zip(rows, ok, strict=True)]
    adj = np.zeros((n, n), bool)
    for a in range(n):
        for b in range(a):
            if ok[a] and ok[b] and len(unit[a]) == len(unit[b]):
                adj[a, b] = adj[b, a] = unit[a] @ unit[b] / math.sqrt((unit[a] @ unit[a]) * (unit[b] @ unit[b])) >= least
    label = np.arange(n)
    while True:
        new = np.array([min(label[i], label[adj[i]].min(initial=n)) for i in range(n)])
        if (new == label).all():
            break
        label = new
    out = []
    for i, (vec_id, _) in enumerate(rows):
        c = min(rows[j][0] for j in range(n) if label[j] == label[i]) if vec_id is not None else None
        out.append(str((vec_id, int(adj[i].sum()), c, vec_id == c)))
    return sorted(out)


@pytest.mark.parametrize("limits", [{}, {"tile_rows": 30, "sample_rows": 50}, {"tile_rows": 7, "sample_rows": 10, "max_cells": 3}])
def test_embedding_links_match_brute_force(spark, limits):
    r = np.random.default_rng(5)
    base = r.normal(size=(40, 6))
    rows = [(i, (base[i % 40] * r.uniform(.1, 9) + r.normal(size=6) * r.choice([0, .1, .5])).tolist()) for i in range(200)]
    rows += [(500 + i, rows[3][1]) for i in range(110)] + [(3, rows[9][1]), (None, rows[3][1]), (None, None)] + ODD
    df = spark.createDataFrame([(*x, "x") for x in rows], "vec_id long, embedding array<double>, node string").repartition(3)
    got = embedding_dedup.near_duplicates(df, **limits).select("vec_id", "n_links", "component_id", "kept").collect()
    assert sorted(str(tuple(x)) for x in got) == brute_links(rows)


def test_embedding_links_of_few_rows(spark):
    d = "vec_id long, embedding array<float>"
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], d)).count() == 0
    got = embedding_dedup.near_duplicates(spark.createDataFrame([(4, [0.0, 0.0]), (None, None)], d)).collect()
    assert sorted(map(str, map(tuple, got))) == ["(4, 0, 4, True)", "(None, 0, None, True)"]


# ---- prefix trie ----------------------------------------------------------------------
TURNS = "conv_id long, turn long, role string, text string"


def brute_trie(rows):
    conv, members, ends, below = defaultdict(list), defaultdict(list), defaultdict(list), defaultdict(set)
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    for c, t, role, text in rows:
        if c is not None:
            conv[c].append((t is not None, t or 0, md5(md5(role or "") + md5(text or "")), role or "", text or ""))
    conv = {c: [t[3:] for t in sorted(v)] for c, v in conv.items()}
    for c in conv:
        h = zlib.crc32(str(c).encode()) % 9
        turns = tuple(conv.get(c - int(math.fmod(c, 5)), [])[:h] + conv[c][h:])
        ends[turns].append(c)
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
            if d:
                below[turns[:d - 1]].add(turns[:d])
    leaves, saved = {}, {}
    for s in sorted(members, key=len, reverse=True):
        leaves[s] = sum(leaves[k] for k in below[s]) or 1
        saved[s] = sum(saved[k] for k in below[s]) + ((len(members[s]) - 1) * len(s[-1][1].encode()) if s else 0)
    return sorted(str((min(m), len(s), min(members[s[:-1]]) if s else None, len(m), len(below[s]), leaves[s], saved[s],
                       hashlib.sha256(",".join(map(str, sorted(ends[s]))).encode()).hexdigest())) for s, m in members.items())


def trie(df, **limits):
    return sorted(str(tuple(r)) for r in prefix_trie.prefix_trie(df, **limits).collect())


def test_double_array_holds_exactly_its_paths():
    r = random.Random(2)
    for m in (1, 3, 400):
        paths = sorted({tuple(r.randrange(m) for _ in range(r.randint(0, 6))) for _ in range(150)})
        start = np.concatenate([[0], np.cumsum([len(p) for p in paths])])
        t = prefix_trie.DoubleArray(np.array([c for p in paths for c in p], np.int64), start)
        prefixes = {p[:d] for p in paths for d in range(len(p) + 1)}
        assert (t.check[1:] >= 0).sum() == len(prefixes) - 1
        for p in prefixes:
            at = np.array([0])
            for c in p:
                at = t.step(at, np.array([c]))
            for c in range(m):
                assert (t.step(at, np.array([c]))[0] >= 0) == (p + (c,) in prefixes)


@pytest.mark.parametrize("limits", [{}, {"shard_turns": 50, "fan_in": 2}, {"shard_turns": 7, "fan_in": 3}])
def test_trie_matches_brute_force(spark, limits):
    r = random.Random(1)
    rows = [(c, t if r.random() < .9 else r.choice([None, 3]), r.choice(["user", "bot", None]), r.choice(["a", "é", "", None, "longer text", "b"]))
            for c in range(-30, 150) for t in range(r.randint(0, 7))]
    rows += [(c, t, "u", "same") for c in range(300, 400) for t in range(5)]          # one conversation many times
    rows += [(c, t, "u", f"x{t}") for c, n in ((1000, 400), (1005, 350)) for t in range(n)]   # very long ones
    rows += [(None, t, "u", "x") for t in range(300)] + [(7, 1, "u", "again")] * 3
    df = spark.createDataFrame([(*x, 1) for x in rows], TURNS + ", key int").repartition(3)
    assert trie(df, **limits) == brute_trie(rows)


def test_trie_of_one_hot_conversation(spark):
    rows = [(5, 1, "u", "a")] * 300 + [(None, 1, "u", "a")] * 300 + [(6, t, None, None) for t in range(12)]
    assert trie(spark.createDataFrame(rows, TURNS), shard_turns=40, fan_in=2) == brute_trie(rows)


def test_trie_of_few_rows(spark):
    assert trie(spark.createDataFrame([], TURNS)) == []
    for rows in ([(1, 0, "u", "a")], [(4, 0, "u", "a"), (0, 0, None, "")]):
        assert trie(spark.createDataFrame(rows, TURNS)) == brute_trie(rows)


# ---- registered queries ------------------------------------------------------------------
def test_queries_of_the_vector_and_trie_operators(spark):
    import pyarrow.parquet as pq
    sf = "/root/testdata/sf0.001"
    e = pq.read_table(f"{sf}/embeddings.parquet").to_pylist()
    rows = [(r["vec_id"], r["embedding"]) for r in e]
    assert sorted(str(tuple(r)) for r in queries.op11_centroids(spark, sf).collect()) == brute_clusters(rows, 16, 3, 64)
    got = queries.op12_embedding_dedup(spark, sf).select("vec_id", "n_links", "component_id", "kept").collect()
    assert sorted(str(tuple(r)) for r in got) == brute_links(rows)
    c = pq.read_table(f"{sf}/conversations.parquet").to_pylist()
    assert sorted(str(tuple(r)) for r in queries.op13_prefix_trie(spark, sf).collect()) == brute_trie(
        [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in c])
