"""Exact top-k search by a dual-tree cover-tree search.

Queries and data share the top of one tree, whose cells are learnt from a
bounded sample; each task then holds one group of queries and one block of
data, indexes both by cover trees and descends them together. A pair of nodes
is pruned if the largest inner product that the covering radii allow is below
the worst k-th score of the queries in the node.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.llm.common import importable, low_hash, written

_HITS = "vkey string, score long, first_id long, ids array<long>, own boolean"


class CoverTree:
    """Nodes of nested centres with measured covering radii.

    A node opens children around its own centre and the points farthest from
    the centres so far, until all points are within half its radius or
    ``fanout`` children are open; each point goes to the nearest. Radii are
    measured after that, so the bounds hold whether or not the net is complete.
    """

    def __init__(self, points: np.ndarray, fanout: int = 8, leaf: int = 96):
        self.points = points.astype(np.float64)
        self.order = np.arange(len(points))
        self.center, self.radius, self.span, self.children = [], [], [], []
        if len(points):
            self._open(np.arange(len(points)), 0, fanout, leaf)
        self.center = np.array(self.center, np.int64)
        self.radius = np.array(self.radius)
        self.norm = np.linalg.norm(self.points[self.center], axis=1) if len(points) else np.zeros(0)

    def _open(self, members: np.ndarray, center: int, fanout: int, leaf: int) -> int:
        """Nodes are made iteratively in preorder; members stay contiguous in ``order``."""
        todo = [(members, center, 0, None)]
        while todo:
            own, c, start, parent = todo.pop()
            node = len(self.center)
            if parent is not None:
                self.children[parent].append(node)
            distance = np.linalg.norm(self.points[own] - self.points[c], axis=1)
            radius = float(distance.max())
            self.center.append(c)
            self.radius.append(radius)
            self.span.append((start, start + len(own)))
            self.children.append([])
            if len(own) <= leaf or radius == 0:
                self.order[start:start + len(own)] = own
                continue
            nearest, best = np.zeros(len(own), np.int64), distance.copy()
            centers = [c]
            while len(centers) < fanout and best.max() > radius / 2:
                far = int(best.argmax())
                centers.append(int(own[far]))
                d = np.linalg.norm(self.points[own] - self.points[own[far]], axis=1)
                closer = d < best
                nearest[closer], best[closer] = len(centers) - 1, d[closer]
            at = start
            for i, child in enumerate(centers):
                part = own[nearest == i]
                todo.append((part, child, at, node))
                at += len(part)
        return 0


def _kind(a: np.ndarray, b: np.ndarray) -> type:
    """The number type in which all inner products are exact: floats (fast)
    while no sum can pass 2**53."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    return np.float64 if most < 2 ** 53 else np.int64


def _exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products as whole numbers."""
    kind = _kind(a, b)
    return (a.astype(kind) @ b.astype(kind).T).astype(np.int64)


def dual_tree_search(queries: np.ndarray, data: np.ndarray, ids: np.ndarray, k: int, floor: np.ndarray,
                     leaf: int = 96) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` best rows of ``data`` for each query by (score, smaller id):
    row numbers and scores, -1 where there are fewer that reach ``floor``, a
    lower bound of each query's k-th score that is known beforehand."""
    n = len(queries)
    best = np.full((n, k), -1, np.int64)
    score = np.full((n, k), np.iinfo(np.int64).min, np.int64)
    worst = floor.astype(np.float64).copy()
    if not n or not len(data):
        return best, score
    q, d = CoverTree(queries, leaf=leaf), CoverTree(data, leaf=leaf)
    queries, data = (x.astype(_kind(queries, data)) for x in (queries, data))
    slack = 1 + 1e-9 * (q.norm.max() + q.radius.max()) * (d.norm.max() + d.radius.max())
    node_worst = np.full(len(q.center), -np.inf)

    def refresh(node: int) -> None:
        a, b = q.span[node]
        node_worst[node] = worst[q.order[a:b]].min()

    for node in range(len(q.center)):
        refresh(node)

    def bounds(a: int, nodes: list[int]) -> np.ndarray:
        c = d.points[d.center[nodes]] @ q.points[q.center[a]]
        return c + q.radius[a] * d.norm[nodes] + d.radius[nodes] * q.norm[a] + q.radius[a] * d.radius[nodes] + slack

    def leaf_pair(a: int, b: int) -> None:
        rows, cols = q.order[slice(*q.span[a])], d.order[slice(*d.span[b])]
        s = (queries[rows] @ data[cols].T).astype(np.int64)
        for i in np.flatnonzero(s.max(1) >= worst[rows]):
            r = rows[i]
            new = cols[s[i] >= worst[r]]
            got = np.concatenate([best[r][best[r] >= 0], new])
            points = np.concatenate([score[r][best[r] >= 0], s[i][s[i] >= worst[r]]])
            pick = np.lexsort((ids[got], -points))[:k]
            best[r, :len(pick)], score[r, :len(pick)] = got[pick], points[pick]
            if len(pick) == k:
                worst[r] = max(worst[r], float(points[pick[-1]]))
        refresh(a)

    todo = [(0, 0, math.inf)]
    while todo:
        a, b, bound = todo.pop()
        if not q.children[a]:
            refresh(a)
        else:
            node_worst[a] = max(node_worst[a], min(node_worst[c] for c in q.children[a]))
        if bound < node_worst[a]:
            continue
        if not q.children[a] and not d.children[b]:
            leaf_pair(a, b)
        elif d.children[b] and (not q.children[a] or d.radius[b] >= q.radius[a]):
            children = d.children[b]
            upper = bounds(a, children)
            todo += [(a, children[i], upper[i]) for i in np.argsort(upper)]      # the best bound is visited first
        else:
            for c in q.children[a]:
                todo.append((c, b, bounds(c, [b])[0]))
    return best, score


def _vectors(blobs: list[bytes]) -> np.ndarray:
    """Equally long rows; shorter vectors are padded with zeros."""
    if not blobs:
        return np.zeros((0, 0), np.int64)
    parts = [np.frombuffer(b, "<i8") for b in blobs]
    out = np.zeros((len(parts), max(map(len, parts))), np.int64)
    for i, p in enumerate(parts):
        out[i, :len(p)] = p
    return out


def _padded(a: np.ndarray, width: int) -> np.ndarray:
    return np.pad(a, ((0, 0), (0, width - a.shape[1]))) if a.shape[1] < width else a


def _common(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    width = max(a.shape[1], b.shape[1])
    return _padded(a, width), _padded(b, width)


def _placer(pivots: np.ndarray, sample: np.ndarray, k: int):
    """Adds to each distinct vector its cell, its distance to the cell's pivot
    and a lower bound of its k-th best score, from the sample."""
    def run(batches):
        for b in batches:
            x = _vectors(b.column("vec").to_pylist())
            y, p = _common(x, pivots)
            s = _exact(*_common(x, sample))
            floor = np.partition(s, -k, axis=1)[:, -k].astype(np.float64) if sample.shape[0] >= k else np.full(len(x), -np.inf)
            y, p = y.astype(np.float64), p.astype(np.float64)
            far = np.sqrt(np.maximum((y * y).sum(1)[:, None] + (p * p).sum(1) - 2 * y @ p.T, 0))
            cell = far.argmin(1)
            own = np.linalg.norm(y - p[cell], axis=1)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(cell, pa.int32()), pa.array(own), pa.array(np.linalg.norm(y, axis=1)), pa.array(floor)],
                [*b.schema.names, "cell", "far", "norm", "floor"])
    return run


def _pack_batches(batches):
    for b in batches:
        lists = b.column("values")
        at = lists.offsets.to_numpy()
        flat = lists.flatten().to_numpy().astype("<i8")
        at = at - at[0] if len(at) else at
        yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array([flat[s:e].tobytes() for s, e in zip(at[:-1], at[1:], strict=True)], pa.binary())],
                                         ["vec_id", "vec"])


def whole_vectors(embeddings: DataFrame, scale: float = 256.0) -> DataFrame:
    """(vec_id, vec) with the components floor(scale * x) packed. Every
    different vector of a vec_id is a row; rows that repeat both count once.
    Vectors that are null or hold null or non-finite components, or such that an
    inner product need not fit 64 bits, and null ids take no part."""
    importable(embeddings.sparkSession)
    x = F.transform("embedding", lambda c: F.floor(F.lit(scale) * c.cast("double")))
    most = F.sqrt(F.lit(2.0 ** 62) / F.greatest(F.size("embedding"), F.lit(1)))
    fine = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.forall(
        "embedding", lambda c: F.coalesce(F.abs(c.cast("double") * F.lit(scale)) < most - 1, F.lit(False)))
    return (embeddings.where(fine).select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("values"))
            .mapInArrow(_pack_batches, "vec_id long, vec binary").distinct())


def _groups(counts: dict[int, int], most: int) -> dict[int, tuple[int, int]]:
    """Cells in tree order packed into groups of about ``most`` rows; a larger
    cell is a group of several parts: cell -> (group, parts)."""
    out, group, held = {}, 0, 0
    for cell in sorted(counts):
        n = counts[cell]
        if held and held + n > most:
            group, held = group + 1, 0
        out[cell] = (group, max(1, -(-n // most)))
        held += n
    parts = {}
    for g, p in out.values():
        parts[g] = max(parts.get(g, 1), p)
    return {c: (g, parts[g]) for c, (g, _) in out.items()}


def _searcher(k: int):
    def run(queries: pa.Table, data: pa.Table) -> pa.Table:
        schema = pa.schema([("vkey", pa.string()), ("score", pa.int64()), ("first_id", pa.int64()), ("ids", pa.list_(pa.int64())), ("own", pa.bool_())])
        if not queries.num_rows or not data.num_rows:
            return schema.empty_table()
        q, d = _common(_vectors(queries["vec"].to_pylist()), _vectors(data["data_vec"].to_pylist()))
        ids = data["data_first_id"].to_numpy()
        best, score = dual_tree_search(q, d, ids, k, queries["floor"].to_numpy())
        row, col = np.nonzero(best >= 0)
        hit = best[row, col]
        return pa.Table.from_arrays([queries["vkey"].take(pa.array(row)).combine_chunks(), pa.array(score[row, col]), pa.array(ids[hit]),
                                     data["data_ids"].take(pa.array(hit)).combine_chunks().cast(pa.list_(pa.int64())),
                                     pc.equal(queries["vkey"].take(pa.array(row)), data["data_vkey"].take(pa.array(hit))).combine_chunks()], schema=schema)
    return run


def search(vectors: DataFrame, is_query: Column, k: int = 5, sample_rows: int = 1024, cells: int = 64, most_cells: int = 1024,
           query_group: int = 32_768, data_block: int = 8_192, salts: int = 32) -> DataFrame:
    """The ``k`` best inner products of each query among all other rows.

    ``vectors`` is as ``whole_vectors`` returns it; ``is_query`` picks the
    queries by vec_id. Returns query_id, rank (from 1), vec_id, score; ties go
    to the smaller vec_id; fewer rows if the table has fewer. Another vector of
    the query's own vec_id is a row like others, and each vector of a repeated
    query is asked by itself. Vectors of unequal
    length compare as if padded with zeros. Equal vectors are searched once:
    only their k+1 smallest ids can be among anyone's k best, which are taken
    by salted ranking, so that one vector may be a third of the table.

    ``sample_rows`` vectors, drawn by hash, give the pivots of about ``cells``
    cells and first lower bounds; with more than ``cells`` blocks of data both
    grow in proportion, up to ``most_cells`` (the bound of what the driver holds).
    All rows are indexed and every answer is exact.
    """
    spark = vectors.sparkSession
    rows = vectors.withColumn("vkey", F.sha2("vec", 256))
    salted = Window.partitionBy("vkey", "_salt").orderBy("vec_id")
    ranked = Window.partitionBy("vkey").orderBy("vec_id")
    few = (rows.withColumn("_salt", F.pmod(F.xxhash64("vec_id"), F.lit(salts)))
           .withColumn("_r", F.row_number().over(salted)).where(F.col("_r") <= k + 1)
           .withColumn("_r", F.row_number().over(ranked)).where(F.col("_r") <= k + 1))
    classes = few.groupBy("vkey").agg(F.min("vec").alias("vec"), F.array_sort(F.collect_list("vec_id")).alias("ids"))
    asked = rows.where(is_query).select("vkey").distinct().withColumn("asked", F.lit(True))
    classes = written(classes.join(asked, "vkey", "left").withColumn("asked", F.coalesce("asked", F.lit(False)))
                      .withColumn("first_id", F.col("ids")[0]), "topk-classes")

    count = classes.count()
    grown = min(max(cells, -(-count // data_block)), max(cells, most_cells))
    sample_rows, cells = sample_rows * grown // cells, grown
    data_block = min(data_block, max(1024, -(-count // 32)))      # a small table is some tasks, too
    # of about twice as many those with the lowest digests, so that no task sends that many
    drawn = classes.where(low_hash(F.col("vkey"), 2 * (sample_rows + 100) / max(1, count)))
    sample = _vectors([r["vec"] for r in drawn.select("vec", "vkey").orderBy("vkey").limit(sample_rows).collect()])
    tree = CoverTree(sample, leaf=max(2, len(sample) // cells))
    leaves = [i for i, c in enumerate(tree.children) if not c]
    pivots = sample[tree.center[leaves]] if leaves else np.zeros((1, sample.shape[1]), np.int64)
    schema = "vkey string, vec binary, ids array<long>, asked boolean, first_id long, cell int, far double, norm double, floor double"
    placed = written(classes.mapInArrow(_placer(pivots, sample, k + 1), schema), "topk-placed")

    # a row per cell: at most ``sample_rows``
    stats = placed.groupBy("cell", "asked").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("far"), F.min("floor").alias("floor")).collect()
    data_n, query_n, radius, q_radius, floor = {}, {}, {}, {}, {}
    for r in stats:
        c = r["cell"]
        data_n[c] = data_n.get(c, 0) + r["n"]
        radius[c] = max(radius.get(c, 0.0), r["far"])
        if r["asked"]:
            query_n[c], q_radius[c], floor[c] = r["n"], r["far"], r["floor"]
    q_group, d_group = _groups(query_n, query_group), _groups(data_n, data_block)
    norm = np.linalg.norm(pivots.astype(np.float64), axis=1)
    dots = pivots.astype(np.float64) @ pivots.astype(np.float64).T
    asked_cells, data_cells = np.array(sorted(query_n), np.int64), np.array(sorted(data_n), np.int64)
    q_far, d_far = np.array([q_radius[c] for c in asked_cells]), np.array([radius[c] for c in data_cells])
    q_norm, d_norm = norm[asked_cells], norm[data_cells]
    bound = (dots[np.ix_(asked_cells, data_cells)] + q_far[:, None] * d_norm + d_far * q_norm[:, None] + q_far[:, None] * d_far
             + 1 + 1e-9 * (q_norm + q_far)[:, None] * (d_norm + d_far))
    meet = np.argwhere(bound >= np.array([floor[c] for c in asked_cells])[:, None])
    pairs = {(q_group[a], d_group[b]) for a, b in zip(asked_cells[meet[:, 0]].tolist(), data_cells[meet[:, 1]].tolist(), strict=True)}
    grouped = lambda groups: spark.createDataFrame([(c, g, p) for c, (g, p) in groups.items()], "cell int, g int, parts int")
    plan = spark.createDataFrame([(a[0], a[1], b[0], b[1]) for a, b in sorted(pairs)], "qg int, qparts int, dg int, dparts int")
    part = F.pmod(F.xxhash64("vkey"), F.col("parts")).cast("int")
    # both lists have a row per cell or pair of cells, so a bounded size
    q = (placed.where("asked").join(F.broadcast(grouped(q_group)), "cell").withColumn("qp", part)
         .join(F.broadcast(plan), F.col("g") == F.col("qg"))
         .withColumn("dp", F.explode(F.sequence(F.lit(0), F.col("dparts") - 1))).select("qg", "qp", "dg", "dp", "vkey", "vec", "floor"))
    d = (placed.join(F.broadcast(grouped(d_group)), "cell").withColumn("dp", part)
         .join(F.broadcast(plan), F.col("g") == F.col("dg"))
         .withColumn("qp", F.explode(F.sequence(F.lit(0), F.col("qparts") - 1))).select("qg", "qp", "dg", "dp", "vkey", "vec", "first_id", "ids"))
    keys = ["qg", "qp", "dg", "dp"]
    d = d.toDF(*(f"data_{c}" for c in d.columns))            # both sides come from one table
    hits = q.groupBy(*keys).cogroup(d.groupBy(*(f"data_{c}" for c in keys))).applyInArrow(_searcher(k + 1), _HITS)

    best = Window.partitionBy("vkey").orderBy(F.col("score").desc(), "first_id")
    merged = (hits.withColumn("_r", F.row_number().over(best)).where(F.col("_r") <= k + 1)
              .withColumn("found", F.transform("ids", lambda i: F.struct(
                  (-F.col("score")).alias("minus"), i.alias("vec_id"), F.col("own").alias("own"))))
              .groupBy("vkey").agg(F.slice(F.array_sort(F.flatten(F.collect_list("found"))), 1, k + 1).alias("found")))
    answers = rows.where(is_query).select(F.col("vec_id").alias("query_id"), "vkey").join(merged, "vkey")
    others = F.slice(F.filter("found", lambda f: ~(f["own"] & (f["vec_id"] == F.col("query_id")))), 1, k)
    return answers.select("query_id", F.posexplode(others).alias("pos", "hit")).select(
        "query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.minus")).alias("score"))
