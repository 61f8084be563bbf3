"""Centroid clustering with an equal-average equal-variance nearest search.

Centroids are sorted by the mean of their components. A vector scans outward
from its own mean; a side ends as soon as the difference of means alone is
more than the best distance (mean inequality), a centroid is skipped if the
difference of means and of deviations is (deviation inequality), and the rest
are compared exactly in whole numbers.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import finite_rows, importable, written

#: Whole components stay below this, so that a squared distance of 64 of them fits a long.
LARGEST = 2 ** 27


class EqualAverageIndex:
    """Nearest centroid by squared Euclidean distance, ties to the smaller number."""

    def __init__(self, centroids: np.ndarray):
        self.dim = centroids.shape[1]
        mean = centroids.sum(1) / self.dim
        self.number = np.argsort(mean, kind="stable")
        self.centroids, self.mean = centroids[self.number], mean[self.number]
        self.deviation = self._deviation(self.centroids, self.mean)
        self.compared = 0

    @staticmethod
    def _deviation(x: np.ndarray, mean: np.ndarray) -> np.ndarray:
        return np.sqrt(((x - mean[:, None]) ** 2).sum(1))

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number, squared distance) of the nearest centroid of each row. Both
        inequalities are tested with a slack above the rounding of doubles, and
        on equality the centroid is compared, so that ties are all seen."""
        n, k = len(x), len(self.centroids)
        mean = x.sum(1) / self.dim
        deviation = self._deviation(x, mean)
        right = np.searchsorted(self.mean, mean)
        left = right - 1
        best, who = np.full(n, np.iinfo(np.int64).max), np.full(n, k)
        todo = np.arange(n)
        while len(todo):
            to, m = (left[todo], right[todo]), mean[todo]
            gaps = (np.where(to[0] >= 0, m - self.mean[np.maximum(to[0], 0)], np.inf),
                    np.where(to[1] < k, self.mean[np.minimum(to[1], k - 1)] - m, np.inf))
            lower = gaps[0] <= gaps[1]
            by_mean = self.dim * np.minimum(*gaps) ** 2
            reach = best[todo] * (1 + 1e-9) + 1e-6
            on = by_mean <= reach                       # all other centroids lie farther out
            todo, lower, by_mean, reach = todo[on], lower[on], by_mean[on], reach[on]
            at = np.where(lower, to[0][on], to[1][on])
            left[todo] -= lower
            right[todo] += ~lower
            near = by_mean + (deviation[todo] - self.deviation[at]) ** 2 <= reach
            row, c = todo[near], at[near]
            self.compared += len(row)
            d = ((x[row] - self.centroids[c]) ** 2).sum(1)
            number = self.number[c]
            better = (d < best[row]) | ((d == best[row]) & (number < who[row]))
            best[row[better]], who[row[better]] = d[better], number[better]
        return who, best


def _whole(batch: pa.RecordBatch, dim: int, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and whole components of the vectors that take part."""
    rows, x = finite_rows(batch.column("embedding"), dim)
    with np.errstate(over="ignore"):
        x = np.floor(scale * x)
    fits = (np.abs(x) < LARGEST).all(1)
    return rows[fits], x[fits].astype(np.int64)


def _first_by_hash(k: int, dim: int, scale: float):
    """The ``k`` vectors of a task with the smallest hash."""
    def run(batches):
        held = []
        for b in batches:
            rows, x = _whole(b, dim, scale)
            hashes = b.column("hash").to_pylist()
            held = sorted([*held, *((hashes[r], v.astype(">i8").tobytes()) for r, v in zip(rows, x, strict=True)
                                    if hashes[r] is not None)])[:k]
        yield pa.RecordBatch.from_arrays([pa.array([h for h, _ in held], pa.string()), pa.array([v for _, v in held], pa.binary())],
                                         ["hash", "vec"])
    return run


def _sums(centroids: np.ndarray, scale: float):
    """For each cluster with vectors in the task: their number and their sum."""
    def run(batches):
        index = EqualAverageIndex(centroids)
        count, total = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64)
        for b in batches:
            _, x = _whole(b, centroids.shape[1], scale)
            cluster, _ = index.nearest(x)
            order = np.argsort(cluster, kind="stable")
            own, at, n = np.unique(cluster[order], return_index=True, return_counts=True)
            if len(own):
                total[own] += np.add.reduceat(x[order], at)
                count[own] += n
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array(count[some]), pa.array(list(total[some]), pa.list_(pa.int64()))], ["cluster", "n", "sums"])
    return run


def _assign(centroids: np.ndarray, scale: float):
    def run(batches):
        index = EqualAverageIndex(centroids)
        for b in batches:
            rows, x = _whole(b, centroids.shape[1], scale)
            cluster, distance = index.nearest(x)
            yield pa.RecordBatch.from_arrays([b.column("vec_id").take(pa.array(rows)), pa.array(cluster, pa.int32()), pa.array(distance)],
                                             ["vec_id", "cluster", "distance"])
    return run


def first_centroids(embeddings: DataFrame, k: int, dim: int, scale: float, salt: str) -> np.ndarray:
    """The ``k`` vectors (all, if fewer) with the smallest sha256 of
    ``<salt>:<vec_id>``, in that order; of equal ids the smaller vector first."""
    hashed = embeddings.select("embedding", F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256).alias("hash"))
    rows = (hashed.mapInArrow(_first_by_hash(k, dim, scale), "hash string, vec binary")
            .orderBy("hash", "vec").limit(k).collect())                      # k rows, a parameter
    return np.array([np.frombuffer(r["vec"], ">i8") for r in rows], np.int64).reshape(len(rows), dim)


def next_centroids(embeddings: DataFrame, centroids: np.ndarray, scale: float) -> np.ndarray:
    """One round: componentwise floor(sum / count) of each cluster's vectors; an
    empty cluster keeps its centroid. Each task sends one row per cluster, so a
    cluster of any size is summed where its vectors are; the driver gets a row
    per cluster and component."""
    parts = embeddings.mapInArrow(_sums(centroids, scale), "cluster int, n long, sums array<long>")
    summed = (parts.select("cluster", "n", F.posexplode("sums").alias("pos", "part")).groupBy("cluster", "pos")
              .agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")))
    out = centroids.copy()
    for r in summed.collect():
        out[r["cluster"], r["pos"]] = int(r["total"]) // r["n"]
    return out


def centroid_sha256(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def cluster(embeddings: DataFrame, k: int = 16, rounds: int = 3, dim: int = 64, scale: float = 64.0,
            salt: str = "1") -> DataFrame:
    """Columns vec_id, cluster, distance, cluster_inertia, inertia and
    centroid_sha256 for every vector of ``embeddings`` (vec_id, embedding; other
    columns are ignored) with ``dim`` components, none null or non-finite.

    A component x counts as floor(scale * x). ``first_centroids`` gives the
    first centroids, each of ``rounds`` rounds moves them, then vectors are
    assigned once more. Distances are squared; ties go to the smaller number.
    Vectors with a whole component of 2**27 or more, whose distances need not
    fit a long, take no part; sums of distances beyond a long are null.

    Every row counts by itself: rows that repeat in id or vector all take part
    and are all returned; a null vec_id takes part but is never a first centroid.
    Fewer than ``k`` vectors with ids give fewer centroids; none, or an empty
    table, give no rows.
    The rounds read the table itself again, whose rows never move: what is
    shuffled or broadcast has a row per cluster (and task or component).
    """
    spark = embeddings.sparkSession
    importable(spark)
    vectors = embeddings.select("embedding")
    centroids = first_centroids(embeddings, k, dim, scale, salt)
    if len(centroids):
        for _ in range(rounds):
            centroids = next_centroids(vectors, centroids, scale)
        assigned = written(embeddings.select("vec_id", "embedding").mapInArrow(
            _assign(centroids, scale), f"vec_id {embeddings.schema['vec_id'].dataType.simpleString()}, cluster int, distance long"), "centroids")
    else:
        assigned = embeddings.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")).limit(0)
    sums = {r["cluster"]: int(r["total"]) for r in assigned.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}           # a row per cluster
    fits = lambda n: n if n < 2 ** 63 else None
    totals = spark.createDataFrame([(c, fits(n), fits(sum(sums.values())), centroid_sha256(centroids[c])) for c, n in sums.items()],
                                   "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(totals), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
