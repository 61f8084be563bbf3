"""Embedding near-duplicates by int8 quantised tile products.

Unit vectors are rounded to int8 with one scale each, and the length of every
rounding error is kept. The product of two tiles of int8 vectors then bounds
each cosine from both sides; only pairs whose bounds lie on different sides of
the threshold are computed again from the full vectors.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import finite_rows, importable, low_hash, written
from vigil.llm.components import components

#: Larger than any rounding of doubles in a product of two unit vectors here.
SLACK = 1e-9


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows divided by their lengths. Powers of two are taken out first (that is
    exact), so that no square overflows or vanishes."""
    _, power = np.frexp(np.abs(x).max(1, initial=0))
    x = np.ldexp(x, -power[:, None])
    return x / np.sqrt((x * x).sum(1))[:, None]


class QuantisedTile:
    """Unit vectors as int8 rows with a scale and an error bound each.

    u = scale * q + e with |e| <= error. For two of them the true product
    differs from scale * scale' * (q . q') by at most
    |e| |v| + |scale * q| |e'| <= error + (1 + error) * error'.
    """

    def __init__(self, unit: np.ndarray):
        self.unit = unit
        self.scale = np.abs(unit).max(1, initial=0) / 127
        self.rows = np.rint(unit / self.scale[:, None]).astype(np.int8)
        lost = unit - self.scale[:, None] * self.rows
        self.error = np.sqrt((lost * lost).sum(1)) * (1 + SLACK) + SLACK
        # whole sums below 2**24 are exact in single precision
        self.wide = self.rows.astype(np.float32 if 127 * 127 * unit.shape[1] < 2 ** 24 else np.float64)

    def part(self, rows: slice) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        return self.unit[rows], self.scale[rows], self.error[rows], self.wide[rows]


def linked(a: QuantisedTile, rows: slice, b: QuantisedTile, least: float) -> tuple[np.ndarray, int]:
    """Which pairs of some rows of ``a`` and all of ``b`` have a cosine of at
    least ``least``, and how many were computed in full."""
    unit, scale, error, wide = a.part(rows)
    about = (wide @ b.wide.T).astype(np.float64) * (scale[:, None] * b.scale)
    off = error[:, None] + (1 + error)[:, None] * b.error
    found = about - off >= least
    i, j = np.nonzero((about + off >= least) & ~found)
    for at in range(0, len(i), 65_536):
        r, c = i[at:at + 65_536], j[at:at + 65_536]
        found[r, c] = (unit[r] * b.unit[c]).sum(1) >= least
    return found, len(i)


def _joined(found: np.ndarray, row_label: np.ndarray, col_label: np.ndarray, merge) -> None:
    """Unites the ends of all links: ``merge`` gets the labels that one
    component of the bipartite graph holds."""
    rows, cols = np.flatnonzero(found.any(1)), np.flatnonzero(found.any(0))
    small = found[np.ix_(rows, cols)]
    new_rows = np.ones(len(rows), bool)
    new_cols = np.ones(len(cols), bool)
    for first in range(len(rows)):
        if not new_rows[first]:
            continue
        front, own_rows, own_cols = np.array([first]), [], []
        new_rows[first] = False
        while len(front):                               # each row and column is opened once
            own_rows.append(front)
            reached = np.flatnonzero(small[front].any(0) & new_cols)
            new_cols[reached] = False
            own_cols.append(reached)
            front = np.flatnonzero(small[:, reached].any(1) & new_rows) if len(reached) else reached
            new_rows[front] = False
        merge(np.concatenate([row_label[rows[np.concatenate(own_rows)]], col_label[cols[np.concatenate(own_cols)]]]))


class _Sets:
    """Union-find over positions."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def merge(self, members: np.ndarray) -> None:
        roots = {self.find(int(i)) for i in members}
        self.parent[list(roots)] = min(roots)

    def roots(self) -> np.ndarray:
        return np.array([self.find(i) for i in range(len(self.parent))], np.int64)


def tile_links(a: np.ndarray, weight_a: np.ndarray, b: np.ndarray | None, weight_b: np.ndarray | None, least: float,
               strip: int = 1024) -> tuple[np.ndarray, np.ndarray, int]:
    """Links between the unit rows of two tiles (``b`` None: within one): how
    much weight each row of both is linked to, and the position (over both) of
    the first row that its links reach in the tiles. No list of pairs is made: a
    strip of rows is compared at a time, and its links are counted and united."""
    left = QuantisedTile(a)
    right, own = (left, True) if b is None else (QuantisedTile(b), False)
    n, shift = len(a), 0 if own else len(a)
    total = np.zeros(shift + len(right.unit), np.int64)
    weights = weight_a if own else weight_b
    sets, full = _Sets(len(total)), 0
    for start in range(0, n, strip):
        rows = slice(start, min(n, start + strip))
        found, again = linked(left, rows, right, least)
        if own:                                           # each pair once, and no row with itself
            found &= np.arange(len(right.unit)) > np.arange(rows.start, rows.stop)[:, None]
        full += again
        if found.any():
            total[rows] += found @ weights
            total[shift:] += weight_a[rows] @ found
            _joined(found, np.arange(rows.start, rows.stop), shift + np.arange(len(right.unit)), sets.merge)
    return total, sets.roots(), full


def _pack(batches):
    """vec_id, dim and the bytes of the vectors that can link."""
    for b in batches:
        lists, ids = b.column("embedding"), b.column("vec_id")
        lengths = lists.value_lengths()
        for dim in sorted(set(lengths.drop_null().to_pylist())):
            rows, x = finite_rows(lists, dim)
            some = (x != 0).any(1)
            rows, x = rows[some], x[some]
            if len(rows):
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(rows)), pa.array([dim] * len(rows), pa.int32()),
                                                  pa.array([v.tobytes() for v in x.astype("<f8")], pa.binary())], ["vec_id", "dim", "vec"])


def _far_apart(sample: np.ndarray, n: int) -> np.ndarray:
    """``n`` rows of the sample (fewer, if they repeat), each the farthest from those before."""
    picked, near = [0], sample @ sample[0]
    while len(picked) < min(n, len(sample)) and near.min() < 1 - 1e-9:
        picked.append(int(near.argmin()))
        near = np.maximum(near, sample @ sample[picked[-1]])
    return sample[picked]


def _angle(cosine: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosine, -1, 1))


def _placer(pivots: dict[int, np.ndarray], first_cell: dict[int, int]):
    """Adds the cell of the nearest pivot and the angle to it."""
    def run(batches):
        for b in batches:
            dims = b.column("dim").to_numpy()
            cell, angle = np.zeros(len(dims), np.int32), np.zeros(len(dims))
            blobs = b.column("vec").to_pylist()
            for dim in np.unique(dims):
                own = np.flatnonzero(dims == dim)
                if int(dim) not in pivots:                # no vector of this length is in the sample
                    cell[own], angle[own] = -int(dim), 0.0
                    continue
                c = unit_rows(np.frombuffer(b"".join(blobs[i] for i in own), "<f8").reshape(len(own), dim)) @ pivots[int(dim)].T
                cell[own] = first_cell[int(dim)] + c.argmax(1)
                angle[own] = _angle(c.max(1))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell, pa.int32()), pa.array(angle)], [*b.schema.names, "cell", "angle"])
    return run


def _unit(table: pa.Table, dim: int) -> np.ndarray:
    return unit_rows(np.frombuffer(b"".join(table["vec"].to_pylist()), "<f8").reshape(table.num_rows, dim))


def _comparer(least: float):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        schema = pa.schema([("node", pa.string()), ("n_links", pa.int64()), ("root", pa.string())])
        if not left.num_rows or not right.num_rows and left["ta"][0].as_py() != left["tb"][0].as_py():
            return schema.empty_table()
        dim = left["dim"][0].as_py()
        own = left["ta"][0].as_py() == left["tb"][0].as_py()
        other = None if own else _unit(right.rename_columns([c.removeprefix("r_") for c in right.column_names]), dim)
        total, root, _ = tile_links(_unit(left, dim), left["n"].to_numpy(), other, None if own else right["r_n"].to_numpy(), least)
        nodes = left["node"].to_pylist() + ([] if own else right["r_node"].to_pylist())
        some = np.flatnonzero(total)
        return pa.table([pa.array([nodes[i] for i in some], pa.string()), pa.array(total[some]),
                         pa.array([nodes[i] for i in root[some]], pa.string())], schema=schema)
    return run


def _tile_plan(stats: list, pivots: dict[int, np.ndarray], first_cell: dict[int, int], reach: float, tile_rows: int):
    """(parts of each cell, its first tile) and the cell pairs that a link can
    span: their pivots' angle is at most the cells' radii and ``reach`` more."""
    n = {r["cell"]: r["n"] for r in stats}
    radius = {r["cell"]: r["angle"] for r in stats}
    parts, tiles, at = {}, {}, 0
    for c in sorted(n):
        parts[c], tiles[c] = -(-n[c] // tile_rows), at
        at += parts[c]
    pairs = [(c, c) for c in n if c < 0]
    for dim, p in pivots.items():
        cells = np.array([c for c in sorted(n) if first_cell[dim] <= c < first_cell[dim] + len(p)], np.int64)
        if len(cells):
            own, far = p[cells - first_cell[dim]], np.array([radius[c] for c in cells])
            meet = _angle(own @ own.T) <= far[:, None] + far + reach + 1e-6
            np.fill_diagonal(meet, True)
            i, j = np.nonzero(np.triu(meet))
            pairs += list(zip(cells[i].tolist(), cells[j].tolist(), strict=True))
    return parts, tiles, pairs


def near_duplicates(embeddings: DataFrame, least: float = 0.9, tile_rows: int = 4096, sample_rows: int = 8192,
                    max_cells: int = 2048) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row of ``embeddings``
    (vec_id, embedding; other columns are ignored).

    Two vectors of equal length link if their cosine in doubles is at least
    ``least`` (above 0); ``n_links`` counts the others that a vector links with
    directly, ``component_id`` is the smallest vec_id that links reach, and
    ``kept`` tells whether that is its own. Vectors that are null, empty, zero or
    hold null or non-finite components link with nothing. Every row is a vector:
    rows that repeat an id or a vector count as often as they come. Rows without
    vec_id link with nothing, have no component_id and are kept. An empty table
    gives no rows.

    Equal vectors are one class, however many there are, and only classes are
    compared. Every two tiles are compared whose cells can hold a link: cells
    are the nearest of up to ``max_cells`` pivots out of a sample of
    ``sample_rows`` vectors (bounds of what the driver holds, not of what is
    compared), and two cells are left out only if their pivots' angle exceeds
    both radii and the threshold's angle. On vectors without clusters no pair
    of cells can be left out, and the work is the square of the classes. A pair of
    tiles returns a row per vector with links, never the pairs.
    """
    spark = embeddings.sparkSession
    importable(spark)
    given = embeddings.select("vec_id", "embedding")
    rows = (given.where(F.col("vec_id").isNotNull()).mapInArrow(_pack, "vec_id long, dim int, vec binary")
            .withColumn("node", F.md5("vec")))
    classes = written(rows.groupBy("node", "dim", "vec").agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("least_id")), "tiles-classes")

    count = classes.count()
    # of about twice as many the sample_rows with the lowest digests, so that no task sends that many
    drawn = classes.where(low_hash(F.col("node"), 2 * (sample_rows + 100) / max(1, count)))
    sample = drawn.select("dim", "vec", "node").orderBy("node").limit(sample_rows).collect()
    cells = min(max_cells, -(-count // tile_rows))
    pivots, first_cell, at = {}, {}, 0
    for dim in sorted({r["dim"] for r in sample}):
        own = unit_rows(np.array([np.frombuffer(r["vec"], "<f8") for r in sample if r["dim"] == dim]))
        pivots[dim], first_cell[dim] = _far_apart(own, max(1, cells)), at
        at += len(pivots[dim])
    placed = written(classes.mapInArrow(_placer(pivots, first_cell), "node string, dim int, vec binary, n long, least_id long, cell int, angle double"),
                     "tiles-placed")
    stats = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("angle").alias("angle")).collect()      # a row per cell
    parts, tiles, pairs = _tile_plan(stats, pivots, first_cell, float(np.arccos(least)), tile_rows)

    # both lists have a row per cell or pair of cells, which max_cells bounds
    layout = spark.createDataFrame([(c, parts[c], tiles[c]) for c in parts], "cell int, parts int, first int")
    plan = spark.createDataFrame([(a, b, parts[b], tiles[b]) for a, b in pairs], "ca int, cb int, cb_parts int, cb_first int")
    back = spark.createDataFrame([(b, a, parts[a], tiles[a]) for a, b in pairs], "cb int, ca int, ca_parts int, ca_first int")
    tiled = placed.select("node", "dim", "vec", "n", "cell").join(F.broadcast(layout), "cell").withColumn(
        "tile", (F.col("first") + F.pmod(F.xxhash64("node"), F.col("parts"))).cast("int"))
    upto = lambda first, parts: F.explode(F.sequence(F.col(first), F.col(first) + F.col(parts) - 1))
    left = (tiled.join(F.broadcast(plan), F.col("cell") == F.col("ca")).withColumn("tb", upto("cb_first", "cb_parts"))
            .where(F.col("tb") >= F.col("tile")).select(F.col("tile").alias("ta"), "tb", "node", "dim", "vec", "n"))
    right = (tiled.join(F.broadcast(back), F.col("cell") == F.col("cb")).withColumn("ta", upto("ca_first", "ca_parts"))
             .where(F.col("ta") < F.col("tile")).select("ta", F.col("tile").alias("tb"), "node", "vec", "n"))
    right = right.toDF(*(f"r_{c}" for c in right.columns))
    links = written(left.groupBy("ta", "tb").cogroup(right.groupBy("r_ta", "r_tb")).applyInArrow(
        _comparer(least), "node string, n_links long, root string"), "tiles-links")

    named = components(links.select("node", "root").distinct(), "node", "root")
    members = written(classes.select("node", "least_id").join(named, "node"), "tiles-members")
    # written before it is joined, so that the rows of a large component can be split over tasks
    least_ids = written(members.groupBy("component").agg(F.min("least_id").alias("component_id")), "tiles-components")
    labelled = members.join(least_ids, "component").select("node", "component_id")
    found = written(classes.select("node", "n", "least_id")
                    .join(links.groupBy("node").agg(F.sum("n_links").alias("other")), "node", "left")
                    .join(labelled, "node", "left").select(
        "node", (F.coalesce("other", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        F.coalesce("component_id", "least_id").alias("component_id")), "tiles-found")
    linked_rows = rows.select("vec_id", "node").join(found, "node").select("vec_id", "n_links", "component_id")
    out = linked_rows.unionByName(given.mapInArrow(_unlinked, "vec_id long").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def _unlinked(batches):
    """Ids of the rows that ``_pack`` leaves out, and null ids."""
    for b in batches:
        lists, ids = b.column("embedding"), b.column("vec_id")
        alone = np.ones(b.num_rows, bool)
        for dim in sorted(set(lists.value_lengths().drop_null().to_pylist())):
            rows, x = finite_rows(lists, dim)
            alone[rows[(x != 0).any(1)]] = False
        alone |= ids.is_null().to_numpy(zero_copy_only=False)
        yield pa.RecordBatch.from_arrays([ids.filter(pa.array(alone))], ["vec_id"])
