"""Conversation prefix trie as double arrays, one per shard of the prefixes.

Distinct turn sequences are sorted and dealt into runs, the shards. Within a
shard turns get dense ids and its trie is packed into two arrays: the child of
node s by turn c is node t = BASE[s] + c if CHECK[t] = s. All sequences walk
the arrays at once, a turn a step, and leave their numbers at the nodes.

Sorted runs share only the nodes above their first and last sequence. Those are
merged over groups of neighbouring shards, then groups of groups, until the
root is whole.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import importable, written

ROOT_KEY = bytes(16)
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()

_NODE = [("final", pa.bool_()), ("key", pa.binary()), ("parent_key", pa.binary()), ("conv_id", pa.int64()), ("depth", pa.int64()),
         ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()),
         ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()), ("bytes", pa.int64()), ("part", pa.int64()), ("run", pa.int64()),
         ("on_first", pa.bool_()), ("on_last", pa.bool_())]
_SCHEMA = pa.schema(_NODE)
_DDL = ("final boolean, key binary, parent_key binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
        "n_leaves long, saved_tokens long, ends_sha256 string, bytes long, part long, run long, on_first boolean, on_last boolean")


class DoubleArray:
    """A trie over sequences of dense ids 0..m-1, packed into BASE and CHECK.

    Built a level at a time: nodes with one child take the free cells in order
    (their base follows from the cell), nodes with more take the first base at
    which the cells of all children are free."""

    def __init__(self, codes: np.ndarray, start: np.ndarray):
        """``codes`` holds the sequences one after the other; sequence i is
        codes[start[i]:start[i + 1]]."""
        self.m = int(codes.max(initial=-1)) + 1
        self.base = np.zeros(1024 + self.m, np.int64)
        self.check = np.full(1024 + self.m, -1, np.int64)
        self.check[0] = 0                                  # the root is node 0
        self._free = 1                                     # every cell before it is taken
        length = np.diff(start)
        live, state = np.flatnonzero(length > 0), np.zeros(len(length), np.int64)
        depth = 0
        while len(live):
            code = codes[start[live] + depth]
            edge, back = np.unique(state[live] * self.m + code, return_inverse=True)
            state[live] = self._place(edge // self.m, edge % self.m)[back]
            depth += 1
            live = live[length[live] > depth]

    def _grow(self, cells: int) -> None:
        more = cells - len(self.check)
        if more > 0:
            more = max(more, len(self.check))
            self.base = np.concatenate([self.base, np.zeros(more, np.int64)])
            self.check = np.concatenate([self.check, np.full(more, -1, np.int64)])

    def _place(self, parent: np.ndarray, code: np.ndarray) -> np.ndarray:
        """Cells of the children (parent, code), which come sorted by both."""
        nodes, at, n = np.unique(parent, return_index=True, return_counts=True)
        cell = np.zeros(len(parent), np.int64)
        for node, first, many in zip(nodes[n > 1].tolist(), at[n > 1].tolist(), n[n > 1].tolist(), strict=True):
            own = code[first:first + many]
            self.base[node] = base = self._fit(own)
            cell[first:first + many] = base + own
            self.check[base + own] = node
        alone = at[n == 1]
        if len(alone):
            taken = self._free_cells(len(alone))
            self.base[nodes[n == 1]] = taken - code[alone]
            cell[alone] = taken
            self.check[taken] = nodes[n == 1]
        return cell

    def _free_cells(self, n: int) -> np.ndarray:
        """The first ``n`` free cells."""
        window = 4 * n + 64
        while True:
            self._grow(self._free + window)
            free = self._free + np.flatnonzero(self.check[self._free:self._free + window] < 0)
            if len(free) >= n:
                self._free = int(free[n - 1]) + 1
                return free[:n]
            window *= 2

    def _fit(self, codes: np.ndarray) -> int:
        """The first base, from the free cells on, at which all cells are free."""
        while self._free < len(self.check) and self.check[self._free] >= 0:
            self._free += 1
        low, window = self._free - int(codes[0]), 256
        while True:
            self._grow(low + window + int(codes[-1]) + 1)
            bases = low + np.arange(window)
            bases = bases[bases + codes[0] > 0]
            for c in codes.tolist():
                bases = bases[self.check[bases + c] < 0]
                if not len(bases):
                    break
            if len(bases):
                return int(bases[0])
            low, window = low + window, min(2 * window, 1 << 16)

    def step(self, state: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The children of the states by the codes, -1 where there is none."""
        cell = self.base[state] + code
        found = (cell > 0) & (cell < len(self.check))
        found[found] = self.check[cell[found]] == state[found]
        return np.where(found, cell, -1)


def _turn_hash(key: bytes, turn: bytes) -> bytes:
    return hashlib.md5(key + turn).digest()


def shard_nodes(part: int, run: int, turns: list[list[bytes]], sizes: list[list[int]], n: np.ndarray, least: np.ndarray,
                ends: list[str]) -> pa.Table:
    """Node rows of one shard: sorted distinct sequences of turn digests with
    the bytes of each turn's text, their numbers of conversations, least ids and
    digests of ids. Nodes on the paths of the first and last sequence may go on
    in a neighbour and are returned as parts; their numbers then hold only what
    lies in this shard: ``n_children``, ``n_leaves`` and ``saved_tokens`` are those
    of the children that are whole."""
    length = np.array([len(t) for t in turns], np.int64)
    start = np.concatenate([[0], np.cumsum(length)])
    flat = [d for t in turns for d in t]
    dense = {d: i for i, d in enumerate(sorted(set(flat)))}
    codes = np.fromiter((dense[d] for d in flat), np.int64, len(flat))
    size = np.fromiter((s for t in sizes for s in t), np.int64, len(flat))
    trie = DoubleArray(codes, start)

    cells = len(trie.check)
    convs, first_id, text = np.zeros(cells, np.int64), np.full(cells, np.iinfo(np.int64).max), np.zeros(cells, np.int64)
    depth, end = np.zeros(cells, np.int64), np.full(cells, -1, np.int64)
    edge = {0: np.zeros(cells, bool), len(turns) - 1: np.zeros(cells, bool)}
    order = []                                               # nodes by depth, in sorted order within one
    live, state, d = np.arange(len(turns)), np.zeros(len(turns), np.int64), 0
    while True:
        here = state[live]
        fresh = np.concatenate([[True], here[1:] != here[:-1]])   # sequences are sorted: a node's are neighbours
        nodes, first = here[fresh], np.flatnonzero(fresh)
        convs[nodes] = np.add.reduceat(n[live], first)
        first_id[nodes] = np.minimum.reduceat(least[live], first)
        depth[nodes] = d
        if d:
            text[nodes] = size[start[live[first]] + d - 1]
        for s, on in edge.items():
            on[here[live == s]] = True
        done = length[live] == d
        end[here[done]] = live[done]
        order.append(nodes)
        live = live[~done]
        if not len(live):
            break
        state[live] = trie.step(state[live], codes[start[live] + d])
        d += 1

    on_first, on_last = edge[0], edge[len(turns) - 1]
    open_ = on_first | on_last
    children, leaves, saved = (np.zeros(cells, np.int64) for _ in range(3))
    for nodes in reversed(order):                            # children come before their parents
        whole = nodes[~open_[nodes]]
        leaves[whole] += children[whole] == 0
        saved[whole] += (convs[whole] - 1) * text[whole]
        up = trie.check[whole[whole > 0]]
        np.add.at(children, up, 1)
        np.add.at(leaves, up, leaves[whole])
        np.add.at(saved, up, saved[whole])

    key = {0: ROOT_KEY}
    for s in edge:
        at = 0
        for c, digest in zip(codes[start[s]:start[s + 1]].tolist(), turns[s], strict=True):
            at, up = int(trie.base[at]) + c, at
            key[at] = _turn_hash(key[up], digest)
    nodes = np.concatenate(order)
    inner = ~open_[nodes]
    parent = trie.check[nodes]
    parent_open = open_[parent] & (nodes > 0)
    texts = np.array([*ends, EMPTY_SHA256], object)
    return pa.table([
        pa.array(inner), pa.array([key.get(i) for i in nodes.tolist()], pa.binary()),
        pa.array([key[p] if o else None for p, o in zip(parent.tolist(), parent_open.tolist(), strict=True)], pa.binary()),
        pa.array(first_id[nodes]), pa.array(depth[nodes]), pa.array(first_id[parent], mask=~inner | parent_open | (nodes == 0)),
        pa.array(convs[nodes]), pa.array(children[nodes]), pa.array(leaves[nodes]), pa.array(saved[nodes]),
        pa.array(texts[end[nodes]], pa.string()), pa.array(text[nodes]), pa.array(np.full(len(nodes), part)),
        pa.array(np.full(len(nodes), run)), pa.array(on_first[nodes]), pa.array(on_last[nodes])], schema=_SCHEMA)


def _shards(most_turns: int):
    """Node rows of a task's sorted sequences, cut into shards of at most about
    ``most_turns`` turns (and no fewer than one sequence)."""
    def run(batches):
        part, number, held = TaskContext.get().partitionId(), 0, 0
        rows: list[dict] = []

        def shard() -> list[pa.RecordBatch]:
            return shard_nodes(part, number, [[t["d"] for t in r["turns"]] for r in rows], [[t["b"] for t in r["turns"]] for r in rows],
                               np.array([r["n"] for r in rows], np.int64), np.array([r["conv_id"] for r in rows], np.int64),
                               [r["ends_sha256"] for r in rows]).to_batches(max_chunksize=65_536)

        for b in batches:
            for r in b.to_pylist():
                if rows and held + len(r["turns"]) + 1 > most_turns:
                    yield from shard()
                    rows, held, number = [], 0, number + 1
                rows.append(r)
                held += len(r["turns"]) + 1
        if rows:
            yield from shard()
    return run


def merge_parts(rows: list[dict], last: bool) -> list[dict]:
    """Node parts of neighbouring shards merged. A node is whole unless it lies
    on the first path of the first shard or the last path of the last one
    (``last``: there are no other shards, so all are whole); whole nodes are
    finished from the deepest up and counted into their parents."""
    order = sorted({(r["part"], r["run"]) for r in rows})
    nodes: dict[bytes, dict] = {}
    for r in sorted(rows, key=lambda r: (r["part"], r["run"], r["depth"])):
        first = r["on_first"] and (r["part"], r["run"]) == order[0]
        final = r["on_last"] and (r["part"], r["run"]) == order[-1]
        r = r | {"on_first": first, "on_last": final}
        node = nodes.setdefault(r["key"], r)
        if node is not r:
            node["conv_id"] = min(node["conv_id"], r["conv_id"])
            for k in ("n_convs", "n_children", "n_leaves", "saved_tokens"):
                node[k] += r[k]
            node["on_first"], node["on_last"] = node["on_first"] or first, node["on_last"] or final
            if r["ends_sha256"] != EMPTY_SHA256:
                node["ends_sha256"] = r["ends_sha256"]
    for node in sorted(nodes.values(), key=lambda r: -r["depth"]):
        node["part"], node["run"] = order[0]
        if last or not (node["on_first"] or node["on_last"]):
            node["final"] = True
            node["n_leaves"] += node["n_children"] == 0
            node["saved_tokens"] += (node["n_convs"] - 1) * node["bytes"]
            if node["parent_key"] is not None:
                up = nodes[node["parent_key"]]
                up["n_children"] += 1
                up["n_leaves"] += node["n_leaves"]
                up["saved_tokens"] += node["saved_tokens"]
    return list(nodes.values())


def _merger(last: bool):
    def run(table: pa.Table) -> pa.Table:
        return pa.Table.from_pylist(merge_parts(table.select(_SCHEMA.names).to_pylist(), last), schema=_SCHEMA)
    return run


def _id_runs(most: int = 65_536):
    """Neighbouring ids of one sequence joined into texts of at most ``most`` ids."""
    def run(batches):
        key, ids = None, []

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([key], pa.string()), pa.array([ids[0]], pa.int64()), pa.array([",".join(map(str, ids))])],
                                              ["seq", "first_id", "ids"])
        for b in batches:
            for seq, conv_id in zip(b.column("seq").to_pylist(), b.column("conv_id").to_pylist(), strict=True):
                if ids and (seq != key or len(ids) >= most):
                    yield row()
                    ids = []
                key = seq
                ids.append(conv_id)
        if ids:
            yield row()
    return run


def _digest_runs(batches):
    """SHA-256 of each sequence's texts, which come in order; only the state of
    one digest is held."""
    key, state = None, None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([key], pa.string()), pa.array([state.hexdigest()])], ["seq", "ends_sha256"])
    for b in batches:
        for seq, ids in zip(b.column("seq").to_pylist(), b.column("ids").to_pylist(), strict=True):
            if seq != key:
                if state is not None:
                    yield row()
                key, state = seq, hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.encode())
    if state is not None:
        yield row()


def rebuilt(conversations: DataFrame, every: int = 5, depths: int = 9) -> DataFrame:
    """(conv_id, turns): the first h turns of conversation c - c % every, then
    c's own turns after its first h; h = crc32(decimal c) % depths. A turn is
    the digest of role and text and the bytes of the text; the texts stay where
    they are."""
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    turn = F.struct(F.col("turn").isNotNull().alias("some"), "turn", F.unhex(F.md5(F.concat(F.md5(role), F.md5(text)))).alias("d"),
                    F.octet_length(text).alias("b"))
    own = (conversations.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t"))
           .groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
           .select("conv_id", F.transform("t", lambda t: F.struct(t["d"].alias("d"), t["b"].alias("b"))).alias("own")))
    own = written(own, "trie-own")
    heads = own.where(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("base"), F.slice("own", 1, depths - 1).alias("head"))
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(depths)).cast("int")
    none = F.array().cast(own.schema["own"].dataType)
    return (own.withColumn("base", F.col("conv_id") - F.col("conv_id") % every).withColumn("h", h).join(heads, "base", "left")
            .select("conv_id", F.concat(F.slice(F.coalesce("head", none), F.lit(1), F.col("h")),
                                        F.slice("own", F.col("h") + 1, F.size("own"))).alias("turns")))


def _per_part(df: DataFrame, n: int, *keys: Column | str) -> DataFrame:
    return df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)


def prefix_trie(conversations: DataFrame, shard_turns: int = 131_072, fan_in: int = 64) -> DataFrame:
    """One row per node of the trie of all rebuilt conversations: conv_id (the
    smallest that starts with the node's turns), depth, parent_conv_id (null for
    the root), n_convs, n_children, n_leaves and saved_tokens of the node's subtree
    (itself included) and ends_sha256 of the conversations that end there.

    ``conversations`` has conv_id, turn, role, text; other columns are ignored.
    Turns are ordered by ``turn``, null first, equal ones by the digest of role
    and text, and each repeated row is a turn of its own. Null roles and texts
    are empty. Rows without conv_id take no part; a table without conversations
    has no nodes. c % 5 has the sign of c. Turns are compared by 128-bit digests.

    Equal conversations are one sequence, so a first turn, prefix or whole
    conversation may be shared by a third of the table: sorted sequences are
    dealt by range, which cuts below any prefix. A conversation is one array of
    its turns' digests (20 bytes each), the largest thing that a task holds
    whole; a shard has ``shard_turns`` turns or one sequence. Ids of a node are
    digested in order by one task, which SHA-256 asks for, as a stream of texts
    that many tasks join.
    """
    spark = conversations.sparkSession
    importable(spark)
    turns = written(rebuilt(conversations).withColumn("seq", F.md5(F.array_join(F.transform("turns", lambda t: F.hex(t["d"])), ""))), "trie-rebuilt")
    total = turns.agg(F.sum(F.size("turns") + 1).alias("n")).first()["n"] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // shard_turns))

    joined = _per_part(turns.select("seq", "conv_id"), parts, "seq", "conv_id").mapInArrow(_id_runs(), "seq string, first_id long, ids string")
    ends = (written(joined, "trie-ids").repartition(parts, "seq").sortWithinPartitions("seq", "first_id")
            .mapInArrow(_digest_runs, "seq string, ends_sha256 string"))
    classes = turns.groupBy("seq").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv_id")).join(ends, "seq")
    sequences = classes.join(turns.select("conv_id", "turns"), "conv_id").select(
        F.transform("turns", lambda t: t["d"]).alias("path"), "turns", "n", "conv_id", "ends_sha256")
    pieces = written(_per_part(written(sequences, "trie-sequences"), parts, "path").drop("path").mapInArrow(_shards(shard_turns), _DDL), "trie-pieces")

    nodes, open_, span = [pieces.where("final")], pieces.where(~F.col("final")), 1
    while True:
        span *= fan_in
        last = span >= parts
        merged = written(open_.groupBy(F.floor(F.col("part") / span).alias("group")).applyInArrow(_merger(last), _DDL), "trie-merged")
        nodes.append(merged.where("final"))
        if last:
            break
        open_ = merged.where(~F.col("final"))
    whole = nodes[0]
    for more in nodes[1:]:
        whole = whole.unionByName(more)
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    ids = whole.where(F.col("key").isNotNull()).select(F.col("key").alias("parent_key"), F.col("conv_id").alias("up"))
    below = (whole.where(F.col("parent_key").isNotNull()).drop("parent_conv_id").join(ids, "parent_key")
             .withColumnRenamed("up", "parent_conv_id"))
    return whole.where(F.col("parent_key").isNull()).select(*columns).unionByName(below.select(*columns))
