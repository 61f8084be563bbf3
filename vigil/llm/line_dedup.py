"""Line dedup by a sharded minimal perfect hash.

Each distinct line key is counted once over all documents; the keys that
repeat become an index of shards, each a minimal perfect hash over 128-bit
line hashes with compact arrays (fingerprint, count, keeping document).
Documents send their line hashes, never the lines, to the shards and probe the
arrays there. The most frequent keys are at most ``heavy_parts`` by counting
(each holds more than 1/heavy_parts of all occurrences), so their index has a
proven size bound and goes to every task. Any other shard that would get more
probes than planned is copied, and its probes are dealt over the copies.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import ascii_lower, fixed_width, strip_white, written
from vigil.llm.perfect_hash import LineIndex

_DROPS = "id long, row long, key binary"


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _kept(rest: list[str], text: str, dropped: str):
    """Drops from each text the lines whose key's hash is among its ``dropped``:
    one look-up a line, however many lines a text has or loses."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n_lines, n_dropped, kept = [], [], []
            for whole, keys in zip(b.column(text).cast(pa.binary()).to_pylist(), b.column(dropped).to_pylist(), strict=True):
                whole = whole or b""
                n_lines.append(whole.count(b"\n") + 1)
                if keys:
                    gone, lines = set(keys), whole.split(b"\n")
                    stay = [x for x in lines if md5(x.strip().lower()).digest() not in gone]     # bytes: ASCII only
                    n_dropped.append(len(lines) - len(stay))
                    kept.append(b"\n".join(stay))
                else:
                    n_dropped.append(0)
                    kept.append(whole)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in rest), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()),
                 pa.array(kept, pa.binary()).cast(pa.string())], [*rest, "n_lines", "n_dropped", "kept_text"])
    return run


def _ids(col: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    has = col.is_valid().to_numpy()
    return col.fill_null(0).to_numpy().astype(np.int64), np.asarray(has, bool)


def _build(t: pa.Table) -> pa.Table:
    keep, has = _ids(t["keep"])
    index = LineIndex.build(fixed_width(t["key"], 16), t["n"].to_numpy().astype(np.int64), keep, has)
    return pa.table({"shard": pa.array([t["shard"][0].as_py()], pa.int64()), "blob": pa.array([index.dumps()], pa.binary())})


def _probe(lines: pa.Table, shards: pa.Table) -> pa.Table:
    if not lines.num_rows or not shards.num_rows:
        return pa.table({"id": pa.array([], pa.int64()), "row": pa.array([], pa.int64()), "key": pa.array([], pa.binary())})
    index = LineIndex.loads(shards["blob"][0].as_py())
    ids, has = _ids(lines["id"])
    return lines.filter(pa.array(index.drops(fixed_width(lines["key"], 16), ids, has))).select(["id", "row", "key"])


def _probe_all(blob: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = LineIndex.loads(blob)
        for b in batches:
            keys = b.column("keys")
            at = np.repeat(np.arange(len(b)), np.diff(keys.offsets.to_numpy()))
            rows = pa.table({"id": b.column("id").take(pa.array(at)), "row": b.column("row").take(pa.array(at)), "key": keys.flatten()})
            ids, has = _ids(rows["id"])
            rows = rows.filter(pa.array(index.drops(fixed_width(rows["key"], 16), ids, has)))
            yield from rows.to_batches()
    return run


def line_drops(docs: DataFrame, min_docs: int, min_chars: int, heavy_parts: int, probes_per_shard: int) -> DataFrame:
    """(id, row, dropped): the hashes of the line keys that a document loses.
    ``row`` tells documents of one (or no) id apart by a hash of the text; where it
    doesn't, they lose the same keys, as that depends on the id and the key."""
    text = ascii_lower(F.coalesce(F.col("text"), F.lit("")))
    keys = F.filter(F.transform(_lines(text), strip_white), lambda k: F.length(k) >= min_chars)
    keys = F.transform(F.array_distinct(F.transform(keys, F.md5)), F.unhex)
    hashed = written(docs.select(F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("row"), keys.alias("keys"))
                     .where(F.size("keys") > 0), "line-hashes")
    lines = hashed.select("id", "row", F.explode("keys").alias("key"))
    index = written(lines.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("keep"))
                    .where(F.col("n") >= min_docs), "line-index")
    total = hashed.agg(F.sum(F.size("keys"))).first()[0] or 0
    heavy_from = total // heavy_parts + 1
    heavy = index.where(F.col("n") >= heavy_from).withColumn("shard", F.lit(-1).cast("long")).toArrow()

    n_shards = total // probes_per_shard + 1
    shard = F.pmod(F.xxhash64("key"), F.lit(n_shards)).alias("shard")
    light = index.where(F.col("n") < heavy_from).select("key", "n", "keep", shard)
    # a shard's copies: one, and one more for each ``probes_per_shard`` probes by repeated keys
    copies = written(light.groupBy("shard").agg((1 + F.floor(F.sum("n") / probes_per_shard)).cast("int").alias("copies"))
                     .where(F.col("copies") > 1), "line-copies")
    shards = light.groupBy("shard").applyInArrow(_build, "shard long, blob binary")
    shards = shards.join(copies, "shard", "left").select(
        "shard", F.explode(F.sequence(F.lit(0), F.coalesce("copies", F.lit(1)) - 1)).alias("copy"), "blob")
    if heavy.num_rows:
        blob = _build(heavy)["blob"][0].as_py()
        keyset = docs.sparkSession.createDataFrame([(bytes(k),) for k in heavy["key"].to_pylist()], "key binary")
        lines = lines.join(F.broadcast(keyset), "key", "left_anti")  # at most heavy_parts rows
    dealt = lines.select("id", "row", "key", shard).join(copies, "shard", "left").select(
        "id", "row", "key", "shard", F.pmod(F.xxhash64("row", "id"), F.coalesce("copies", F.lit(1))).cast("int").alias("copy"))
    drops = dealt.groupBy("shard", "copy").cogroup(shards.groupBy("shard", "copy")).applyInArrow(_probe, _DROPS)
    if heavy.num_rows:
        drops = drops.unionByName(hashed.mapInArrow(_probe_all(blob), _DROPS))
    return drops.groupBy("id", "row").agg(F.collect_set("key").alias("dropped"))      # within one text


def dedup_lines(docs: DataFrame, min_docs: int = 3, min_chars: int = 20, heavy_parts: int = 1024,
                probes_per_shard: int = 250_000, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop repeated lines everywhere but in one document.

    ``docs`` has doc_id (integer) and text; ``columns`` (all, if not stated) are
    returned as they are. A line's key is the line stripped of white space with A-Z lower-cased.
    Keys of at least ``min_chars`` code points that at least ``min_docs`` rows
    hold lose their lines except in the largest doc_id that holds them.
    Adds n_lines, n_dropped and kept_text (replacing columns of these names).

    Null or empty text: one empty line, kept. Null doc_id: below every id, so
    such rows lose repeated lines; if no holder has an id all keep them. Rows
    repeated with one doc_id each count as a document and fare alike. An empty
    table gives an empty result.
    """
    drops = line_drops(docs.select("doc_id", "text"), min_docs, min_chars, heavy_parts, probes_per_shard)
    rest = [c for c in columns or docs.columns if c not in ("n_lines", "n_dropped", "kept_text")]
    text, dropped = "_text", "_dropped"
    while text in rest or dropped in rest:
        text, dropped = text + "_", dropped + "_"
    same = F.col("d.doc_id").cast("long").eqNullSafe(F.col("x.id")) & (F.xxhash64("d.text") == F.col("x.row"))
    joined = docs.alias("d").join(drops.alias("x"), same, "left").select(
        *(F.col(f"d.`{c}`") for c in rest), F.col("d.text").alias(text), F.col("x.dropped").alias(dropped))
    schema = docs.select(*rest).schema.add("n_lines", "long").add("n_dropped", "long").add("kept_text", "string")
    return joined.mapInArrow(_kept(rest, text, dropped), schema)
