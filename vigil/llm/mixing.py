"""Mixing sources to target weights by Sainte-Lague apportionment.

The mix is made of blocks of equal token count. Whole-block quotas go to the
sources by the highest quotients target / (2 seats + 1), then in the same way
to the shards of each source. Within a shard the documents lie in a seeded
order; the shard's quota takes every block as often as it fits, and the rest
is a run of blocks from a seeded start (wrapping around), so that but for the
ends of a run documents are taken whole.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil.llm.common import WORD, written

WEIGHTS = (5.0, 2.0, 1.0)


def sainte_lague(weights: Sequence[float], seats: int, caps: Sequence[int]) -> list[int]:
    """Seats by highest quotient weight / (2 s + 1), never above ``caps``; ties
    go to the earlier entry. Fewer seats are given only if all caps are met."""
    seats = min(seats, sum(c for w, c in zip(weights, caps, strict=True) if w > 0))

    def given(q: float) -> list[int]:
        """Seats whose quotient is at least q."""
        return [min(c, int((w / q + 1) / 2)) if w > 0 else 0 for w, c in zip(weights, caps, strict=True)]

    if seats <= 0:
        return [0] * len(weights)
    low, high = 0.0, 2 * max(weights) + 1.0      # given(high) is all zero
    for _ in range(200):
        mid = (low + high) / 2
        if mid <= 0 or sum(given(mid)) > seats:
            low = mid
        else:
            high = mid
    out = given(high)
    heap = [(-w / (2 * s + 1), i) for i, (w, s, c) in enumerate(zip(weights, out, caps, strict=True)) if s < c and w > 0]
    heapq.heapify(heap)
    for _ in range(seats - sum(out)):
        _, i = heapq.heappop(heap)
        out[i] += 1
        if out[i] < caps[i]:
            heapq.heappush(heap, (-weights[i] / (2 * out[i] + 1), i))
    return out


def capped_targets(sizes: Sequence[int], weights: Sequence[float], total: float, most: float) -> list[float]:
    """Shares of ``total`` by weight, none above ``most`` times its size; the
    excess is shared again by weight."""
    out, free = [0.0] * len(sizes), [i for i in range(len(sizes)) if sizes[i] > 0]
    left = min(float(total), most * sum(sizes))
    while free:
        unit = left / sum(weights[i] for i in free)
        over = [i for i in free if unit * weights[i] > most * sizes[i]]
        if not over:
            for i in free:
                out[i] = unit * weights[i]
            break
        for i in over:
            out[i] = most * sizes[i]
            left -= out[i]
        free = [i for i in free if i not in set(over)]
    return out


def _seeded(n: int, *key) -> int:
    return int.from_bytes(hashlib.sha256(repr(key).encode()).digest()[:8], "big") % n


def with_sizes(docs: DataFrame, text: str = "text", size: str = "size") -> DataFrame:
    """Adds the number of words of a text (null: 0)."""
    return docs.withColumn(size, F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long"))


def mix(docs: DataFrame, total_share: float = 1.5, most: float = 2.0, weights: Sequence[float] = WEIGHTS,
        block_words: int = 16, shard_words: int = 1 << 20, max_shards: int = 32_768, seed: int = 17) -> DataFrame:
    """What the mix takes of each document.

    ``docs`` has doc_id, source and size (words); other columns are returned as
    they are. The sources, by code point with null last, weigh ``weights``,
    repeating, and share ``total_share`` of all sizes; a target stops at
    ``most`` times its source's size. Adds source_size, target, copies (whole
    times a document is taken), parts (array of [from, to) in words, taken once
    more) and taken. A null or negative size counts as 0, an empty document is
    never taken; repeated rows are rows of their own; an empty table gives an
    empty result. Shards and their order come from hashes of the id and the text
    (of all columns, if there is no text), so that rows of one id are dealt like
    others and reruns agree whatever the partitions are.

    The driver holds a row per source and per shard: shards are at most
    ``max_shards`` plus one for each source.
    """
    spark = docs.sparkSession
    added = ("source_size", "target", "copies", "parts", "taken")
    docs = docs.select(*(c for c in docs.columns if c not in added)).withColumn(
        "size", F.greatest(F.coalesce(F.col("size"), F.lit(0)), F.lit(0)).cast("long"))
    cols = docs.columns
    per = docs.groupBy("source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).collect()
    per.sort(key=lambda r: (r["source"] is None, [ord(c) for c in r["source"] or ""]))
    sizes, all_words = [r["size"] for r in per], sum(r["size"] for r in per)
    targets = capped_targets(sizes, [weights[i % len(weights)] for i in range(len(per))], total_share * all_words, most)

    wide = max(shard_words, -(-all_words // max_shards))
    tall = max(20_000, -(-sum(r["n"] for r in per) // max_shards))
    n_shards = [max(1, math.ceil(s / wide), math.ceil(r["n"] / tall)) for s, r in zip(sizes, per, strict=True)]
    kinds = dict(docs.dtypes)
    if "text" not in cols:
        spot = F.xxhash64(F.lit(seed), *(F.col(f"d.`{c}`") for c in cols))
    else:                                                  # the text or, as ``mix_documents`` has it, its hash
        text = F.col("d.text") if kinds["text"] == "bigint" else F.xxhash64("d.text")
        spot = F.xxhash64(F.lit(seed), F.col("d.doc_id"), F.col("d.size"), text)
    sources = spark.createDataFrame(
        [(i, r["source"], s, t, k) for i, (r, s, t, k) in enumerate(zip(per, sizes, targets, n_shards, strict=True))],
        "_src int, _source string, source_size long, target double, _shards int")
    dealt = (docs.alias("d").join(sources.alias("s"), F.col("d.source").eqNullSafe(F.col("s._source")))
             .select(*(F.col(f"d.`{c}`") for c in cols), "s._src", "s.source_size", "s.target",
                     F.pmod(spot, F.col("s._shards")).cast("int").alias("_shard"), F.xxhash64(F.lit(seed + 1), spot).alias("_spot")))

    words = {(r[0], r[1]): r[2] for r in dealt.groupBy("_src", "_shard").agg(F.sum("size")).collect()}
    blocks = {k: -(-w // block_words) for k, w in words.items()}
    of = [sorted(k for k in words if k[0] == i) for i in range(len(per))]
    seats = sainte_lague(targets, round(sum(targets) / block_words), [int(most) * sum(blocks[k] for k in of_i) for of_i in of])
    plan = []
    for of_i, quota in zip(of, seats, strict=True):
        shares = sainte_lague([words[k] for k in of_i], quota, [int(most) * blocks[k] for k in of_i])
        for k, q in zip(of_i, shares, strict=True):
            n = max(1, blocks[k])
            start, run = _seeded(n, seed, *k), q % n
            plan.append((*k, q // n, start * block_words, min((start + run) * block_words, words[k]),
                         max(0, start + run - n) * block_words))
    plan = spark.createDataFrame(plan, "_src int, _shard int, copies long, _from long, _to long, _wrap long")

    # empty documents are never taken and need no place
    line = Window.partitionBy("_src", "_shard").orderBy("_spot", "doc_id", "size")
    at = F.coalesce(F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    nothing = dealt.where(F.col("size") == 0).select(
        *cols, "source_size", "target", F.lit(0).cast("long").alias("copies"),
        F.array().cast("array<struct<from:bigint,to:bigint>>").alias("parts"), F.lit(0).cast("long").alias("taken"))
    part = lambda lo, hi: F.struct(
        F.greatest(lo - F.col("_at"), F.lit(0)).alias("from"), F.least(hi - F.col("_at"), F.col("size")).alias("to"))
    placed = (dealt.where(F.col("size") > 0).withColumn("_at", at).join(plan, ["_src", "_shard"])
              .withColumn("parts", F.filter(F.array(part(F.lit(0), F.col("_wrap")), part(F.col("_from"), F.col("_to"))),
                                            lambda p: p["to"] > p["from"]))
              .withColumn("taken", F.col("copies") * F.col("size")
                          + F.aggregate("parts", F.lit(0).cast("long"), lambda s, p: s + p["to"] - p["from"])))
    return placed.select(*cols, *added).union(nothing.select(*cols, *added))


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """``mix`` of documents as (doc_id, source, size, source_size, target,
    copies, parts, taken): texts are read once and their sizes written, so that
    no text is shuffled."""
    sizes = with_sizes(docs.select("doc_id", "source", "text")).withColumn("text", F.xxhash64("text"))
    return mix(written(sizes, "mix-sizes"), **options).drop("text")


def mixed_texts(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: ``docs`` with each document as often as it is taken,
    texts of partly taken documents cut to the words taken (with the white
    space before each word but the first), ``n_chars`` kept true if present."""
    cols = docs.columns
    size, drop = "size", "size" not in cols
    base = docs if drop else docs.withColumnRenamed("size", "_own_size")
    taken = mix(with_sizes(base, size=size), **options)
    words = F.regexp_extract_all(F.col("text"), F.lit(r"([\x20\x09-\x0D]*[^\x20\x09-\x0D]+)"))
    cut = F.transform("parts", lambda p: F.when(
        p["to"] - p["from"] >= F.col("size"), F.col("text")).otherwise(F.regexp_replace(F.array_join(
            F.slice(words, (p["from"] + 1).cast("int"), (p["to"] - p["from"]).cast("int")), ""), r"^[\x20\x09-\x0D]+", "")))
    whole = F.transform(F.sequence(F.lit(1), F.col("copies")), lambda _: F.col("text"))
    texts = F.concat(F.when(F.col("copies") > 0, whole).otherwise(F.array().cast("array<string>")), cut)
    out = taken.where(F.col("taken") > 0).withColumn("text", F.explode(texts))
    if "n_chars" in cols:
        out = out.withColumn("n_chars", F.length("text").cast("long"))
    if not drop:
        out = out.drop("size").withColumnRenamed("_own_size", "size")
    return out.select(*cols)
