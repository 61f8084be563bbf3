"""Connected components of an edge table, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import written


def _to_least(directed: DataFrame) -> DataFrame:
    """(u, v, m): m is the least of u and all v of u. A hub's rows are counted
    map-side and the join may be split, so no task needs all of them."""
    least = directed.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return directed.join(least, "u")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of ``edges`` with two different ends:
    the component is named by its least node. Null ends are ignored."""
    now = written(edges.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(), "cc")
    seen = None
    while True:
        state = tuple(now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())
        if state == seen:
            break
        seen = state
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select("b", "a"))
        large = _to_least(both).where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        down = large.select(F.col("a").alias("u"), F.col("b").alias("v"))
        small = _to_least(down).select(F.explode(F.array("u", "v")).alias("a"), F.col("m").alias("b"))
        now = written(small.where(F.col("a") != F.col("b")).distinct(), "cc")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        now.select("b", "b").distinct())
