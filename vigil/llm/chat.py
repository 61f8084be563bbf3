"""Chat formatting with cumulative-snapshot collapse.

A chat service often logs a conversation again after each turn. Rolling hashes
of every turn prefix identify a log that is a proper prefix of a longer one;
anti-joins keep the maximal conversations, which are then rendered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _digest(col: str):
    return F.coalesce(F.md5(F.col(col)), F.lit("-"))


def collapse_snapshots(conversations: DataFrame) -> DataFrame:
    """(conv_id, n_turns, copies): the maximal conversations.

    A conversation is the rows of one conv_id by turn (null last, then by
    digest). It goes if its turns (role, text) are the first turns of a longer
    conversation; of equal ones the smallest conv_id stays and ``copies`` tells
    how many there were. Rows without conv_id take no part; rows repeated in
    conv_id, turn, role and text count once; null and empty texts differ; other
    columns are ignored; an empty table gives an empty result. Only digests are
    shuffled here.
    """
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        "conv_id", "turn", F.md5(F.concat(_digest("role"), _digest("text"))).alias("t")).distinct()
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_last(), "t")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = Window.partitionBy("conv_id")
    numbered = turns.withColumn("pos", F.row_number().over(order))
    prefix = (numbered.withColumn("p1", F.bit_xor(F.xxhash64("pos", "t")).over(so_far))
              .withColumn("p2", F.bit_xor(F.xxhash64("t", F.lit(7), "pos")).over(so_far))
              .withColumn("n", F.count(F.lit(1)).over(last)))
    whole = (prefix.where(F.col("pos") == F.col("n")).groupBy("n", "p1", "p2")
             .agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("copies")))
    shorter = (prefix.where(F.col("pos") < F.col("n"))
               .select(F.col("pos").cast("long").alias("n"), "p1", "p2").distinct())
    return whole.join(shorter, ["n", "p1", "p2"], "left_anti").select(
        "conv_id", F.col("n").alias("n_turns"), "copies")


def render(turns, start: str = "<|im_start|>", end: str = "<|im_end|>"):
    """Column: the turns (array of struct with role and text) as one text."""
    return F.array_join(F.transform(turns, lambda t: F.concat(
        F.lit(start), F.coalesce(t["role"], F.lit("unknown")), F.lit("\n"), F.coalesce(t["text"], F.lit("")),
        F.lit(end), F.lit("\n"))), "")


def format_chats(conversations: DataFrame, **marks) -> DataFrame:
    """(conv_id, n_turns, copies, text): the maximal conversations rendered.
    A null role is rendered as ``unknown``, a null text as empty."""
    kept = collapse_snapshots(conversations)
    turns = (conversations.where(F.col("conv_id").isNotNull()).select("conv_id", "turn", "role", "text")
             .join(kept, "conv_id")
             .withColumn("t", F.md5(F.concat(_digest("role"), _digest("text")))))
    # one row per conversation: its size is that of the rendered text
    rows = turns.groupBy("conv_id").agg(
        F.collect_set(F.struct(F.col("turn").isNull().alias("no"), "turn", "t", "role", "text")).alias("turns"),
        F.max("n_turns").alias("n_turns"), F.max("copies").alias("copies"))
    return rows.select("conv_id", "n_turns", "copies", render(F.array_sort("turns"), **marks).alias("text"))
