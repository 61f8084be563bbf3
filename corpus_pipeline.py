"""Corpus pipeline: toxicity, line dedup, near duplicates, mixing, packing.

Each stage takes (spark, docs, sf_dir), works on all that the stage before it
kept and is written and read again before the next one. All but the last return
the columns of ``documents``.

* toxicity: documents that score 0.5 or more go; a null text scores as empty,
  and every row by its own text, whatever its id;
* line_dedup: lines of at least 20 characters that at least 3 documents hold
  stay in one of them only (that with the largest id, a null one is below all);
  documents that lose all their text stay, empty, and null texts become empty;
* near_dup: one document (the smallest doc_id) of each group of near
  duplicates stays: five-word shingles, similarity 0.8 or more. Rows of one id
  are one document and stay or go together; null ids and texts without words are
  near duplicates of nothing and stay;
* mixing: sources are cut or repeated to their target weights; documents without
  words are in no mix; ties are broken by hashes of id and text, so reruns agree;
* packing: token sequences of at most 2048 ids, a longer document spans several.

Rows that repeat are rows of their own but where a stage says otherwise; texts
are taken whole, however long; extra columns are left behind; empty tables pass
through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm import line_dedup, mixing, near_dup, packing, toxicity
from vigil.llm.common import table, written
from vigil.llm.queries import tokenizer_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").where(~toxicity.held_out())
    model = toxicity.train(table(spark, sf_dir, "documents"), labels)
    return toxicity.score(docs.select(*COLUMNS), model, out="_toxic").where(F.col("_toxic") < 0.5).select(*COLUMNS)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(docs, columns=["doc_id", "lang", "source", "n_chars"])
    n_chars = F.when(F.col("n_dropped") == 0, F.col("n_chars")).otherwise(F.length("kept_text").cast("long"))
    return kept.select("doc_id", F.col("kept_text").alias("text"), "lang", "source", n_chars.alias("n_chars"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = docs.select(*COLUMNS)
    found = near_dup.near_duplicates(docs, width=5, percent=80)
    copies = found.where(F.col("component_id") != F.col("doc_id")).select("doc_id").distinct()
    return docs.join(copies, "doc_id", "left_anti").select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_texts(docs.select(*COLUMNS))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_path())


STAGES = [("toxicity", drop_toxic), ("line_dedup", drop_lines), ("near_dup", drop_near_duplicates),
          ("mixing", mix_sources), ("packing", pack_sequences)]

#: The classifier and the tokenizer can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
