"""Registered queries of this package and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm import (centroids, chat, embedding_dedup, fingerprint, language, line_dedup, mixing, near_dup, packing, prefix_trie, topk,
                       toxicity, warc)
from vigil.llm.common import id_crc32, table


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return str(public_tokenizers.path(name))


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.whole_vectors(table(spark, sf_dir, "embeddings"))
    return topk.search(vectors, F.col("vec_id") % 50 == 0, k=5)


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(table(spark, sf_dir, "conversations"))


def op3_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprint_versions(table(spark, sf_dir, "documents"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.pmod(id_crc32(F.col("doc_id")), F.lit(4)) == 2, F.lit(False))
    training = language.learn(docs.where(~held_out).select("doc_id", "text", "lang"))
    return language.identify(docs.select("doc_id", held_out.alias("held_out"), "text"), training).drop("text")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), columns=["doc_id"])
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(~toxicity.held_out())
    model = toxicity.train(docs, labels)
    scored = toxicity.score(docs.select("doc_id", toxicity.held_out().alias("held_out"), "text"), model)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=90)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages"), min_bytes=0).drop("payload")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), with_ids=False)


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


def op12_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def queries() -> dict:
    return {f.__name__: f for f in (op1_topk, op2_chat, op3_fingerprint, op4_language, op5_line_dedup, op6_mixing,
                                    op7_toxicity, op8_near_dup, op9_warc, op10_packing, op11_centroids,
                                    op12_embedding_dedup, op13_prefix_trie)}


def oracle_sql() -> dict[str, str]:
    return {"op1_topk": TOPK_SQL, "op2_chat": CHAT_SQL, "op5_line_dedup": LINE_DEDUP_SQL, "op11_centroids": centroids_sql(),
            "op12_embedding_dedup": EMBEDDING_DEDUP_SQL, "op13_prefix_trie": PREFIX_TRIE_SQL}


TOPK_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, q.e, d.vec_id, CAST(list_dot_product(q.e, d.e) AS BIGINT) AS score
  FROM v q JOIN v d ON q.vec_id % 50 = 0 AND NOT (q.vec_id = d.vec_id AND q.e = d.e)),
r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id, e ORDER BY score DESC, vec_id) AS k FROM s)
SELECT query_id, CAST(k AS INTEGER) AS rank, vec_id, score FROM r WHERE k <= 5
"""

CHAT_SQL = """
WITH t AS (
  SELECT DISTINCT conv_id, turn, role, text,
         md5(coalesce(md5(role), '-') || coalesce(md5(text), '-')) AS h
  FROM conversations WHERE conv_id IS NOT NULL),
o AS (
  SELECT *, string_agg(h, '') OVER w AS prefix, row_number() OVER w AS pos,
         count(*) OVER (PARTITION BY conv_id) AS n
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS LAST, h
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
whole AS (
  SELECT prefix, n, min(conv_id) AS conv_id, count(*) AS copies FROM o WHERE pos = n GROUP BY ALL),
kept AS (
  SELECT * FROM whole w WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.prefix = w.prefix AND o.pos < o.n))
SELECT k.conv_id, k.n AS n_turns, k.copies,
       string_agg('<|im_start|>' || coalesce(o.role, 'unknown') || chr(10) || coalesce(o.text, '') || '<|im_end|>' || chr(10), ''
                  ORDER BY o.pos) AS text
FROM kept k JOIN o USING (conv_id) GROUP BY ALL
"""

LINE_DEDUP_SQL = """
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (
  SELECT row, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM d),
k AS (
  SELECT *, trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS key FROM l),
f AS (
  SELECT key, max(doc_id) AS keep FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT row) >= 3)
SELECT k.doc_id, count(*) AS n_lines, count(*) FILTER (f.keep IS NOT NULL AND k.doc_id IS DISTINCT FROM f.keep) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (f.keep IS NULL OR k.doc_id = f.keep), '')) AS kept_sha256
FROM k LEFT JOIN f USING (key) GROUP BY k.row, k.doc_id
"""


def centroids_sql(rounds: int = 3) -> str:
    """Each round as two common tables: the assignment a and the centroids c."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
a{r} AS MATERIALIZED (
  SELECT i, min({{'d': CAST(list_dot_product(e, e) - 2 * list_dot_product(e, c) + list_dot_product(c, c) AS BIGINT), 'k': k}}) AS m
  FROM v, c{r} GROUP BY i)""")
        if r < rounds:
            steps.append(f"""
c{r + 1} AS MATERIALIZED (
  SELECT k, coalesce(n.c, o.c) AS c FROM c{r} o LEFT JOIN (
    SELECT k, list(x ORDER BY pos) AS c FROM (
      SELECT a.m.k AS k, pos, floor(sum(e[pos]) / count(*)) AS x
      FROM a{r} a JOIN v USING (i), (SELECT unnest(range(1, 65)) AS pos) GROUP BY 1, 2) GROUP BY k) n USING (k))""")
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS i, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, e) - 1 AS k, e AS c
  FROM (SELECT e, sha256(concat('1:', vec_id)) AS h FROM v WHERE vec_id IS NOT NULL ORDER BY h, e LIMIT 16)),{",".join(steps)}
SELECT vec_id, CAST(m.k AS INTEGER) AS cluster, m.d AS distance, CAST(sum(m.d) OVER (PARTITION BY m.k) AS BIGINT) AS cluster_inertia,
       CAST(sum(m.d) OVER () AS BIGINT) AS inertia,
       sha256(list_aggregate(list_transform(c, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), 'string_agg', ',')) AS centroid_sha256
FROM a{rounds} JOIN v USING (i) JOIN c{rounds} ON k = m.k
"""


EMBEDDING_DEDUP_SQL = """
WITH RECURSIVE v AS MATERIALIZED (
  SELECT row_number() OVER () AS i, vec_id, CAST(embedding AS DOUBLE[]) AS e,
         vec_id IS NOT NULL AND coalesce(len(embedding), 0) > 0
           AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
           AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS fine FROM embeddings),
u AS MATERIALIZED (SELECT i, len(e) AS n, e FROM v WHERE fine),
l AS MATERIALIZED (
  SELECT a.i, b.i AS j FROM u a JOIN u b ON a.n = b.n AND a.i <> b.i WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
r(i, j) AS (SELECT i, i FROM u UNION SELECT r.i, l.j FROM r JOIN l ON r.j = l.i),
c AS (SELECT r.i, min(v.vec_id) AS component_id FROM r JOIN v ON v.i = r.j GROUP BY r.i),
n AS (SELECT i, count(*) AS n_links FROM l GROUP BY i)
SELECT vec_id, coalesce(n_links, 0) AS n_links, coalesce(component_id, vec_id) AS component_id,
       coalesce(vec_id = coalesce(component_id, vec_id), true) AS kept
FROM v LEFT JOIN c USING (i) LEFT JOIN n USING (i)
"""

# crc32 of the decimal id: each byte is xored in, then eight bits are shifted out
PREFIX_TRIE_SQL = """
WITH t AS MATERIALIZED (
  SELECT conv_id AS c, coalesce(text, '') AS x, md5(concat(md5(coalesce(role, '')), md5(coalesce(text, '')))) AS d,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(concat(md5(coalesce(role, '')), md5(coalesce(text, ''))))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
h AS MATERIALIZED (
  SELECT c, c - c % 5 AS base, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
           string_split(CAST(c AS VARCHAR), ''), lambda ch: [ascii(ch)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
           lambda crc, b: xor(xor(crc, b) >> 1, 3988292384::BIGINT * (xor(crc, b) & 1))), 4294967295::BIGINT) % 9 AS h
  FROM (SELECT DISTINCT c FROM t)),
b AS (
  SELECT h.c, 0 AS own, pos, d, x FROM h JOIN t ON t.c = h.base AND t.pos <= h.h
  UNION ALL SELECT h.c, 1, pos, d, x FROM h JOIN t ON t.c = h.c AND t.pos > h.h),
p AS (
  SELECT c, octet_length(encode(x)) AS bytes, row_number() OVER w AS depth, string_agg(d, '') OVER w AS node
  FROM b WINDOW w AS (PARTITION BY c ORDER BY own, pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
m AS MATERIALIZED (
  SELECT c, depth, node, bytes FROM p UNION ALL SELECT c, 0, '', 0 FROM h),
l AS (SELECT c, max(depth) AS depth FROM m GROUP BY c),
e AS (
  SELECT node, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) AS ids FROM m JOIN l USING (c, depth) GROUP BY node),
n AS MATERIALIZED (
  SELECT node, depth, min(c) AS conv_id, count(*) AS n_convs, max(bytes) AS bytes FROM m GROUP BY node, depth),
k AS (SELECT substr(node, 1, 32 * (depth - 1)) AS node, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
s AS (
  SELECT u.node, count(*) FILTER (k.node IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.bytes) AS saved
  FROM n u JOIN n ON starts_with(n.node, u.node) LEFT JOIN k ON k.node = n.node GROUP BY u.node)
SELECT n.conv_id, n.depth, up.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children, s.n_leaves,
       CAST(s.saved AS BIGINT) AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM n JOIN s USING (node) LEFT JOIN k USING (node) LEFT JOIN e USING (node)
LEFT JOIN n up ON n.depth > 0 AND up.node = substr(n.node, 1, 32 * (n.depth - 1))
"""
