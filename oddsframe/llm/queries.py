"""The registered queries of the corpus operators: thin adapters that fix production parameters."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oddsframe.llm import (hard_negatives, html_wrappers, minhash, packing, quality_pu, sentencepiece_sa, sharding_ring, simhash_bktree, token_counts,
                           topk_impact, toxicity_knn, warc, whitening)
from oddsframe.llm.common import read_table, ship_package, tokenizer_file

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if oracle:
            ORACLES[name] = oracle
        return fn
    return deco


@query("op4_simhash_bktree")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash components of all documents (3-word shingles, at most 3 bits)."""
    return simhash_bktree.near_duplicates(read_table(spark, sf_dir, "documents", "doc_id", "text"), 3, 3)


@query("op8_packing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 4096 word-BPE tokens."""
    return packing.pack(read_table(spark, sf_dir, "documents", "doc_id", "text"),
                        tokenizer_file("word_bpe_49k.json"), end_id=2, width=4096, with_ids=False).drop("ids")


@query("op10_token_counts")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE token counts of all documents."""
    return token_counts.token_counts(read_table(spark, sf_dir, "documents", "doc_id", "text"),
                                     tokenizer_file("byte_bpe_50k.json"), limit=1024)


# base32 in SQL: every 5 hex digits are one number of 20 bits, that is 4 letters.
_BASE32 = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((v // {p}) % 32 AS INTEGER), 1)"

OP3_SQL = f"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hx,
         max(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id
  FROM pages),
g AS (
  SELECT p.*, list_transform(range(8), lambda i: CAST('0x' || substr(hx, CAST(1 + 5 * i AS INTEGER), 5) AS BIGINT)) AS vs FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(vs, lambda v: {_BASE32.format(p=32768)} || {_BASE32.format(p=1024)} ||
                                               {_BASE32.format(p=32)} || {_BASE32.format(p=1)}), '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM g"""


@query("op3_warc", OP3_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC records and read back."""
    pages = read_table(spark, sf_dir, "pages", "page_id", "url", "html")
    return warc.round_trip(pages, min_bytes=0).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP9_SQL = """
WITH x AS (
  SELECT vec_id, list_transform(embedding, lambda e: CAST(floor(256 * CAST(e AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(range(len(q.v)), lambda i: q.v[i + 1] * c.v[i + 1])) AS BIGINT) AS score
  FROM x q JOIN x c ON c.vec_id <> q.vec_id AND q.vec_id % 50 = 0 AND len(q.v) = len(c.v))
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5"""


@query("op9_topk", OP9_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best inner products of every 50th vector against all others."""
    return topk_impact.top_k(read_table(spark, sf_dir, "embeddings", "vec_id", "embedding"), F.col("vec_id") % 50 == 0, k=5)


@query("op6_minhash")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MinHash fingerprints of all documents, their edited texts and their next documents; classes of near copies."""
    return minhash.edited_fingerprints(read_table(spark, sf_dir, "documents", "doc_id", "text")).select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "class_id")


@query("op7_sentencepiece")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SentencePiece ids of all documents, and whether they decode to the text."""
    return sentencepiece_sa.encode(read_table(spark, sf_dir, "documents", "doc_id", "text"), tokenizer_file("piece_bpe_32k.model"))


def remainder(modulus: int) -> F.Column:
    """crc32 of the doc_id as text, modulo; null ids count as remainder -1."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % modulus, F.lit(-1))


@query("op2_quality_pu")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents, learned from labels whose crc32 remainder by 5 is not 0."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    labels = read_table(spark, sf_dir, "labels", "doc_id", "quality").filter(remainder(5) != 0)
    scored = quality_pu.score(docs, quality_pu.fit(docs, labels))
    return scored.select("doc_id", (remainder(5) == 0).alias("held_out"), F.col("_quality").alias("score"),
                         (F.col("_quality") >= 0.3).cast("int").alias("predicted"))


@query("op5_toxicity_knn")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learned from labels whose crc32 remainder by 3 is not 1."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    labels = read_table(spark, sf_dir, "labels", "doc_id", "toxic").filter(remainder(3) != 1)
    scored = toxicity_knn.score(docs, toxicity_knn.fit(docs, labels))
    return scored.select("doc_id", (remainder(3) == 1).alias("held_out"), F.col("_toxicity.score").alias("score"),
                         (F.col("_toxicity.score") >= 0.7).cast("int").alias("predicted"),
                         F.col("_toxicity.evidence").alias("evidence"))


@query("op1_html_wrappers")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return html_wrappers.main_text(read_table(spark, sf_dir, "pages", "page_id", "url", "html"))


# A walk over the ring's arcs, one step per arc and shard; checksums byte by byte.
OP11_SQL = """
WITH RECURSIVE t AS (
  SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda c, i:
           CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, CAST(b AS BIGINT))) AS tab),
d AS (
  SELECT doc_id, CAST(strlen(coalesce(text, '')) + 1 AS BIGINT) AS size, hex(encode(coalesce(text, ''))) AS hx,
         CAST('0x' || substr(md5(coalesce('id:' || CAST(doc_id AS VARCHAR), 'null')), 1, 15) AS BIGINT) AS place
  FROM documents),
c AS (
  SELECT doc_id, size, place, 4294967295 - list_reduce(
           list_transform(regexp_extract_all(hx, '..'), lambda h: CAST('0x' || h AS BIGINT)),
           lambda acc, v: xor(acc >> 8, tab[CAST(xor(acc & 255, v) AS INTEGER) + 1]), CAST(4294967295 AS BIGINT)) AS text_crc32
  FROM d, t),
ring AS (
  SELECT row_number() OVER (ORDER BY point, shard) - 1 AS arc, point, shard
  FROM (SELECT i % 16 AS shard, CAST('0x' || substr(md5('node:' || (i % 16) || ':' || (i // 16)), 1, 15) AS BIGINT) AS point
        FROM range(16 * 128) r(i))),
r AS (
  SELECT c.*, coalesce(ring.arc, 0) AS arc FROM c ASOF LEFT JOIN ring ON c.place <= ring.point),
n AS (
  SELECT *, row_number() OVER (PARTITION BY arc ORDER BY place, doc_id NULLS FIRST, text_crc32, size) - 1 AS at FROM r),
arcs AS (
  SELECT ring.arc, shard, count(n.arc) AS rows FROM ring LEFT JOIN n ON n.arc = ring.arc GROUP BY ALL),
one AS (
  SELECT list(shard ORDER BY arc) AS shards, list(rows ORDER BY arc) AS counts, sum(rows) AS total FROM arcs),
walk AS (
  SELECT -1 AS arc, 0 AS shard, CAST(0 AS BIGINT) AS upto, CAST(0 AS BIGINT) AS add_, CAST(0 AS BIGINT) AS done,
         list_transform(range(16), lambda s: CAST(total // 16 + CASE WHEN s < total % 16 THEN 1 ELSE 0 END AS BIGINT)) AS room,
         list_transform(range(16), lambda s: CAST(0 AS BIGINT)) AS load, 0 AS next_arc
  FROM one
  UNION ALL
  SELECT arc, shard, done + take, load - done, CASE WHEN done + take < rows THEN done + take ELSE 0 END,
         list_transform(room, lambda x, i: CASE WHEN i = shard + 1 THEN x - take ELSE x END),
         list_transform(loads, lambda x, i: CASE WHEN i = shard + 1 THEN x + take ELSE x END),
         CASE WHEN done + take < rows THEN arc ELSE arc + 1 END
  FROM (
    SELECT *, least(rows - done, room[shard + 1]) AS take, loads[shard + 1] AS load
    FROM (
      SELECT w.next_arc AS arc, w.done, w.room, w.load AS loads, o.counts[w.next_arc + 1] AS rows,
             CAST(CASE WHEN o.counts[w.next_arc + 1] = 0 OR w.room[o.shards[w.next_arc + 1] + 1] > 0 THEN o.shards[w.next_arc + 1]
                  ELSE list_filter(list_concat(o.shards[w.next_arc + 1:], o.shards), lambda s: w.room[s + 1] > 0)[1] END AS INTEGER) AS shard
      FROM walk w, one o WHERE w.next_arc < len(o.shards)) q) z)
SELECT n.doc_id, n.size, n.text_crc32, 'rows' AS law, w.shard, n.at + w.add_ AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM n ASOF JOIN walk w ON n.arc = w.arc AND n.at < w.upto
"""


@query("op11_sharding_ring", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of a ring with loads bounded to row counts at most one apart."""
    return sharding_ring.assign(read_table(spark, sf_dir, "documents", "doc_id", "text"), shards=16, law="rows", slack=0.0)


OP12_SQL = """
WITH x AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda e: CAST(floor(256 * CAST(e AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
         CAST(list_sum(list_transform(range(len(a.v)), lambda i: a.v[i + 1] * c.v[i + 1])) AS BIGINT) AS score
  FROM x a JOIN x c ON c.vec_id <> a.vec_id AND a.vec_id % 50 = 0 AND len(a.v) = len(c.v)),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3"""


@query("op12_hard_negatives", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three hard negatives for each of the five positives of every 50th vector."""
    rows = read_table(spark, sf_dir, "embeddings", "vec_id", "label", "embedding")
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives.mine(rows, F.col("vec_id") % 50 == 0, positives=5, negatives=3, low=50, high=95)


@query("op13_whitening")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors projected on the 8 first components of their covariance, scaled to unit variance."""
    return whitening.whiten(read_table(spark, sf_dir, "embeddings", "vec_id", "embedding"), components=8)
