"""One query per operator, over whole tables, and the SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import (
    bit_sliced, bpe, chunk_dedup, decontaminate, graph_ann, hard_negatives, license_scan, minhash, prefix_free, secret_scan, sharding, token_alignment, toxicity,
)
from tidewater.llm.common import table
from tidewater.llm.vector_shards import vector_rows


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return license_scan.report(docs, license_scan.fit(docs))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return secret_scan.span_digests(found).select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", F.col("spans_text").alias("spans"), "n_entropy"
    )


def op3_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    results = chunk_dedup.dedup_texts(docs).withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")
    return chunk_dedup.per_document(docs, results)


def op4_graph_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    queries = vectors.where(F.col("vec_id") % 100 == 0)
    return graph_ann.nearest(vectors, queries, 10).select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.report(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        "contaminated",
    )


OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), starts AS (
  SELECT item_id, w, least(13, len(w)) AS n, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0
), windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS gram FROM starts
), lengths AS (
  SELECT DISTINCT n FROM windows
), places AS (
  SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lengths WHERE len(w) >= n
), grams AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS gram FROM places
), hits AS (
  SELECT doc_id, i, g.n AS n, item_id FROM grams g JOIN windows v ON g.n = v.n AND g.gram = v.gram
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_documents(docs, model).select(
        "doc_id", (~toxicity.in_training(F.col("doc_id"))).alias("held_out"), "score", "predicted"
    )


def tokenizer(name: str = "byte_bpe_50k.tiktoken") -> bpe.Vocabulary:
    return bpe.Vocabulary.read(public_tokenizers.path(name), public_tokenizers.PATTERN)


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = tokenizer()
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    both = bpe.decode(bpe.encode(docs, vocabulary).select("doc_id", "token_ids"), vocabulary)
    return both.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = minhash.near_duplicates(docs, minhash.NearRule(width=4, percent=80))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    results = prefix_free.dedup_texts(docs).withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")
    return prefix_free.per_document(docs, results)


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign_shards(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    rows = vector_rows(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", label)
    return hard_negatives.mine(rows, rows.where(F.col("id") % 100 == 0))


def op12_bit_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = vector_rows(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    found = bit_sliced.top_k(rows, rows.where(F.col("id") % 50 == 0), 5)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = token_alignment.ByteLevel.read(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    b = token_alignment.Pieces.read(public_tokenizers.path("piece_bpe_32k.model"))
    return token_alignment.align_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), a, b)


OP11_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 100 = 0
), p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
), n AS (
  SELECT anchor_id, positive_id, other_id AS negative_id, positive_score, score AS negative_score,
         row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS n
  FROM p JOIN s USING (anchor_id)
  WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
)
SELECT anchor_id, positive_id, CAST(n AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE n <= 5
"""

OP12_SQL = """
WITH v AS (
  SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 50 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s
)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 5
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_license_scan": op1_license_scan,
        "op2_secret_scan": op2_secret_scan,
        "op3_chunk_dedup": op3_chunk_dedup,
        "op4_graph_ann": op4_graph_ann,
        "op5_decontamination": op5_decontamination,
        "op6_toxicity": op6_toxicity,
        "op7_byte_bpe": op7_byte_bpe,
        "op8_minhash": op8_minhash,
        "op9_suffix_dedup": op9_suffix_dedup,
        "op10_sharding": op10_sharding,
        "op11_hard_negatives": op11_hard_negatives,
        "op12_bit_sliced": op12_bit_sliced,
        "op13_token_alignment": op13_token_alignment,
    }


def oracle_sql() -> dict[str, str]:
    return {"op5_decontamination": OP5_SQL, "op11_hard_negatives": OP11_SQL, "op12_bit_sliced": OP12_SQL}
