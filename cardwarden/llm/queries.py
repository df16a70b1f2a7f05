"""The registered queries of the operators, with SQL where it can express them."""

from __future__ import annotations

import functools
import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwarden.llm import (
    byte_bpe, exact_dedup, hard_negatives, lm_scoring, minhash, packing, simhash, substring_dedup, token_alignment, token_counts,
    topk, toxicity, warc,
)
from cardwarden.session import ship_package

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = functools.wraps(fn)(lambda spark, sf_dir: fn(ship_package(spark), sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Path of a public vocabulary; ``CARDWARDEN_TOKENIZERS`` names another folder."""
    folder = os.environ.get("CARDWARDEN_TOKENIZERS")
    return os.path.join(folder, name) if folder else public_tokenizers.path(name)


@query("op1_byte_bpe")
def byte_bpe_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = vocabulary("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.digests(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


@query("op2_warc")
def warc_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.round_trip(table(spark, sf_dir, "pages"), least_bytes=0)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op3_toxicity")
def toxicity_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


@query("op4_simhash")
def simhash_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicate_components(table(spark, sf_dir, "documents"), radius=2, shingle=3)


@query("op5_substring_dedup")
def substring_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeated(table(spark, sf_dir, "documents"), window=35)


@query(
    "op6_exact_dedup",
    """WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM t WINDOW w AS (PARTITION BY norm)""",
)
def exact_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


@query("op7_lm_scoring")
def lm_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(table(spark, sf_dir, "documents"))


@query("op8_token_counts")
def token_count_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.prefix_token_counts(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))
    n_tokens = token_counts.total_tokens(F.col("prefix_tokens"))
    return counts.select("doc_id", "n_bytes", n_tokens.alias("n_tokens"), (n_tokens > 2048).alias("over_limit"))


@query(
    "op9_topk",
    """WITH v AS (
  SELECT vec_id, row_number() OVER () AS r, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS q
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0), s AS (
  SELECT a.r, a.vec_id AS query_id, b.vec_id AS vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.r <> b.r AND len(a.q) = len(b.q))
SELECT query_id, CAST(row_number() OVER w AS INT) AS rank, vec_id, score FROM s
WINDOW w AS (PARTITION BY r ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 10""",
)
def topk_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), "id % 100 = 0", k=10)


@query("op10_packing")
def packing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), 2048)


@query(
    "op11_minhash",
    """WITH RECURSIVE t AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents), s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM t), n AS (
  SELECT g, len(g) AS n, row_number() OVER () AS node FROM (SELECT list_sort(g) AS g FROM s WHERE len(g) > 0 GROUP BY 1)), e AS (
  SELECT node, n, unnest(g) AS x FROM n), p AS (
  SELECT a.node AS a, b.node AS b FROM e a JOIN e b ON a.x = b.x AND a.node <> b.node GROUP BY 1, 2, a.n, b.n
  HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))), r(a, b) AS (
  SELECT node, node FROM n UNION SELECT r.a, p.b FROM r JOIN p ON r.b = p.a), d AS (
  SELECT s.doc_id, len(s.g) AS n, n.node FROM s LEFT JOIN n ON list_sort(s.g) = n.g), least_id AS (
  SELECT node, min(doc_id) AS i FROM d GROUP BY 1), c AS (
  SELECT r.a AS node, min(i) AS i FROM r JOIN least_id ON r.b = least_id.node GROUP BY 1)
SELECT d.doc_id, CAST(d.n AS BIGINT) AS n_shingles, coalesce(c.i, d.doc_id) AS component_id,
       d.doc_id = coalesce(c.i, d.doc_id) AS kept
FROM d LEFT JOIN c ON d.node = c.node""",
)
def minhash_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=5, percent=85)


@query(
    "op12_hard_negatives",
    """WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)), p AS (
  SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5), n AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same
    AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INT) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3""",
)
def hard_negative_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = "CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END"
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), "id % 50 = 0", label)


@query("op13_token_alignment")
def token_alignment_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")
    return token_alignment.align_documents(table(spark, sf_dir, "documents"), *files)
