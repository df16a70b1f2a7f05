"""The corpus pipeline: toxicity, exact and near duplicates, repeated passages, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a table, which is stored as Parquet and read again as the
next stage's documents. All but the last return the columns of the documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cardwarden.llm import exact_dedup, packing, simhash, substring_dedup, toxicity
from cardwarden.llm.queries import table, vocabulary
from cardwarden.session import settle_table, ship_package


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted to be toxic go."""
    ship_package(spark)
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest id stays."""
    ship_package(spark)
    return exact_dedup.drop_exact_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of fingerprints linked at 2 or fewer bits the document with the smallest id stays."""
    ship_package(spark)
    return simhash.keep_first(docs, radius=2, shingle=3)


def passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of passages that occur more than once go; texts without such words stay as they are."""
    ship_package(spark)
    return substring_dedup.without_repeated(docs, window=35)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 2048 ids: one row per piece of a document."""
    ship_package(spark)
    return packing.pack(docs, vocabulary("word_bpe_49k.json"), 2048)


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_stage),
    ("simhash_near_dedup", near_stage),
    ("substring_dedup", passage_stage),
    ("packing", packing_stage),
]

#: Models, fingerprints and packing patterns are beyond SQL; tests/llm compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are stored below the shared folder before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle_table(stage(spark, docs, sf_dir), name)
    return docs
