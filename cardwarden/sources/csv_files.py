"""Typed CSV scans and CSV outputs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwarden.schema import REQUEST_SCHEMA, ROW_ID, SOURCE_INDEX, SOURCE_SCHEMA


def read_transactions_csv(spark: SparkSession, path: str) -> DataFrame:
    """Scan one transaction CSV with the declared types.

    The header is checked against the schema and a malformed value fails the job; a missing path
    fails when the plan is built. Types are never inferred, so card numbers and postal codes keep
    their leading zeros and no extra pass over the file is made.
    """
    df = (
        spark.read.schema(SOURCE_SCHEMA)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(path)
    )
    return df.withColumnRenamed(SOURCE_INDEX, ROW_ID)


def first_rows(df: DataFrame, n: int | None) -> DataFrame:
    """The first ``n`` rows of one source by row number (a distributed top-n, not a full sort)."""
    return df if n is None else df.orderBy(ROW_ID).limit(n)


def stack_sources(sources: dict[str, DataFrame], sample_rows: int | None = None) -> DataFrame:
    """All sources below each other. ``row_id`` restarts per source, ``source`` tells them apart."""
    parts = [
        first_rows(df, sample_rows).withColumn("source", F.lit(name)) for name, df in sources.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def load_sources(
    spark: SparkSession, paths: dict[str, str], sample_rows: int | None = None
) -> DataFrame:
    return stack_sources(
        {name: read_transactions_csv(spark, path) for name, path in paths.items()}, sample_rows
    )


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_request_csv(spark: SparkSession, path: str) -> DataFrame:
    """Scoring requests from CSV files whose header names may carry stray blanks.

    Columns are matched by trimmed name. Files of a folder may order their columns differently: files
    are grouped by their header line, and each group is read by its own header. Known columns get the
    request types, others stay text; columns that no file has are left out.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    # One line per file: the first of its first block.
    headers = lines.where("start = 0").groupBy("file").agg(F.first("value").alias("header"))
    by_header: dict[str, list[str]] = {}
    for r in headers.orderBy("file").collect():
        by_header.setdefault(r["header"], []).append(r["file"])
    types = {f.name: f.dataType.simpleString() for f in REQUEST_SCHEMA.fields}

    def read(files: list[str]) -> DataFrame:
        raw = spark.read.option("header", True).option("enforceSchema", False).csv(files)
        named = raw.toDF(*[c.strip() for c in raw.columns])
        return named.select(*[F.col(f"`{c}`").try_cast(types[c]).alias(c) if c in types else F.col(f"`{c}`") for c in named.columns])

    parts = [read(files) for files in by_header.values()]
    if not parts:
        return spark.read.option("header", True).csv(path)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
