"""Reports as JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def to_json_rows(df: DataFrame) -> DataFrame:
    """Each row as one JSON document; missing values are written as null."""
    document = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    return df.select(document.alias("value"))


def write_report(df: DataFrame, path: str) -> None:
    to_json_rows(df).write.mode("overwrite").text(path)


def read_report(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)
