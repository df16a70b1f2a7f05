"""Split tables as partitioned Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SPLITS = ("train", "val", "test")


def write_splits(df: DataFrame, path: str) -> None:
    """One folder per split; ``df`` carries a ``split`` column."""
    df.write.mode("overwrite").partitionBy("split").parquet(path)


def read_split_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_splits(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Train, validation and test rows; each filter prunes to one folder."""
    whole = read_split_table(spark, path)
    train, val, test = (whole.where(F.col("split") == s).drop("split") for s in SPLITS)
    return train, val, test


def train_val_pool(df: DataFrame) -> DataFrame:
    """Train and validation rows together, for refitting."""
    return df.where(F.col("split").isin("train", "val"))


def schema_differences(left: DataFrame, right: DataFrame) -> list[str]:
    """Columns whose presence or type differs between two splits; empty when aligned."""
    a = {f.name: f.dataType.simpleString() for f in left.schema.fields}
    b = {f.name: f.dataType.simpleString() for f in right.schema.fields}
    return sorted(n for n in a.keys() | b.keys() if a.get(n) != b.get(n))
