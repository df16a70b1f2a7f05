"""Raw sources to split feature tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from cardwarden.operators.features import add_all_features
from cardwarden.operators.splitting import fit_split, hash_split, with_split
from cardwarden.operators.summaries import dataset_summary, split_summary
from cardwarden.operators.validation import store_checked
from cardwarden.schema import ENGINEERED, LABEL, SPLIT_DEFAULTS, TRANSACTION_COLUMNS
from cardwarden.session import settle_table
from cardwarden.sources.csv_files import first_rows, load_sources, read_transactions_csv, write_csv
from cardwarden.sources.report_files import write_report
from cardwarden.sources.split_files import SPLITS, write_splits


def split_features(
    raw: DataFrame,
    key: list[str],
    exact: bool = True,
    engineer: bool = True,
    test_size: float = SPLIT_DEFAULTS["test_size"],
    val_size: float = SPLIT_DEFAULTS["val_size"],
) -> DataFrame:
    """Features plus a ``split`` column; the split is decided on the raw table's key and label."""
    features = add_all_features(raw, spread_by=key) if engineer else raw
    if not exact:
        return hash_split(features, key, test_size, val_size)
    return with_split(features, fit_split(raw, key, test_size=test_size, val_size=val_size))


def settled_features(raw: DataFrame, key: list[str], exact: bool = False) -> DataFrame:
    """The split feature table written once, for jobs that read it many times."""
    return settle_table(split_features(raw, key, exact), "features")


def prepare_dataset(
    spark, paths: dict[str, str], output: str, sample_rows: int | None = None, engineer: bool = True
) -> DataFrame:
    """Load, validate, engineer, split and write; returns the per-split summary.

    Each CSV file is parsed once, while its typed rows are stored; the rules are counted by that write, and a breach
    stops the job before there is an output. The summary is counted while the features are written.
    """
    raw, _ = store_checked(load_sources(spark, paths, sample_rows), "raw")
    seen = Observation()
    counts = [
        c.alias(f"{s}_{n}")
        for s in SPLITS
        for n, c in (
            ("rows", F.count_if(F.col("split") == s)),
            ("fraud", F.sum(F.when(F.col("split") == s, F.col(LABEL).cast("bigint")))),
            ("labels", F.count(F.when(F.col("split") == s, F.col(LABEL)))),
        )
    ]
    write_splits(split_features(raw, ["source", "row_id"], engineer=engineer).observe(seen, *counts), output)
    found, width = seen.get, len(TRANSACTION_COLUMNS)
    rows = [
        (s, found[f"{s}_rows"], found[f"{s}_fraud"], found[f"{s}_fraud"] / found[f"{s}_labels"] if found[f"{s}_labels"] else None,
         width - 1, width + len(ENGINEERED))
        for s in SPLITS if found[f"{s}_rows"]
    ]
    return spark.createDataFrame(
        rows, "split string, rows bigint, fraud_rows bigint, fraud_rate double, original_features int, engineered_features int"
    )


def preparation_summary(written: DataFrame, original_columns: int) -> DataFrame:
    """Per split rows and rate, with table-wide counts beside them."""
    return split_summary(written).select(
        "split",
        "rows",
        "fraud_rows",
        "fraud_rate",
        F.lit(original_columns - 1).alias("original_features"),
        F.lit(original_columns + len(ENGINEERED)).alias("engineered_features"),
    )


def clean_sources(
    spark, paths: dict[str, str], output: str, report: str, sample_rows: int | None = None
) -> DataFrame:
    """Validated CSV copies per source and one summary row per source.

    A source is parsed once, while its typed rows are stored and checked; copy and summary read those.
    """
    summaries = None
    for name, path in paths.items():
        frame, _ = store_checked(first_rows(read_transactions_csv(spark, path), sample_rows), "clean")
        write_csv(frame, f"{output}/{name}")
        part = dataset_summary(frame).select(F.lit(name).alias("dataset"), "*")
        summaries = part if summaries is None else summaries.unionByName(part)
    write_report(summaries, report)
    return summaries
