"""Sources, sinks, validation and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from cardwarden.catalog.base import KEY, RAW, TXN, query, raw_transactions, rounded, split_sql, transactions
from cardwarden.operators.splitting import hash_split
from cardwarden.operators.summaries import dataset_summary, split_summary
from cardwarden.operators.validation import (
    column_contract,
    filled_counts,
    null_counts,
    quarantine,
    request_rules,
    violations,
    with_reasons,
)
from cardwarden.schema import REQUEST_SCHEMA, ROW_ID, SOURCE_INDEX, TRANSACTION_COLUMNS
from cardwarden.session import scratch_path
from cardwarden.sources.csv_files import (
    read_request_csv,
    read_transactions_csv,
    stack_sources,
    write_csv,
)
from cardwarden.sources.report_files import read_report, write_report
from cardwarden.sources.split_files import read_splits, schema_differences, train_val_pool, write_splits

RAW_SELECT = """SELECT row_id, trans_date_trans_time, cc_num, merchant, nullif(category, '') AS category, round(amt + 1e-9, 6) AS amt,
       first, last, gender, street, city, state, zip, lat, long, city_pop, job, dob, trans_num, unix_time,
       round(merch_lat + 1e-9, 6) AS merch_lat, round(merch_long + 1e-9, 6) AS merch_long, CAST(is_fraud AS TINYINT) AS is_fraud
FROM raw"""


@query("typed_csv_scan", f"WITH {RAW} {RAW_SELECT}")
def typed_csv_scan(spark, sf_dir):
    """The raw table written as CSV and scanned back with declared types."""
    path = scratch_path(spark, "raw-csv")
    write_csv(raw_transactions(spark, sf_dir).withColumnRenamed(ROW_ID, SOURCE_INDEX), path)
    return rounded(read_transactions_csv(spark, path))


@query(
    "batch_upload_parse",
    f"WITH {RAW} SELECT "
    + ", ".join(
        f'round("{f.name}" + 1e-9, 6) AS "{f.name}"' if f.dataType.simpleString() == "double"
        else f"""nullif("{f.name}", '') AS "{f.name}\"""" if f.dataType.simpleString() == "string" else f'"{f.name}"'
        for f in REQUEST_SCHEMA.fields
    )
    + " FROM raw",
)
def batch_upload_parse(spark, sf_dir):
    """Request rows with all their columns, from CSV files whose header carries blanks."""
    path = scratch_path(spark, "upload-csv")
    raw = raw_transactions(spark, sf_dir).select(*REQUEST_SCHEMA.fieldNames())
    write_csv(raw.toDF(*[f" {c} " for c in raw.columns]), path)
    return rounded(read_request_csv(spark, path))


@query(
    "sample_head",
    f"""WITH {TXN}, src AS (SELECT *, CASE WHEN category IN ('click', 'view') THEN 'browse' ELSE 'act' END AS source FROM txn)
SELECT source, row_id, cc_num, round(amt + 1e-9, 6) AS amt FROM (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY row_id) AS rn FROM src) WHERE rn <= 500""",
)
def sample_head(spark, sf_dir):
    """The first 500 rows of each of two sources."""
    txn = transactions(spark, sf_dir)
    browsing = F.col("category").isin("click", "view")
    both = stack_sources({"browse": txn.where(browsing), "act": txn.where(~browsing)}, sample_rows=500)
    return rounded(both.select("source", "row_id", "cc_num", "amt"))


@query(
    "load_union",
    f"""WITH {TXN} SELECT CASE WHEN category IN ('click', 'view') THEN 'browse' ELSE 'act' END AS source,
  row_id, cc_num, merchant, category, round(amt + 1e-9, 6) AS amt, is_fraud FROM txn""",
)
def load_union(spark, sf_dir):
    txn = transactions(spark, sf_dir)
    browsing = F.col("category").isin("click", "view")
    both = stack_sources({"browse": txn.where(browsing), "act": txn.where(~browsing)})
    return rounded(both.select("source", "row_id", "cc_num", "merchant", "category", "amt", "is_fraud"))


@query(
    "split_roundtrip",
    f"""WITH {TXN} SELECT {split_sql()} AS split, row_id, cc_num, round(amt + 1e-9, 6) AS amt, is_fraud FROM txn""",
)
def split_roundtrip(spark, sf_dir):
    """Splits written as partitioned Parquet and read back one by one."""
    path = scratch_path(spark, "splits")
    write_splits(
        hash_split(transactions(spark, sf_dir), KEY).select("row_id", "cc_num", "amt", "is_fraud", "split"), path
    )
    train, val, test = read_splits(spark, path)
    parts = [df.withColumn("split", F.lit(s)) for s, df in [("train", train), ("val", val), ("test", test)]]
    return rounded(parts[0].unionByName(parts[1]).unionByName(parts[2]))


@query(
    "split_alignment",
    f"""WITH {TXN} SELECT split, count(*) AS rows, CAST(0 AS INT) AS differing_columns
FROM (SELECT *, {split_sql()} AS split FROM txn) WHERE split <> 'train' GROUP BY 1""",
)
def split_alignment(spark, sf_dir):
    """Columns whose presence or type differs from the training split."""
    path = scratch_path(spark, "splits")
    write_splits(hash_split(transactions(spark, sf_dir), KEY), path)
    train, val, test = read_splits(spark, path)
    checked = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(s).alias("split"), "rows", F.lit(len(schema_differences(train, df))).alias("differing_columns")
        )
        for s, df in [("val", val), ("test", test)]
    ]
    return checked[0].unionByName(checked[1])


@query(
    "train_val_pool",
    f"""WITH {TXN} SELECT row_id, split, is_fraud FROM (SELECT *, {split_sql()} AS split FROM txn)
WHERE split = 'train' UNION ALL SELECT row_id, split, is_fraud FROM (SELECT *, {split_sql()} AS split FROM txn) WHERE split = 'val'""",
)
def pool(spark, sf_dir):
    return train_val_pool(hash_split(transactions(spark, sf_dir), KEY)).select("row_id", "split", "is_fraud")


SUMMARY_COLUMNS = """count(*) AS rows, CAST(sum(is_fraud) AS BIGINT) AS fraud_rows, round(avg(is_fraud) + 1e-9, 6) AS fraud_rate,
  round(min(amt) + 1e-9, 6) AS amt_min, round(avg(amt) + 1e-9, 6) AS amt_mean, round(max(amt) + 1e-9, 6) AS amt_max,
  strftime(min(strptime(trans_date_trans_time, '%Y-%m-%d %H:%M:%S')), '%Y-%m-%dT%H:%M:%S') AS time_from,
  strftime(max(strptime(trans_date_trans_time, '%Y-%m-%d %H:%M:%S')), '%Y-%m-%dT%H:%M:%S') AS time_to,
  count(DISTINCT cc_num) AS unique_cards, count(DISTINCT merchant) AS unique_merchants,
  count(DISTINCT category) AS unique_categories"""


@query(
    "report_json",
    f"""WITH {TXN} SELECT split, count(*) AS rows, CAST(sum(is_fraud) AS BIGINT) AS fraud_rows,
  round(avg(is_fraud) + 1e-9, 6) AS fraud_rate FROM (SELECT *, {split_sql()} AS split FROM txn) GROUP BY 1""",
)
def report_json(spark, sf_dir):
    """A report written as JSON lines and read back."""
    path = scratch_path(spark, "report")
    report = split_summary(hash_split(transactions(spark, sf_dir), KEY))
    write_report(report, path)
    return rounded(read_report(spark, path, report.schema))


def _rules_sql() -> list[tuple[str, str, str]]:
    rules = []
    for c in ["merchant", "category", "first", "last", "street", "city", "job"]:
        rules.append(("non_empty", c, f"coalesce(regexp_full_match({c}, '.+'), false)"))
    for c, p in [
        ("trans_date_trans_time", r"\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}"),
        ("cc_num", r"\d+"),
        ("state", "[A-Z]{2}"),
        ("zip", r"\d{4,5}"),
        ("dob", r"\d{4}-\d{2}-\d{2}"),
        ("trans_num", "[0-9a-f]{32}"),
    ]:
        rules.append(("pattern", c, f"coalesce(regexp_full_match({c}, '{p}'), false)"))
    for c in ["row_id", "city_pop", "unix_time", "amt"]:
        rules.append(("non_negative", c, f"coalesce({c} >= 0, false)"))
    rules.append(("allowed_values", "gender", "coalesce(gender IN ('F', 'M'), false)"))
    rules.append(("allowed_values", "is_fraud", "coalesce(is_fraud IN (0, 1), false)"))
    for c, b in [("lat", 90), ("merch_lat", 90), ("long", 180), ("merch_long", 180)]:
        rules.append(("range", c, f"coalesce({c} BETWEEN -{b} AND {b}, false)"))
    rules.append(
        ("calendar", "trans_date_trans_time", "try_strptime(trans_date_trans_time, '%Y-%m-%d %H:%M:%S') IS NOT NULL")
    )
    rules.append(("calendar", "dob", "try_strptime(dob, '%Y-%m-%d') IS NOT NULL"))
    return rules


_GOOD = " AND ".join(f"({ok})" for _, _, ok in _rules_sql())


@query(
    "cleaned_csv_summary",
    f"""WITH {RAW}, src AS (SELECT *, CASE WHEN category IN ('click', 'view') THEN 'browse' ELSE 'act' END AS dataset FROM raw
  WHERE {_GOOD}) SELECT dataset, {SUMMARY_COLUMNS} FROM src GROUP BY 1""",
)
def cleaned_csv_summary(spark, sf_dir):
    """Rows that keep all rules, written as cleaned CSV per source, scanned and summarised."""
    good, _ = quarantine(raw_transactions(spark, sf_dir))
    browsing = F.col("category").isin("click", "view")
    out = None
    for name, rows in [("browse", good.where(browsing)), ("act", good.where(~browsing))]:
        path = scratch_path(spark, f"clean-{name}")
        write_csv(rows.withColumnRenamed(ROW_ID, SOURCE_INDEX), path)
        part = dataset_summary(read_transactions_csv(spark, path)).withColumn("dataset", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return rounded(out)


@query(
    "validate_rules",
    f"WITH {RAW} "
    + " UNION ALL ".join(
        f"SELECT '{r}' AS rule, '{c}' AS column_name, count(*) FILTER (NOT ({ok})) AS violations FROM raw"
        for r, c, ok in _rules_sql()
    ),
)
def validate_rules(spark, sf_dir):
    return violations(raw_transactions(spark, sf_dir))


_CONTRACT = ", ".join(f"({i}, '{c}')" for i, c in enumerate(TRANSACTION_COLUMNS))


@query(
    "schema_contract",
    f"""WITH {RAW}, expected(position, name) AS (VALUES {_CONTRACT}), present AS ("""
    + " UNION ALL ".join(f"SELECT '{c}' AS name, count({c}) AS filled FROM raw" for c in TRANSACTION_COLUMNS)
    + """) SELECT CAST(position AS INT) AS position, name AS expected, name AS actual, true AS ok, filled
FROM expected JOIN present USING (name)""",
)
def schema_contract(spark, sf_dir):
    """Every column's place in the contract and how many rows fill it."""
    raw = raw_transactions(spark, sf_dir)
    filled = filled_counts(raw).withColumnRenamed("column_name", "actual")
    return column_contract(raw).join(filled, "actual").select("position", "expected", "actual", "ok", "filled")


_REASONS = [
    *[("required", c, f"{c} IS NOT NULL") for c in REQUEST_SCHEMA.fieldNames()],
    *[("non_negative", c, f"{c} >= 0") for c in ("amt", "city_pop", "unix_time")],
    ("pattern", "gender", "regexp_full_match(gender, '[FM]')"),
    ("pattern", "state", "regexp_full_match(state, '[A-Z]{2}')"),
    *[(("range"), c, f"{c} BETWEEN -{b} AND {b}") for c, b in [("lat", 90), ("merch_lat", 90), ("long", 180), ("merch_long", 180)]],
]
_REASON_LIST = ", ".join(f"CASE WHEN NOT coalesce({ok}, false) THEN '{r}:{c}' END" for r, c, ok in _REASONS)


@query(
    "request_quarantine",
    f"""WITH {RAW}, checked AS (SELECT row_id, list_filter([{_REASON_LIST}], lambda x: x IS NOT NULL) AS reasons FROM raw)
SELECT row_id, len(reasons) = 0 AS valid, array_to_string(reasons, ',') AS reason_text FROM checked""",
)
def request_quarantine(spark, sf_dir):
    """Every request row with its verdict and reasons."""
    checked = with_reasons(raw_transactions(spark, sf_dir), request_rules())
    return checked.select("row_id", "valid", F.array_join("reasons", ",").alias("reason_text"))


_NULL_COLUMNS = TRANSACTION_COLUMNS


@query(
    "null_counts",
    f"WITH {RAW} "
    + " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) - count(\"{c}\") AS nulls FROM raw" for c in _NULL_COLUMNS)
    + f" UNION ALL SELECT '(total)' AS column_name, {' + '.join(f'(count(*) - count({chr(34)}{c}{chr(34)}))' for c in _NULL_COLUMNS)} AS nulls FROM raw",
)
def nulls(spark, sf_dir):
    return null_counts(raw_transactions(spark, sf_dir), _NULL_COLUMNS)


