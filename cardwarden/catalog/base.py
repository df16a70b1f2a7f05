"""Shared pieces of the query catalogue: registration, views and SQL fragments."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwarden.functions.hashing import uniform
from cardwarden.operators.splitting import hash_split
from cardwarden.session import ship_package
from cardwarden.sources.events import raw_transactions, table, transactions  # noqa: F401

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

KEY = ["row_id"]


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, where SQL can express it, its counterpart."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = functools.wraps(fn)(lambda spark, sf_dir: fn(ship_package(spark), sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, so that summation order does not show.

    Means of cent amounts often end in an exact half of the last digit, where the order of a sum
    would still decide; both sides therefore move all values by the same tiny amount first.
    """
    return df.select(
        *[F.round(F.col(c) + 1e-9, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    )


# --------------------------------------------------------------------------- SQL fragments
TXN = """txn AS (
  SELECT event_id AS row_id,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS trans_date_trans_time,
         CAST(user_id AS VARCHAR) AS cc_num,
         'm' || json_extract_string(props, '$.k') AS merchant,
         event_type AS category,
         value AS amt,
         CAST((user_id * 37) % 140 - 70 AS DOUBLE) AS lat,
         CAST((user_id * 53) % 340 - 170 AS DOUBLE) AS long,
         CAST((user_id * 7919) % 100000 + 100 AS BIGINT) AS city_pop,
         CAST(floor(epoch(ts)) AS BIGINT) AS unix_time,
         CAST((user_id * 37) % 140 - 70 AS DOUBLE)
           + (CAST(json_extract_string(props, '$.k') AS INT) - 50) / 25e0 AS merch_lat,
         CAST((user_id * 53) % 340 - 170 AS DOUBLE)
           + ((CAST(json_extract_string(props, '$.k') AS INT) % 10) - 5) / 5e0 AS merch_long,
         md5(CAST(event_id AS VARCHAR)) AS trans_num,
         CAST(value > 150 OR (event_type = 'error' AND value > 100) AS INT) AS is_fraud
  FROM events)"""

RAW = TXN + """, raw AS (
  SELECT row_id,
         CASE WHEN row_id % 911 = 0 THEN replace(trans_date_trans_time, '2024-01', '2024-13')
              ELSE trans_date_trans_time END AS trans_date_trans_time,
         CASE WHEN row_id % 499 = 0 THEN cc_num || 'x' ELSE cc_num END AS cc_num,
         CASE WHEN row_id % 997 <> 0 THEN merchant END AS merchant,
         CASE WHEN row_id % 983 = 0 THEN '' ELSE category END AS category,
         CASE WHEN row_id % 701 = 0 THEN -amt ELSE amt END AS amt,
         'first' || CAST(card % 97 AS VARCHAR) AS first,
         'last' || CAST(card % 89 AS VARCHAR) AS last,
         CASE WHEN row_id % 603 = 0 THEN 'U' WHEN card % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
         CAST(card % 900 AS VARCHAR) || ' Main St' AS street,
         'city' || CAST(card % 50 AS VARCHAR) AS city,
         CASE WHEN row_id % 887 = 0 THEN 'usa'
              ELSE chr(CAST(card % 26 + 65 AS INT)) || chr(CAST((card * 7) % 26 + 65 AS INT)) END AS state,
         CAST((card * 6007) % 100000 AS VARCHAR) AS zip,
         CASE WHEN row_id % 1201 = 0 THEN lat + 200 ELSE lat END AS lat,
         long, city_pop,
         'job' || CAST(card % 31 AS VARCHAR) AS job,
         CASE WHEN row_id % 809 = 0 THEN '1990-02-30'
              ELSE strftime(DATE '1950-01-01' + CAST((card * 37) % 18000 AS INT), '%Y-%m-%d') END AS dob,
         trans_num, unix_time, merch_lat, merch_long, is_fraud
  FROM (SELECT *, CAST(cc_num AS BIGINT) AS card FROM txn))"""


def u_sql(seed: int = 42, key: str = "row_id") -> str:
    return (
        f"(CAST('0x' || substr(md5('{seed}:' || CAST({key} AS VARCHAR)), 1, 8) AS BIGINT)"
        " / 4294967296e0)"
    )


def split_sql(key: str = "row_id") -> str:
    u = u_sql(42, key)
    return f"CASE WHEN {u} < 0.2e0 THEN 'test' WHEN {u} < 0.2e0 + 0.1e0 THEN 'val' ELSE 'train' END"


FEATURES = TXN + """, cs AS (
  SELECT cc_num, count(*) AS customer_txn_count, avg(amt) AS customer_avg_amt,
         coalesce(stddev_samp(amt), 0) AS customer_std_amt, coalesce(avg(is_fraud), 0) AS customer_fraud_rate
  FROM txn WHERE cc_num IS NOT NULL GROUP BY 1), ms AS (
  SELECT merchant, coalesce(avg(is_fraud), 0) AS merchant_fraud_rate, count(*) AS merchant_txn_count,
         avg(amt) AS merchant_avg_amt, coalesce(stddev_samp(amt), 0) AS merchant_std_amt
  FROM txn WHERE merchant IS NOT NULL GROUP BY 1), gs AS (
  SELECT category, coalesce(avg(is_fraud), 0) AS category_fraud_rate, count(*) AS category_txn_count,
         avg(amt) AS category_avg_amt
  FROM txn WHERE category IS NOT NULL GROUP BY 1), joined AS (
  SELECT txn.*, strptime(trans_date_trans_time, '%Y-%m-%d %H:%M:%S') AS tt,
         customer_txn_count, customer_avg_amt, customer_std_amt, customer_fraud_rate,
         merchant_fraud_rate, merchant_txn_count, merchant_avg_amt, merchant_std_amt,
         category_fraud_rate, category_txn_count, category_avg_amt,
         2 * (3959 * 1.60934e0) * asin(least(1, sqrt(
           pow(sin(radians(merch_lat - lat) / 2), 2)
           + cos(radians(lat)) * cos(radians(merch_lat)) * pow(sin(radians(merch_long - long) / 2), 2)))) AS distance_km
  FROM txn LEFT JOIN cs USING (cc_num) LEFT JOIN ms USING (merchant) LEFT JOIN gs USING (category)), scored_rows AS (
  SELECT *, coalesce((amt - customer_avg_amt) / (customer_std_amt + 1), 0) AS amt_zscore FROM joined), feat AS (
  SELECT row_id, trans_date_trans_time, cc_num, merchant, category, amt, lat, long, city_pop, unix_time,
         merch_lat, merch_long, trans_num, is_fraud,
         CAST(hour(tt) AS INT) AS hour_of_day, CAST(isodow(tt) - 1 AS INT) AS day_of_week,
         CAST(isodow(tt) >= 6 AS INT) AS is_weekend, CAST(month(tt) AS INT) AS month,
         CAST(day(tt) AS INT) AS day_of_month,
         customer_txn_count, customer_avg_amt, customer_std_amt, customer_fraud_rate,
         merchant_fraud_rate, merchant_txn_count, merchant_avg_amt, merchant_std_amt,
         category_fraud_rate, category_txn_count, category_avg_amt,
         distance_km, CAST(coalesce(distance_km > 100, false) AS INT) AS is_distant_txn,
         amt_zscore, CAST(abs(amt_zscore) > 3 AS INT) AS amt_is_outlier,
         CASE WHEN amt / (customer_avg_amt + 1) > 100 THEN 100 ELSE amt / (customer_avg_amt + 1) END
           AS amt_ratio_to_customer_avg,
         """ + split_sql() + """ AS split
  FROM scored_rows)"""


# --------------------------------------------------------------------------- scored table
#: Two rule-based scorers with different tie structure; position 0 was "trained" first.
SCORERS = ["Amount Rule", "Blend Rule"]


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(row_id, category, day, model, split, label, score)`` for both scorers."""
    txn = hash_split(transactions(spark, sf_dir), KEY)
    amount = F.least(F.floor(F.col("amt") / 3.0) / F.lit(100.0), F.lit(1.0))
    blend = uniform(KEY, 7) * 0.5 + F.least(F.col("amt") / 200.0, F.lit(1.0)) * 0.5
    wide = txn.select(
        "row_id",
        "category",
        F.substring("trans_date_trans_time", 9, 2).cast("int").alias("day"),
        "split",
        F.col("is_fraud").alias("label"),
        amount.alias(SCORERS[0]),
        blend.alias(SCORERS[1]),
    )
    return wide.unpivot(["row_id", "category", "day", "split", "label"], SCORERS, "model", "score")


SCORED = TXN + f""", base AS (
  SELECT row_id, category, CAST(substr(trans_date_trans_time, 9, 2) AS INT) AS day, {split_sql()} AS split,
         is_fraud AS y,
         least(floor(amt / 3e0) / 100e0, 1e0) AS s0,
         {u_sql(7)} * 0.5e0 + least(amt / 200e0, 1e0) * 0.5e0 AS s1
  FROM txn), scored AS (
  SELECT row_id, category, day, split, y, 'Amount Rule' AS model, 0 AS position, s0 AS s FROM base
  UNION ALL
  SELECT row_id, category, day, split, y, 'Blend Rule' AS model, 1 AS position, s1 AS s FROM base)"""


def ranked_sql(by: str, source: str = "scored") -> str:
    """CTEs ``coll`` and ``ranked``: distinct scores with running totals, best first."""
    return f"""coll AS (
  SELECT {by}, s, CAST(sum(y) AS DOUBLE) AS pos, CAST(count(*) AS DOUBLE) AS n FROM {source} GROUP BY {by}, s), ranked AS (
  SELECT *, sum(pos) OVER w AS tp, sum(n) OVER w AS cnt, sum(pos) OVER g AS p_all, sum(n) OVER g AS n_all
  FROM coll WINDOW w AS (PARTITION BY {by} ORDER BY s DESC ROWS UNBOUNDED PRECEDING), g AS (PARTITION BY {by}))"""


def metrics_sql(by: str, source: str = "scored", threshold: str = "0.5e0", op: str = ">=") -> str:
    """CTE ``m``: all report metrics per group, unrounded."""
    cols = [c.strip() for c in by.split(",")]
    on = " AND ".join(f"a.{c} = b.{c}" for c in cols)
    qualified = ", ".join(f"a.{c}" for c in cols)
    return ranked_sql(by, source) + f""", ranking AS (
  SELECT {by},
         CASE WHEN max(p_all) > 0 AND max(n_all - p_all) > 0
              THEN sum((n - pos) * (tp - pos + pos * 0.5e0)) / (max(p_all) * max(n_all - p_all)) END AS auc_roc,
         CASE WHEN max(p_all) > 0 THEN sum(pos * tp / cnt) / max(p_all) ELSE 0 END AS auprc,
         CASE WHEN max(p_all) > 0 THEN sum(pos * (tp / cnt
              + CASE WHEN cnt - n > 0 THEN (tp - pos) / (cnt - n) ELSE 1 END) / 2) / max(p_all) ELSE 0 END AS pr_trapezoid
  FROM ranked GROUP BY {by}), counts AS (
  SELECT {by}, CAST(count(*) FILTER (s {op} {threshold} AND y = 1) AS DOUBLE) AS tp,
         CAST(count(*) FILTER (s {op} {threshold} AND y = 0) AS DOUBLE) AS fp,
         CAST(count(*) FILTER (NOT s {op} {threshold} AND y = 1) AS DOUBLE) AS fn,
         CAST(count(*) FILTER (NOT s {op} {threshold} AND y = 0) AS DOUBLE) AS tn
  FROM {source} GROUP BY {by}), m AS (
  SELECT {qualified}, a.auc_roc, a.auprc, a.pr_trapezoid,
         CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS recall,
         CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS "precision",
         CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END AS f1,
         (tp + tn) / (tp + fp + fn + tn) AS accuracy,
         CASE WHEN fp + tn > 0 THEN fp / (fp + tn) ELSE 0 END AS false_positive_rate
  FROM ranking a JOIN counts b ON {on})"""


def long_metrics_sql(by: str, cte: str = "m") -> str:
    """CTE ``ml``: rows ``(by, metric, value)``."""
    parts = [
        f"SELECT {by}, '{m}' AS metric, {q} AS value FROM {cte}"
        for m, q in [
            ("auc_roc", "auc_roc"),
            ("auprc", "auprc"),
            ("recall", "recall"),
            ("precision", '"precision"'),
            ("f1", "f1"),
        ]
    ]
    return "ml AS (" + " UNION ALL ".join(parts) + ")"
