"""Feature, aggregation, join, split and summary queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from cardwarden.catalog.base import (
    FEATURES,
    KEY,
    SCORED,
    TXN,
    query,
    rounded,
    scored,
    split_sql,
    transactions,
)
from cardwarden.catalog.ingest import SUMMARY_COLUMNS
from cardwarden.operators.features import (
    add_all_features,
    add_amount_features,
    add_distance_features,
    add_temporal_features,
    feature_matrix,
)
from cardwarden.operators.group_stats import (
    CARD,
    CATEGORY,
    MERCHANT,
    category_statistics,
    customer_statistics,
    join_statistics,
    merchant_statistics,
)
from cardwarden.operators.history import apply_statistics, earlier_statistics, fit_statistics
from cardwarden.operators.scoring import collect_defaults, decide, request_features
from cardwarden.operators.splitting import fit_split, hash_split, stratified_sample, with_folds, with_split
from cardwarden.operators.summaries import (
    class_distribution,
    class_weights,
    dataset_summary,
    exact_p95,
    histogram,
    histogram_quantile,
    feature_profile,
    outcome_counts,
    score_summary,
    serving_defaults,
    split_summary,
)
from cardwarden.operators.sketches import KEYS, daily_summaries, read_days, relative_errors, store_days, unite_summaries
from cardwarden.schema import ENGINEERED, FEATURE_GROUPS, GROUP_STATS
from cardwarden.plans.prepare import settled_features, split_features
from cardwarden.session import scratch_path

_INTEGERS = {
    "hour_of_day", "day_of_week", "is_weekend", "month", "day_of_month", "customer_txn_count",
    "merchant_txn_count", "category_txn_count", "is_distant_txn", "amt_is_outlier", "city_pop", "unix_time",
}


def rounded_sql(columns) -> str:
    return ", ".join(c if c in _INTEGERS else f"round({c} + 1e-9, 6) AS {c}" for c in columns)


@query(
    "temporal_features",
    f"WITH {FEATURES} SELECT row_id, hour_of_day, day_of_week, is_weekend, month, day_of_month FROM feat",
)
def temporal_features(spark, sf_dir):
    return add_temporal_features(transactions(spark, sf_dir)).select("row_id", *FEATURE_GROUPS["temporal"])


@query(
    "distance_features",
    f"WITH {FEATURES} SELECT row_id, round(distance_km + 1e-9, 6) AS distance_km, is_distant_txn FROM feat",
)
def distance_features(spark, sf_dir):
    return rounded(add_distance_features(transactions(spark, sf_dir)).select("row_id", *FEATURE_GROUPS["distance"]))


@query(
    "amount_features",
    f"WITH {FEATURES} SELECT row_id, {rounded_sql(FEATURE_GROUPS['amount'])} FROM feat",
)
def amount_features(spark, sf_dir):
    txn = join_statistics(transactions(spark, sf_dir), CARD, spread_by=KEY)
    return rounded(add_amount_features(txn).select("row_id", *FEATURE_GROUPS["amount"]))


@query("all_features", f"WITH {FEATURES} SELECT row_id, is_fraud, {rounded_sql(ENGINEERED)} FROM feat")
def all_features(spark, sf_dir):
    """Flagship: the whole feature chain over every transaction."""
    features = add_all_features(transactions(spark, sf_dir), spread_by=KEY)
    return rounded(features.select("row_id", "is_fraud", *ENGINEERED))


@query(
    "feature_matrix",
    f"WITH {FEATURES} SELECT is_fraud, {rounded_sql(FEATURE_GROUPS['raw_numeric'] + ENGINEERED)} FROM feat",
)
def matrix(spark, sf_dir):
    return rounded(feature_matrix(add_all_features(transactions(spark, sf_dir), spread_by=KEY)))


@query(
    "customer_stats",
    f"""WITH {TXN} SELECT cc_num, count(*) AS customer_txn_count, round(avg(amt) + 1e-9, 6) AS customer_avg_amt,
  round(coalesce(stddev_samp(amt), 0) + 1e-9, 6) AS customer_std_amt, round(sum(amt) + 1e-9, 6) AS customer_total_amt,
  CAST(sum(is_fraud) AS BIGINT) AS customer_fraud_count, round(avg(is_fraud) + 1e-9, 6) AS customer_fraud_rate FROM txn GROUP BY 1""",
)
def customer_stats(spark, sf_dir):
    return rounded(customer_statistics(transactions(spark, sf_dir)))


@query(
    "merchant_stats",
    f"""WITH {TXN} SELECT merchant, count(*) AS merchant_txn_count, round(avg(amt) + 1e-9, 6) AS merchant_avg_amt,
  round(coalesce(stddev_samp(amt), 0) + 1e-9, 6) AS merchant_std_amt, CAST(sum(is_fraud) AS BIGINT) AS merchant_fraud_count,
  round(avg(is_fraud) + 1e-9, 6) AS merchant_fraud_rate FROM txn GROUP BY 1""",
)
def merchant_stats(spark, sf_dir):
    return rounded(merchant_statistics(transactions(spark, sf_dir)))


@query(
    "category_stats",
    f"""WITH {TXN} SELECT category, count(*) AS category_txn_count, round(avg(amt) + 1e-9, 6) AS category_avg_amt,
  CAST(sum(is_fraud) AS BIGINT) AS category_fraud_count, round(avg(is_fraud) + 1e-9, 6) AS category_fraud_rate FROM txn GROUP BY 1""",
)
def category_stats(spark, sf_dir):
    return rounded(category_statistics(transactions(spark, sf_dir)))


def _join_query(name, group, key):
    columns = [f"{group.prefix}_{m}" for m in group.joined]

    @query(name, f"WITH {FEATURES} SELECT row_id, {key}, {rounded_sql(columns)} FROM feat")
    def run(spark, sf_dir):
        joined = join_statistics(transactions(spark, sf_dir), group, spread_by=KEY)
        return rounded(joined.select("row_id", key, *columns))


_join_query("join_customer_stats", CARD, "cc_num")
_join_query("join_merchant_stats", MERCHANT, "merchant")
_join_query("join_category_stats", CATEGORY, "category")


@query("dataset_summary", f"WITH {TXN} SELECT {SUMMARY_COLUMNS} FROM txn")
def summary(spark, sf_dir):
    return rounded(dataset_summary(transactions(spark, sf_dir)))


@query("dataset_summary_approx")
def summary_approx(spark, sf_dir):
    return rounded(dataset_summary(transactions(spark, sf_dir), approximate=True))


@query(
    "dataset_summary_united",
    f"""WITH {TXN}, s AS (SELECT *, {split_sql()} AS split FROM txn), u AS (
  SELECT split, {SUMMARY_COLUMNS} FROM s GROUP BY split)
SELECT * EXCLUDE (unique_cards, unique_merchants, unique_categories), true AS unique_cards_close,
  true AS unique_merchants_close, true AS unique_categories_close FROM u""",
)
def summary_united(spark, sf_dir):
    """Stored days of each split united; the distinct counts by whether they are within 3 % of the exact ones."""
    txn = hash_split(transactions(spark, sf_dir), KEY)
    path = scratch_path(spark, "days")
    store_days(daily_summaries(txn, ["split"]), path)
    united = unite_summaries(read_days(spark, path), ["split"])
    errors = relative_errors(united, dataset_summary(txn, ["split"]), ["split"])
    close = errors.groupBy("split").pivot("key", list(KEYS.values())).agg(F.first(F.col("error") <= 0.03))
    close = close.select("split", *[F.col(k).alias(f"{k}_close") for k in KEYS.values()])
    return rounded(united.drop(*KEYS.values()).join(close, "split"))


@query("stratified_split_hash", f"WITH {TXN} SELECT row_id, is_fraud, {split_sql()} AS split FROM txn")
def split_hash(spark, sf_dir):
    return hash_split(transactions(spark, sf_dir), KEY).select("row_id", "is_fraud", "split")


#: Exact quotas: class shares by largest remainder, then rank by digest.
QUOTA = f"""{TXN}, c AS (SELECT is_fraud AS y, count(*) AS n FROM txn GROUP BY 1), t AS (
  SELECT CAST(sum(n) AS BIGINT) AS n, CAST(ceil(CAST(sum(n) AS DOUBLE) * 0.2e0) AS BIGINT) AS n_test FROM c), t2 AS (
  SELECT n, n_test, CAST(ceil((n - n_test) * (0.1e0 / (1 - 0.2e0))) AS BIGINT) AS n_val FROM t), k0 AS (
  SELECT y, c.n, CAST(c.n AS DOUBLE) * (t2.n - n_test) / t2.n AS x, t2.n - n_test AS wanted FROM c, t2), k1 AS (
  SELECT *, row_number() OVER (ORDER BY x - floor(x) DESC, n DESC, y) AS rn,
         wanted - CAST(sum(floor(x)) OVER () AS BIGINT) AS spare FROM k0), kept AS (
  SELECT y, n, CAST(floor(x) AS BIGINT) + CAST(rn <= spare AS INT) AS k FROM k1), r0 AS (
  SELECT y, kept.n, k, CAST(k AS DOUBLE) * (t2.n - n_test - n_val) / (t2.n - n_test) AS x, t2.n - n_test - n_val AS wanted FROM kept, t2), r1 AS (
  SELECT *, row_number() OVER (ORDER BY x - floor(x) DESC, k DESC, y) AS rn,
         wanted - CAST(sum(floor(x)) OVER () AS BIGINT) AS spare FROM r0), quota AS (
  SELECT y, n - k AS q_test, k - (CAST(floor(x) AS BIGINT) + CAST(rn <= spare AS INT)) AS q_val FROM r1), ordered AS (
  SELECT *, row_number() OVER (PARTITION BY is_fraud ORDER BY md5('42:' || CAST(row_id AS VARCHAR))) AS pos FROM txn), exact AS (
  SELECT o.*, CASE WHEN pos <= q_test THEN 'test' WHEN pos <= q_test + q_val THEN 'val' ELSE 'train' END AS split
  FROM ordered o JOIN quota ON o.is_fraud = quota.y)"""


@query("stratified_split_exact", f"WITH {QUOTA} SELECT row_id, is_fraud, split FROM exact")
def split_exact(spark, sf_dir):
    txn = transactions(spark, sf_dir)
    return with_split(txn, fit_split(txn, KEY)).select("row_id", "is_fraud", "split")


@query(
    "stratified_sample",
    f"""WITH {TXN}, o AS (SELECT row_id, is_fraud, row_number() OVER (PARTITION BY is_fraud ORDER BY md5('42:' || CAST(row_id AS VARCHAR))) AS pos,
  count(*) OVER (PARTITION BY is_fraud) AS n FROM txn) SELECT row_id, is_fraud FROM o WHERE pos <= round_even(n * 0.5e0, 0)""",
)
def sample(spark, sf_dir):
    return stratified_sample(transactions(spark, sf_dir), KEY, 0.5).select("row_id", "is_fraud")


@query(
    "stratified_folds",
    f"""WITH {TXN}, c AS (SELECT is_fraud AS y, count(*) AS n, CAST(coalesce(sum(count(*)) OVER (ORDER BY is_fraud ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS a
  FROM txn GROUP BY 1), f AS (
  SELECT y, i AS fold, CAST(floor((a + n - 1 - i) / 5e0) - floor((a - 1 - i) / 5e0) AS BIGINT) AS size FROM c, range(5) r(i)), fc AS (
  SELECT y, fold, sum(size) OVER (PARTITION BY y ORDER BY fold) AS upto, sum(size) OVER (PARTITION BY y ORDER BY fold) - size AS before FROM f), o AS (
  SELECT row_id, is_fraud, row_number() OVER (PARTITION BY is_fraud ORDER BY md5('42:' || CAST(row_id AS VARCHAR))) AS pos FROM txn)
SELECT row_id, is_fraud, CAST(fold AS INT) AS fold FROM o JOIN fc ON o.is_fraud = fc.y AND pos > before AND pos <= upto""",
)
def folds(spark, sf_dir):
    return with_folds(transactions(spark, sf_dir), KEY, 5).select("row_id", "is_fraud", "fold")


@query(
    "split_summary",
    f"""WITH {QUOTA} SELECT split, count(*) AS rows, CAST(sum(is_fraud) AS BIGINT) AS fraud_rows,
  round(avg(is_fraud) + 1e-9, 6) AS fraud_rate FROM exact GROUP BY 1""",
)
def summary_by_split(spark, sf_dir):
    txn = transactions(spark, sf_dir)
    return rounded(split_summary(with_split(txn, fit_split(txn, KEY))))


@query(
    "class_distribution",
    f"""WITH {QUOTA} SELECT split, is_fraud, count(*) AS rows,
  round(count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY split) + 1e-9, 6) AS percent FROM exact GROUP BY 1, 2""",
)
def distribution(spark, sf_dir):
    txn = transactions(spark, sf_dir)
    return rounded(class_distribution(with_split(txn, fit_split(txn, KEY))))


@query(
    "prepared_dataset",
    f"""WITH {FEATURES}, {QUOTA.split("FROM events), ", 1)[1]}
SELECT feat.row_id, exact.split, feat.is_fraud, {", ".join(c if c in _INTEGERS else f"round(feat.{c} + 1e-9, 6) AS {c}" for c in ENGINEERED)}
FROM feat JOIN exact ON feat.row_id = exact.row_id""",
)
def prepared(spark, sf_dir):
    """Features plus the exact split, the job's main output."""
    out = split_features(transactions(spark, sf_dir), KEY)
    return rounded(out.select("row_id", "split", "is_fraud", *ENGINEERED))


@query(
    "serving_defaults",
    f"WITH {FEATURES} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(quantile_cont(CAST({c} AS DOUBLE), 0.5) + 1e-9, 6) AS value FROM feat WHERE split = 'train'"
        for c in GROUP_STATS
    ),
)
def defaults(spark, sf_dir):
    features = settled_features(transactions(spark, sf_dir), KEY)
    return rounded(serving_defaults(features.where("split = 'train'")))


@query(
    "feature_profile",
    f"WITH {FEATURES} "
    + " UNION ALL ".join(
        f"SELECT '{g}' AS feature_group, '{c}' AS feature, round(CAST(min({c}) AS DOUBLE) + 1e-9, 6) AS min_value, "
        f"round(avg({c}) + 1e-9, 6) AS mean_value, round(CAST(max({c}) AS DOUBLE) + 1e-9, 6) AS max_value FROM feat"
        for g, cs in FEATURE_GROUPS.items()
        for c in cs
    ),
)
def profile(spark, sf_dir):
    return rounded(feature_profile(add_all_features(transactions(spark, sf_dir), spread_by=KEY)))


@query(
    "class_weights",
    f"""WITH {TXN}, n AS (SELECT count(*) FILTER (is_fraud = 0) AS negatives, count(*) FILTER (is_fraud = 1) AS positives FROM txn)
SELECT negatives, positives, round(negatives / CAST(greatest(positives, 1) AS DOUBLE) + 1e-9, 6) AS scale_pos_weight,
  round((negatives + positives) / (2.0 * negatives) + 1e-9, 6) AS weight_0, round((negatives + positives) / (2.0 * positives) + 1e-9, 6) AS weight_1 FROM n""",
)
def weights(spark, sf_dir):
    return rounded(class_weights(transactions(spark, sf_dir)))


_SERVED = ", ".join(
    f"(SELECT quantile_cont(CAST({c} AS DOUBLE), 0.5) FROM feat WHERE split = 'train') AS {c}" for c in GROUP_STATS
)
_REQUEST_TIME = "to_timestamp(unix_time) AT TIME ZONE 'UTC'"


@query(
    "score_features",
    f"""WITH {FEATURES}, d AS (SELECT {_SERVED}), q AS (
  SELECT row_id, distance_km, is_distant_txn, amt, {_REQUEST_TIME} AS rt, d.* FROM feat, d), z AS (
  SELECT *, (amt - customer_avg_amt) / (customer_std_amt + 1) AS amt_zscore FROM q)
SELECT row_id, CAST(hour(rt) AS INT) AS hour_of_day, CAST(isodow(rt) - 1 AS INT) AS day_of_week,
  CAST(isodow(rt) >= 6 AS INT) AS is_weekend, CAST(month(rt) AS INT) AS month, CAST(day(rt) AS INT) AS day_of_month,
  {", ".join(f"round({c} + 1e-9, 6) AS {c}" for c in GROUP_STATS)},
  round(distance_km + 1e-9, 6) AS distance_km, is_distant_txn, round(amt_zscore + 1e-9, 6) AS amt_zscore,
  CAST(abs(amt_zscore) > 3 AS INT) AS amt_is_outlier,
  round(CASE WHEN amt / (customer_avg_amt + 1) > 100 THEN 100 ELSE amt / (customer_avg_amt + 1) END + 1e-9, 6) AS amt_ratio_to_customer_avg
FROM z""",
)
def score_features(spark, sf_dir):
    """Request rows (no time string, no label) with training medians as group features."""
    raw = transactions(spark, sf_dir)
    train = settled_features(raw, KEY).where("split = 'train'")
    medians = collect_defaults(serving_defaults(train))
    requests = raw.drop("trans_date_trans_time", "is_fraud")
    return rounded(request_features(requests, medians).select("row_id", *ENGINEERED))


@query(
    "score_decision",
    f"""WITH {SCORED} SELECT row_id, model, round(s, 6) AS fraud_probability, s >= 0.5e0 AS is_fraud, 0.5e0 AS threshold FROM scored""",
)
def score_decision(spark, sf_dir):
    return decide(scored(spark, sf_dir), "score").select(
        "row_id", "model", "fraud_probability", "is_fraud", "threshold"
    )


@query(
    "score_summary",
    f"""WITH {SCORED} SELECT count(*) AS scored, count(*) FILTER (s >= 0.5e0) AS flagged,
  round(count(*) FILTER (s >= 0.5e0) / CAST(greatest(count(*), 1) AS DOUBLE) + 1e-9, 6) AS flagged_rate FROM scored""",
)
def batch_summary(spark, sf_dir):
    return rounded(score_summary(decide(scored(spark, sf_dir), "score")))


@query(
    "outcome_counts",
    f"""WITH {SCORED} SELECT model, CASE WHEN s >= 0.5e0 THEN 'fraud' ELSE 'legit' END AS outcome, count(*) AS predictions
FROM scored GROUP BY 1, 2""",
)
def outcomes(spark, sf_dir):
    return outcome_counts(decide(scored(spark, sf_dir), "score"), ["model"])


_BOUNDS = [1.0, 2.5, 5.0, 10.0, 25.0, 50.0, 75.0, 100.0, 150.0, 200.0, 300.0]


def histogram_sql(source: str, by: str, value: str, q: str = "0.95e0") -> str:
    """CTE ``hq (by, p, observations)``: interpolation inside the cumulative bucket that holds the rank."""
    ends = ", ".join(f"({i}, {b}e0, {low}e0)" for i, (b, low) in enumerate(zip(_BOUNDS, [0.0, *_BOUNDS[:-1]])))
    return f"""ends(i, le, low) AS (VALUES {ends}), cum AS (
  SELECT {by}, i, le, low, count(*) FILTER ({value} <= le) AS upto, count(*) FILTER ({value} <= le AND ({value} > low OR i = 0)) AS own,
         count(*) AS observations FROM {source}, ends GROUP BY ALL), hq AS (
  SELECT {by}, CASE WHEN max(upto) < {q} * max(observations) THEN {_BOUNDS[-1]}e0
    ELSE min_by(low + (le - low) * ({q} * observations - (upto - own)) / own, i) FILTER (upto >= {q} * observations AND own > 0) END AS p,
    max(observations) AS observations FROM cum GROUP BY {by})"""


@query(
    "latency_p95_histogram",
    f"WITH {TXN}, {histogram_sql('txn', 'category', 'amt')} SELECT category, round(p + 1e-9, 6) AS p95, observations FROM hq",
)
def p95_histogram(spark, sf_dir):
    """95th percentile per category from bucket counts, counted per day and added up."""
    days = histogram(transactions(spark, sf_dir).withColumn("day", F.substring("trans_date_trans_time", 1, 10)), "amt", _BOUNDS, ["category", "day"])
    return rounded(histogram_quantile(days, _BOUNDS, 0.95, ["category"], "p95"))


@query("latency_p95", f"WITH {TXN} SELECT round(quantile_cont(amt, 0.95) + 1e-9, 6) AS p95 FROM txn")
def p95(spark, sf_dir):
    return rounded(exact_p95(transactions(spark, sf_dir), "amt"))


def earlier_sql(key: str) -> str:
    return f"""WITH {TXN} SELECT row_id, {key},
  count(*) OVER w AS prior_txn_count, round(avg(amt) OVER w + 1e-9, 6) AS prior_avg_amt,
  round(coalesce(stddev_samp(amt) OVER w, 0) + 1e-9, 6) AS prior_std_amt, round(coalesce(avg(is_fraud) OVER w, 0) + 1e-9, 6) AS prior_fraud_rate
FROM txn WINDOW w AS (PARTITION BY {key} ORDER BY unix_time RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""


def _earlier_query(name, key):
    @query(name, earlier_sql(key))
    def run(spark, sf_dir):
        history = earlier_statistics(transactions(spark, sf_dir), key, spread_by=KEY)
        return rounded(
            history.select("row_id", key, "prior_txn_count", "prior_avg_amt", "prior_std_amt", "prior_fraud_rate")
        )


_earlier_query("pit_customer_stats", "cc_num")
_earlier_query("pit_merchant_stats", "merchant")
_earlier_query("pit_category_stats", "category")


def _fitted_sql() -> str:
    parts = {
        "cc_num": ("customer", CARD),
        "merchant": ("merchant", MERCHANT),
        "category": ("category", CATEGORY),
    }
    agg = {
        "txn_count": "count(*)",
        "avg_amt": "avg(amt)",
        "std_amt": "coalesce(stddev_samp(amt), 0)",
        "fraud_rate": "avg(is_fraud)",
    }
    ctes, joins, columns = [f"{TXN}, s AS (SELECT *, {split_sql()} AS split FROM txn)"], [], []
    for key, (prefix, group) in parts.items():
        cols = ", ".join(f"{agg[m]} AS {prefix}_{m}" for m in group.joined)
        ctes.append(f"f_{prefix} AS (SELECT {key}, {cols} FROM s WHERE split = 'train' GROUP BY 1)")
        joins.append(f"LEFT JOIN f_{prefix} USING ({key})")
        columns += [f"{prefix}_{m}" for m in group.joined]
    ctes.append(f"j AS (SELECT s.row_id, s.split, {', '.join(columns)} FROM s {' '.join(joins)})")
    medians = ", ".join(
        f"(SELECT quantile_cont(CAST({c} AS DOUBLE), 0.5) FROM j WHERE split = 'train') AS d_{c}" for c in columns
    )
    out = ", ".join(f"round(coalesce(CAST({c} AS DOUBLE), d_{c}) + 1e-9, 6) AS {c}" for c in columns)
    return f"WITH {', '.join(ctes)}, d AS (SELECT {medians}) SELECT row_id, split, {out} FROM j, d"


@query("fit_apply_stats", _fitted_sql())
def fit_apply(spark, sf_dir):
    """Group statistics learned on train only; unseen keys get the training medians."""
    rows = hash_split(transactions(spark, sf_dir), KEY)
    train = rows.where("split = 'train'")
    fitted = fit_statistics(train)
    zeros = dict.fromkeys(GROUP_STATS, 0.0)
    medians = collect_defaults(serving_defaults(apply_statistics(train, fitted, zeros, spread_by=KEY)))
    out = apply_statistics(rows, fitted, medians, spread_by=KEY)
    return rounded(out.select("row_id", "split", *[F.col(c).cast("double").alias(c) for c in GROUP_STATS]))


_STANDARD = [
    "amt", "lat", "long", "city_pop", "unix_time", "merch_lat", "merch_long", "hour_of_day", "day_of_week", "is_weekend", "month",
    "day_of_month", "customer_txn_count", "customer_avg_amt", "customer_std_amt", "customer_fraud_rate", "merchant_fraud_rate",
    "merchant_txn_count", "merchant_avg_amt", "merchant_std_amt", "category_fraud_rate", "category_txn_count", "category_avg_amt",
    "distance_km", "is_distant_txn", "amt_zscore", "amt_is_outlier", "amt_ratio_to_customer_avg",
]


@query(
    "standardize",
    f"""WITH {FEATURES} SELECT row_id, {", ".join(
        f"round(coalesce(({c} - avg({c}) OVER ()) / nullif(stddev_pop({c}) OVER (), 0), 0) + 1e-9, 6) AS {c}" for c in _STANDARD)} FROM feat""",
)
def standardize(spark, sf_dir):
    from cardwarden.operators.models import standardized

    features = add_all_features(transactions(spark, sf_dir), spread_by=KEY)
    return rounded(standardized(features.select("row_id", *_STANDARD), _STANDARD))


