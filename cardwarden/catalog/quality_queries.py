"""Metrics, model choice, drift, stability and promotion queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwarden.catalog.base import (
    FEATURES,
    KEY,
    ORACLES,
    SCORED,
    SCORERS,
    TXN,
    long_metrics_sql,
    metrics_sql,
    query,
    ranked_sql,
    rounded,
    scored,
    split_sql,
    transactions,
)
from cardwarden.operators.drift import (
    category_counts,
    category_drift,
    drift_summary,
    feature_drift,
    ks_distances,
    shared_numeric,
    split_shift,
    target_drift,
    two_sides,
)
from cardwarden.operators.metrics import (
    bias_variance,
    classification_report,
    confusion_matrix,
    evaluate,
    flatten_nested,
    metrics_long,
    nest_metrics,
    pr_curve,
    ranking_metrics,
    roc_curve,
    threshold_metrics,
)
from cardwarden.operators.promotion import (
    apply_promotions,
    champion_metrics,
    champion_versions,
    promotion_gate,
    promotion_metrics,
    run_metrics,
)
from cardwarden.operators.selection import best_model, top_features
from cardwarden.operators.splitting import hash_split
from cardwarden.operators.stability import category_share_shift, population_stability
from cardwarden.operators.tuning import improvement_flags, parameter_diff, tuning_comparison
from cardwarden.plans.drift_report import drift_job, drift_report
from cardwarden.plans.prepare import settled_features
from cardwarden.plans.promote import promote, promotion_job
from cardwarden.plans.train import positions
from cardwarden.schema import FEATURE_GROUPS, GROUP_STATS
from cardwarden.session import scratch_path, settle
from cardwarden.sources.run_documents import read_part

BY = ["model", "split"]
MS = f"WITH {SCORED}, {metrics_sql('model, split')}"


# --------------------------------------------------------------------------- metrics
@query("auc_roc", f"{MS} SELECT model, split, round(auc_roc + 1e-9, 6) AS auc_roc FROM m")
def auc_roc(spark, sf_dir):
    return rounded(ranking_metrics(scored(spark, sf_dir), BY).select(*BY, "auc_roc"))


@query("average_precision", f"{MS} SELECT model, split, round(auprc + 1e-9, 6) AS auprc FROM m")
def average_precision(spark, sf_dir):
    return rounded(ranking_metrics(scored(spark, sf_dir), BY).select(*BY, "auprc"))


@query("pr_trapezoid", f"{MS} SELECT model, split, round(pr_trapezoid + 1e-9, 6) AS pr_trapezoid FROM m")
def pr_trapezoid(spark, sf_dir):
    return rounded(ranking_metrics(scored(spark, sf_dir), BY).select(*BY, "pr_trapezoid"))


@query(
    "threshold_metrics",
    f"""{MS} SELECT model, split, round(recall + 1e-9, 6) AS recall, round("precision" + 1e-9, 6) AS "precision", round(f1 + 1e-9, 6) AS f1,
  round(accuracy + 1e-9, 6) AS accuracy, round(false_positive_rate + 1e-9, 6) AS false_positive_rate FROM m""",
)
def at_threshold(spark, sf_dir):
    return rounded(threshold_metrics(scored(spark, sf_dir), BY))


@query(
    "threshold_metrics_strict",
    f"""WITH {SCORED}, {metrics_sql('model, split', threshold='0.25e0', op='>')} SELECT model, split, round(recall + 1e-9, 6) AS recall,
  round("precision" + 1e-9, 6) AS "precision", round(f1 + 1e-9, 6) AS f1, round(accuracy + 1e-9, 6) AS accuracy,
  round(false_positive_rate + 1e-9, 6) AS false_positive_rate FROM m""",
)
def above_threshold(spark, sf_dir):
    return rounded(threshold_metrics(scored(spark, sf_dir), BY, threshold=0.25, strict=True))


@query(
    "confusion_matrix",
    f"""WITH {SCORED}, g AS (SELECT DISTINCT model, split FROM scored), cells AS (
  SELECT model, split, a AS actual, p AS predicted FROM g, (VALUES (0), (1)) x(a), (VALUES (0), (1)) z(p)), n AS (
  SELECT model, split, y AS actual, CAST(s >= 0.5e0 AS INT) AS predicted, count(*) AS rows FROM scored GROUP BY 1, 2, 3, 4)
SELECT model, split, CAST(actual AS INT) AS actual, CAST(predicted AS INT) AS predicted, coalesce(rows, 0) AS rows
FROM cells LEFT JOIN n USING (model, split, actual, predicted)""",
)
def matrix(spark, sf_dir):
    return confusion_matrix(scored(spark, sf_dir), BY)


@query(
    "classification_report",
    f"""{MS}, c AS (SELECT model, split, tp, fp, fn, tn, tp + fp + fn + tn AS total FROM counts), k AS (
  SELECT *, CASE WHEN tn + fn > 0 THEN tn / (tn + fn) ELSE 0 END AS p0, CASE WHEN tn + fp > 0 THEN tn / (tn + fp) ELSE 0 END AS r0,
    CASE WHEN 2 * tn + fp + fn > 0 THEN 2 * tn / (2 * tn + fp + fn) ELSE 0 END AS f0,
    CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS p1, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS r1,
    CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END AS f1 FROM c), e AS (
  SELECT model, split, 'Legit (0)' AS entry, p0 AS p, r0 AS r, f0 AS f, tn + fp AS support FROM k UNION ALL
  SELECT model, split, 'Fraud (1)', p1, r1, f1, tp + fn FROM k UNION ALL
  SELECT model, split, 'accuracy', (tp + tn) / total, (tp + tn) / total, (tp + tn) / total, total FROM k UNION ALL
  SELECT model, split, 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, total FROM k UNION ALL
  SELECT model, split, 'weighted avg', (p0 * (tn + fp) + p1 * (tp + fn)) / total, (r0 * (tn + fp) + r1 * (tp + fn)) / total,
    (f0 * (tn + fp) + f1 * (tp + fn)) / total, total FROM k)
SELECT model, split, entry, round(p + 1e-9, 4) AS "precision", round(r + 1e-9, 4) AS recall, round(f + 1e-9, 4) AS f1, CAST(support AS BIGINT) AS support FROM e""",
)
def report(spark, sf_dir):
    return rounded(classification_report(scored(spark, sf_dir), BY), 4)


@query(
    "pr_curve",
    f"""WITH {SCORED}, {ranked_sql('model, split')} SELECT model, split, round(s + 1e-9, 6) AS threshold, round(tp / cnt + 1e-9, 6) AS "precision",
  round(CASE WHEN p_all > 0 THEN tp / p_all ELSE 0 END + 1e-9, 6) AS recall FROM ranked
UNION ALL SELECT DISTINCT model, split, CAST(NULL AS DOUBLE), 1e0, 0e0 FROM ranked""",
)
def precision_recall(spark, sf_dir):
    return rounded(pr_curve(scored(spark, sf_dir), BY))


@query(
    "roc_curve",
    f"""WITH {SCORED}, {ranked_sql('model, split')} SELECT model, split, round(s + 1e-9, 6) AS threshold,
  round(CASE WHEN n_all - p_all > 0 THEN (cnt - tp) / (n_all - p_all) ELSE 0 END + 1e-9, 6) AS fpr,
  round(CASE WHEN p_all > 0 THEN tp / p_all ELSE 0 END + 1e-9, 6) AS tpr FROM ranked
UNION ALL SELECT DISTINCT model, split, CAST(NULL AS DOUBLE), 0e0, 0e0 FROM ranked""",
)
def receiver_curve(spark, sf_dir):
    return rounded(roc_curve(scored(spark, sf_dir), BY))


@query(
    "roc_corners",
    f"""WITH {SCORED}, {ranked_sql('model, split')}, steps AS (
  SELECT *, lead(pos) OVER w AS pos2, lead(n) OVER w AS n2 FROM ranked WINDOW w AS (PARTITION BY model, split ORDER BY s DESC))
SELECT model, split, round(s + 1e-9, 6) AS threshold,
  round(CASE WHEN n_all - p_all > 0 THEN (cnt - tp) / (n_all - p_all) ELSE 0 END + 1e-9, 6) AS fpr,
  round(CASE WHEN p_all > 0 THEN tp / p_all ELSE 0 END + 1e-9, 6) AS tpr
FROM steps WHERE n2 IS NULL OR pos * (n2 - pos2) <> (n - pos) * pos2
UNION ALL SELECT DISTINCT model, split, CAST(NULL AS DOUBLE), 0e0, 0e0 FROM ranked""",
)
def receiver_corners(spark, sf_dir):
    """Only the points where the curve turns."""
    return rounded(roc_curve(scored(spark, sf_dir), BY, corners=True))


def measured(spark, sf_dir) -> DataFrame:
    """Long metrics of both scorers on all splits."""
    return metrics_long(evaluate(scored(spark, sf_dir), BY), BY)


@query(
    "split_metrics",
    f"""{MS} SELECT model, split, round(auc_roc + 1e-9, 6) AS auc_roc, round(auprc + 1e-9, 6) AS auprc, round(recall + 1e-9, 6) AS recall,
  round("precision" + 1e-9, 6) AS "precision", round(f1 + 1e-9, 6) AS f1 FROM m""",
)
def split_metrics(spark, sf_dir):
    return rounded(evaluate(scored(spark, sf_dir), BY))


@query(
    "metrics_long",
    f"{MS}, {long_metrics_sql('model, split')} SELECT model, split, metric, round(value + 1e-9, 6) AS value FROM ml",
)
def long_metrics(spark, sf_dir):
    """Metrics nested into a report and flattened again."""
    return rounded(flatten_nested(nest_metrics(measured(spark, sf_dir))))


@query(
    "bias_variance",
    f"""{MS}, p AS (SELECT model, max(auprc) FILTER (split = 'train') AS a, max(auprc) FILTER (split = 'val') AS b,
  max(auprc) FILTER (split = 'test') AS c FROM m GROUP BY 1)
SELECT model, round(a + 1e-9, 6) AS train_auprc, round(b + 1e-9, 6) AS val_auprc, round(c + 1e-9, 6) AS test_auprc,
  round(abs(a - b) + 1e-9, 6) AS train_val_gap_auprc, round(abs(a - c) + 1e-9, 6) AS train_test_gap_auprc, round(abs(b - c) + 1e-9, 6) AS val_test_gap_auprc,
  CASE WHEN a < 0.5e0 THEN 'HIGH BIAS (Underfitting)' WHEN abs(a - b) > 0.15e0 THEN 'HIGH VARIANCE (Overfitting)'
       WHEN abs(a - b) > 0.05e0 THEN 'MODERATE VARIANCE' ELSE 'GOOD FIT' END AS diagnosis FROM p""",
)
def gaps(spark, sf_dir):
    return rounded(bias_variance(measured(spark, sf_dir)))


@query(
    "best_model",
    f"""{MS}, o AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY auprc DESC, model) AS rn FROM m)
SELECT split, model AS best_model, round(auprc + 1e-9, 6) AS best_auprc FROM o WHERE rn = 1""",
)
def best(spark, sf_dir):
    ranked = ranking_metrics(scored(spark, sf_dir), BY).withColumn("position", positions(SCORERS))
    return rounded(best_model(ranked, ["split"]))


# --------------------------------------------------------------------------- drift
NUMERIC = [
    "row_id",
    *["amt", "lat", "long", "city_pop", "unix_time", "merch_lat", "merch_long", "is_fraud"],
    *[c for g, cs in FEATURE_GROUPS.items() if g != "raw_numeric" for c in cs],
]
KS_SERIES = (
    "list_sum(list_transform(range(1, 101), lambda k: CASE WHEN k % 2 = 1 THEN 1e0 ELSE -1e0 END * exp(-2e0 * k * k * @LAM * @LAM)))"
)


def _p_sql(d: str, n: str, m: str) -> str:
    en = f"(CAST({n} AS DOUBLE) * {m} / ({n} + {m}))"
    lam = f"((sqrt({en}) + 0.12e0 + 0.11e0 / sqrt({en})) * {d})"
    series = KS_SERIES.replace("@LAM", lam)
    return f"CASE WHEN {lam} < 0.3e0 THEN 1e0 ELSE least(greatest(2 * {series}, 0e0), 1e0) END"


def _long_features(columns, source="feat", extra="split AS side") -> str:
    return " UNION ALL ".join(f"SELECT {extra}, '{c}' AS feature, CAST({c} AS DOUBLE) AS v FROM {source}" for c in columns)


def ks_sql(columns, source: str = "feat") -> str:
    """CTE ``d``: distances train-val and train-test with the sample sizes."""
    return f"""lf AS ({_long_features(columns, source)}), g AS (
  SELECT feature, v, CAST(count(*) FILTER (side = 'train') AS DOUBLE) AS a, CAST(count(*) FILTER (side = 'val') AS DOUBLE) AS b,
         CAST(count(*) FILTER (side = 'test') AS DOUBLE) AS c FROM lf WHERE v IS NOT NULL GROUP BY 1, 2), f AS (
  SELECT feature, sum(a) OVER w / sum(a) OVER t AS fa, sum(b) OVER w / sum(b) OVER t AS fb, sum(c) OVER w / sum(c) OVER t AS fc,
         sum(a) OVER t AS na, sum(b) OVER t AS nb, sum(c) OVER t AS nc
  FROM g WINDOW w AS (PARTITION BY feature ORDER BY v ROWS UNBOUNDED PRECEDING), t AS (PARTITION BY feature)), d AS (
  SELECT feature, max(abs(fa - fb)) AS d_val, max(abs(fa - fc)) AS d_test, max(na) AS na, max(nb) AS nb, max(nc) AS nc
  FROM f GROUP BY 1)"""


def train_and_test(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    features = settled_features(transactions(spark, sf_dir), KEY)
    return features.where("split = 'train'"), features.where("split = 'test'")


def both_sides(spark, sf_dir, columns: list[str]) -> DataFrame:
    """Training rows as reference, test rows as current, from the stored feature table."""
    side = F.when(F.col("split") == "train", F.lit("ref")).when(F.col("split") == "test", F.lit("cur"))
    features = settled_features(transactions(spark, sf_dir), KEY)
    return features.withColumn("side", side).where(F.col("side").isNotNull()).select("side", *columns)


_RAW_KS = ["amt", "lat", "long", "city_pop", "unix_time", "merch_lat", "merch_long", "is_fraud"]


@query(
    "ks_statistic",
    f"""WITH {TXN}, sp AS (SELECT *, {split_sql()} AS split FROM txn), {ks_sql(_RAW_KS, 'sp')}
SELECT feature, CAST(na AS BIGINT) AS n_ref, CAST(nc AS BIGINT) AS n_cur, round(d_test + 1e-9, 6) AS ks_ref_cur FROM d""",
)
def ks(spark, sf_dir):
    """Two-sample distances of raw columns."""
    rows = hash_split(transactions(spark, sf_dir), KEY)
    sides = two_sides(rows.where("split = 'train'"), rows.where("split = 'test'"), _RAW_KS)
    return rounded(ks_distances(sides, _RAW_KS, ["ref", "cur"], [("ref", "cur")]))


_DRIFT = f"WITH {FEATURES}, {ks_sql(NUMERIC)}, p AS (SELECT *, {_p_sql('d_test', 'na', 'nc')} AS pv FROM d)"


@query(
    "feature_drift",
    f"""{_DRIFT} SELECT feature, 'Kolmogorov-Smirnov' AS test, round(d_test + 1e-9, 6) AS statistic, round(pv + 1e-9, 6) AS p_value,
  pv < 0.05e0 AS drifted, 0.05e0 AS threshold FROM p""",
)
def drift(spark, sf_dir):
    """All numeric columns, label and row number included, large-sample p-values."""
    return rounded(feature_drift(both_sides(spark, sf_dir, NUMERIC), NUMERIC, p_method="asymptotic"))


@query("feature_drift_exact")
def drift_exact(spark, sf_dir):
    """The same with the exact small-sample p-value (no closed form in SQL)."""
    columns = NUMERIC
    return rounded(feature_drift(both_sides(spark, sf_dir, columns), columns, p_method="exact"))


@query(
    "drift_summary",
    f"""{_DRIFT} SELECT count(*) AS total_features_checked, count(*) FILTER (pv < 0.05e0) AS features_with_drift,
  array_to_string(list_sort(coalesce(list(feature) FILTER (pv < 0.05e0), [])), ',') AS drifted_feature_names,
  coalesce(bool_or(pv < 0.05e0), false) AS overall_drift_detected FROM p""",
)
def summary(spark, sf_dir):
    results = feature_drift(both_sides(spark, sf_dir, NUMERIC), NUMERIC, p_method="asymptotic")
    return drift_summary(results).withColumn(
        "drifted_feature_names", F.array_join("drifted_feature_names", ",")
    )


@query(
    "split_shift",
    f"""WITH {FEATURES}, {ks_sql([c for c in NUMERIC if c not in ("row_id", "is_fraud")])} SELECT feature, round(d_val + 1e-9, 6) AS ks_train_val,
  round({_p_sql('d_val', 'na', 'nb')} + 1e-9, 6) AS p_train_val, round(d_test + 1e-9, 6) AS ks_train_test,
  round({_p_sql('d_test', 'na', 'nc')} + 1e-9, 6) AS p_train_test FROM d""",
)
def shift(spark, sf_dir):
    columns = [c for c in NUMERIC if c not in ("row_id", "is_fraud")]
    rows = settled_features(transactions(spark, sf_dir), KEY)
    return rounded(split_shift(rows, columns, p_method="asymptotic"))


@query(
    "top_shifted_features",
    f"""WITH {FEATURES}, {ks_sql([c for c in NUMERIC if c not in ("row_id", "is_fraud")])}
SELECT feature, round(d_test + 1e-9, 6) AS ks_train_test FROM d ORDER BY d_test DESC, feature LIMIT 5""",
)
def top_shift(spark, sf_dir):
    columns = [c for c in NUMERIC if c not in ("row_id", "is_fraud")]
    rows = settled_features(transactions(spark, sf_dir), KEY)
    shifted = split_shift(rows, columns, p_method="asymptotic").select("feature", "ks_train_test")
    return rounded(top_features(shifted, 5, "ks_train_test"))


_SIDED = f"WITH {TXN}, sp AS (SELECT *, {split_sql()} AS split FROM txn)"


@query(
    "category_align",
    f"""{_SIDED} SELECT category AS category_value, count(*) FILTER (split = 'train') AS n_ref,
  count(*) FILTER (split = 'test') AS n_cur FROM sp WHERE split IN ('train', 'test') GROUP BY 1""",
)
def align(spark, sf_dir):
    rows = hash_split(transactions(spark, sf_dir), KEY)
    sides = two_sides(rows.where("split = 'train'"), rows.where("split = 'test'"), ["category"])
    return category_counts(sides, "category")


@query(
    "chi2_statistic",
    f"""{_SIDED}, c AS (SELECT category, CAST(count(*) FILTER (split = 'train') AS DOUBLE) AS r, CAST(count(*) FILTER (split = 'test') AS DOUBLE) AS o
  FROM sp WHERE split IN ('train', 'test') GROUP BY 1), t AS (SELECT sum(r) AS rs, sum(o) AS os FROM c), x AS (
  SELECT sum(pow(o - r * os / rs, 2) / (r * os / rs)) AS x, count(*) AS k FROM c, t)
SELECT 'category' AS feature, 'Chi-Square' AS test, round(x + 1e-9, 6) AS statistic, k AS categories, CAST(0 AS BIGINT) AS new_categories,
  round(exp(-x / 2) * (1 + x / 2) + 1e-9, 6) AS p_value, exp(-x / 2) * (1 + x / 2) < 0.05e0 AS drifted, 0.05e0 AS threshold FROM x""",
)
def chi2(spark, sf_dir):
    """Five categories, so the tail has the closed form the oracle uses."""
    rows = hash_split(transactions(spark, sf_dir), KEY)
    sides = two_sides(rows.where("split = 'train'"), rows.where("split = 'test'"), ["category"])
    return rounded(category_drift(sides, ["category"]))


@query(
    "target_drift",
    f"""{_SIDED}, a AS (SELECT avg(is_fraud) FILTER (split = 'train') AS p0, CAST(sum(is_fraud) FILTER (split = 'test') AS BIGINT) AS k,
  count(*) FILTER (split = 'test') AS n FROM sp), pm AS (
  SELECT i, exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(p0) + (n - i) * ln(1 - p0)) AS w
  FROM a, range(0, (SELECT n + 1 FROM a)) r(i)), pv AS (
  SELECT least(1e0, sum(w) FILTER (w <= (SELECT w FROM pm, a WHERE i = k) * (1 + 1e-7))) AS p FROM pm)
SELECT round(p0 + 1e-9, 6) AS reference_fraud_rate, round(k / CAST(n AS DOUBLE) + 1e-9, 6) AS current_fraud_rate,
  round(k / CAST(n AS DOUBLE) - p0 + 1e-9, 6) AS fraud_rate_change, round(p + 1e-9, 6) AS p_value, p < 0.05e0 AS drifted, 0.05e0 AS threshold FROM a, pv""",
)
def target(spark, sf_dir):
    rows = hash_split(transactions(spark, sf_dir), KEY)
    sides = two_sides(rows.where("split = 'train'"), rows.where("split = 'test'"), ["is_fraud"])
    return rounded(target_drift(sides))


_TARGET_P = f"""a AS (SELECT avg(is_fraud) FILTER (split = 'train') AS p0, CAST(sum(is_fraud) FILTER (split = 'test') AS BIGINT) AS k,
  count(*) FILTER (split = 'test') AS n FROM feat), pm AS (
  SELECT i, exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(p0) + (n - i) * ln(1 - p0)) AS w
  FROM a, range(0, (SELECT n + 1 FROM a)) r(i)), tp AS (
  SELECT least(1e0, sum(w) FILTER (w <= (SELECT w FROM pm, a WHERE i = k) * (1 + 1e-7))) AS p FROM pm)"""


@query(
    "drift_report",
    f"""{_DRIFT}, {_TARGET_P} SELECT 'feature' AS section, feature AS subject, round(pv + 1e-9, 6) AS p_value, pv < 0.05e0 AS drifted FROM p
UNION ALL SELECT 'target', 'is_fraud', round(p + 1e-9, 6), p < 0.05e0 FROM tp
UNION ALL SELECT 'summary', 'all', NULL, bool_or(pv < 0.05e0) FROM p""",
)
def full_report(spark, sf_dir):
    """The report's sections with the figures read back from their JSON."""
    train, test = train_and_test(spark, sf_dir)
    columns = shared_numeric(train, test)
    return report_figures(drift_report(train.select(*columns), test.select(*columns), p_method="asymptotic"))


def report_figures(report: DataFrame) -> DataFrame:
    def field(name: str, kind: str):
        return F.get_json_object("result", f"$.{name}").cast(kind)

    return rounded(
        report.select(
            "section",
            "subject",
            field("p_value", "double").alias("p_value"),
            F.coalesce(field("drifted", "boolean"), field("overall_drift_detected", "boolean")).alias("drifted"),
        )
    )


_PSI = [c for c in NUMERIC if c not in ("row_id", "is_fraud")]


def _psi_sql() -> str:
    # Shares per bin; bins are [edge, next edge), equal edges merged.
    return f"""WITH {FEATURES}, lf AS ({_long_features(_PSI)}), ed AS (
  SELECT feature, list_sort(list_distinct(quantile_cont(v, [0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9]))) AS e
  FROM lf WHERE side = 'train' GROUP BY 1), b AS (
  SELECT feature, side, len(list_filter(e, lambda x: x <= v)) AS bin FROM lf JOIN ed USING (feature) WHERE side <> 'val'), c AS (
  SELECT feature, bin, CAST(count(*) FILTER (side = 'train') AS DOUBLE) AS r, CAST(count(*) FILTER (side = 'test') AS DOUBLE) AS o FROM b GROUP BY 1, 2), s AS (
  SELECT feature, greatest(r / sum(r) OVER w, 1e-4) AS rs, greatest(o / sum(o) OVER w, 1e-4) AS os FROM c WINDOW w AS (PARTITION BY feature)), q AS (
  SELECT feature, sum((os - rs) * ln(os / rs)) AS psi FROM s GROUP BY 1)
SELECT feature, round(psi + 1e-9, 6) AS psi, CASE WHEN psi >= 0.2e0 THEN 'alert' WHEN psi >= 0.1e0 THEN 'warn' ELSE 'ok' END AS status FROM q"""


@query("psi", _psi_sql())
def psi(spark, sf_dir):
    return rounded(population_stability(both_sides(spark, sf_dir, _PSI), _PSI))


@query(
    "category_diff",
    f"""{_SIDED}, c AS (SELECT category AS category_value, CAST(count(*) FILTER (split = 'train') AS DOUBLE) AS r, CAST(count(*) FILTER (split = 'test') AS DOUBLE) AS o
  FROM sp WHERE split IN ('train', 'test') GROUP BY 1), s AS (SELECT category_value, r / sum(r) OVER () AS rs, o / sum(o) OVER () AS os FROM c)
SELECT category_value, round(rs + 1e-9, 6) AS ref_share, round(os + 1e-9, 6) AS cur_share, round(abs(os - rs) + 1e-9, 6) AS share_diff,
  CASE WHEN abs(os - rs) >= 0.2e0 THEN 'alert' WHEN abs(os - rs) >= 0.1e0 THEN 'warn' ELSE 'ok' END AS status FROM s""",
)
def category_diff(spark, sf_dir):
    rows = hash_split(transactions(spark, sf_dir), KEY)
    sides = two_sides(rows.where("split = 'train'"), rows.where("split = 'test'"), ["category"])
    return rounded(category_share_shift(sides, "category"))


# --------------------------------------------------------------------------- runs and registry
RUN_SQL = (
    SCORED
    + """, runs AS (SELECT *, category || '-w' || CAST((day - 1) // 7 + 1 AS VARCHAR) AS run_id FROM scored), """
    + metrics_sql("run_id, model, position, split", "runs")
    + ", "
    + long_metrics_sql("run_id, model, position, split")
)
RUN_METRICS_SQL = (
    RUN_SQL
    + """, named AS (SELECT run_id, replace(lower(model), ' ', '_') || '_' || split || '_' || metric AS name, value FROM ml), bv AS (
  SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY auprc DESC, position) AS rn FROM m WHERE split = 'val'), rm AS (
  SELECT run_id, name, value FROM named UNION ALL
  SELECT run_id, 'best_val_auprc', auprc FROM bv WHERE rn = 1 UNION ALL SELECT run_id, 'val_recall', recall FROM bv WHERE rn = 1 UNION ALL
  SELECT run_id, 'val_precision', "precision" FROM bv WHERE rn = 1 UNION ALL SELECT run_id, 'val_auprc', auprc FROM bv WHERE rn = 1)"""
)
REGISTRY_SQL = """registry AS (
  SELECT DISTINCT 'detector-' || category AS model_name, CAST((day - 1) // 7 + 1 AS BIGINT) AS version,
    CASE WHEN category = 'signup' OR (day - 1) // 7 > 2 THEN 'None' WHEN (day - 1) // 7 = 2 THEN 'Production' ELSE 'Archived' END AS stage,
    CASE WHEN category = 'click' AND (day - 1) // 7 = 1 THEN 'champion' END AS alias,
    category || '-w' || CAST((day - 1) // 7 + 1 AS VARCHAR) AS run_id
  FROM scored)"""
CHALLENGER_SQL = "challengers AS (SELECT model_name, run_id FROM registry WHERE version = 4)"
CHAMPION_SQL = """champions AS (SELECT model_name, version, run_id FROM (
  SELECT *, row_number() OVER (PARTITION BY model_name ORDER BY coalesce(alias = 'champion', false) DESC, version DESC) AS rn
  FROM registry WHERE alias = 'champion' OR stage = 'Production') WHERE rn = 1 AND run_id IS NOT NULL)"""
GATE_SQL = (
    RUN_METRICS_SQL
    + f""", {REGISTRY_SQL}, {CHALLENGER_SQL}, {CHAMPION_SQL}, vm AS (
  SELECT run_id, max(value) FILTER (name = 'val_recall') AS r, max(value) FILTER (name = 'val_precision') AS p FROM rm GROUP BY 1), gate AS (
  SELECT h.model_name, h.run_id, c.model_name IS NOT NULL AS has, coalesce(a.r, 0) AS cr, coalesce(a.p, 0) AS cp,
         coalesce(b.r, 0) AS pr, coalesce(b.p, 0) * 0.95e0 AS rp
  FROM challengers h LEFT JOIN vm a ON h.run_id = a.run_id LEFT JOIN champions c ON h.model_name = c.model_name LEFT JOIN vm b ON c.run_id = b.run_id), gated AS (
  SELECT *, NOT has OR (cr >= pr AND cp >= rp) AS promoted,
    CASE WHEN NOT has THEN 'No champion model, promoting as first production model'
         WHEN cr < pr THEN printf('Challenger Recall (%.4f) < Champion (%.4f)', cr, pr)
         WHEN cp < rp THEN printf('Challenger Precision (%.4f) < Min required (%.4f)', cp, rp)
         ELSE printf('Recall: %.4f >= %.4f | Precision: %.4f >= %.4f', cr, pr, cp, rp) END AS reason FROM gate)"""
)


def runs(spark, sf_dir) -> DataFrame:
    """Scored rows with a run per category and week."""
    week = F.floor((F.col("day") - 1) / 7) + 1
    return scored(spark, sf_dir).withColumn("run_id", F.concat("category", F.lit("-w"), week.cast("string")))


def run_table(spark, sf_dir) -> DataFrame:
    by = ["run_id", "model", "split"]
    # A few numbers per run; stored because names and best models both read them.
    long = settle(metrics_long(evaluate(runs(spark, sf_dir), by), by))
    return run_metrics(long.withColumn("position", positions(SCORERS)))


def registry(spark, sf_dir) -> DataFrame:
    """Model versions per category and week, some in production, one by alias."""
    week = F.floor((F.col("day") - 1) / 7)
    seen = scored(spark, sf_dir).select("category", week.alias("week")).distinct()
    return seen.select(
        F.concat(F.lit("detector-"), "category").alias("model_name"),
        (F.col("week") + 1).alias("version"),
        F.when((F.col("category") == "signup") | (F.col("week") > 2), F.lit("None"))
        .when(F.col("week") == 2, F.lit("Production"))
        .otherwise(F.lit("Archived"))
        .alias("stage"),
        F.when((F.col("category") == "click") & (F.col("week") == 1), F.lit("champion")).alias("alias"),
        F.concat("category", F.lit("-w"), (F.col("week") + 1).cast("string")).alias("run_id"),
    )


def challengers(registered: DataFrame) -> DataFrame:
    return registered.where("version = 4").select("model_name", "run_id")


@query("run_metrics", f"WITH {RUN_METRICS_SQL} SELECT run_id, name, round(value + 1e-9, 6) AS value FROM rm")
def run_metric_rows(spark, sf_dir):
    return rounded(run_table(spark, sf_dir))


@query(
    "run_metrics_best",
    f"""WITH {RUN_METRICS_SQL}, plain AS (SELECT run_id, max(value) FILTER (name = 'val_auprc') AS a, max(value) FILTER (name = 'val_recall') AS r,
  max(value) FILTER (name = 'val_precision') AS p FROM rm GROUP BY 1), kept AS (SELECT run_id, name, value FROM rm WHERE run_id LIKE '%-w1' OR name NOT IN ('val_recall', 'val_precision', 'val_auprc')
  UNION ALL SELECT run_id || '-plain', substr(name, 5), value FROM rm WHERE run_id LIKE '%-w1' AND name IN ('val_recall', 'val_precision', 'val_auprc')), q AS (
  SELECT run_id, max(value) FILTER (name = 'auprc') AS a, max(value) FILTER (name = 'recall') AS r, max(value) FILTER (name = 'precision') AS p FROM kept GROUP BY 1), x AS (
  SELECT run_id, regexp_extract(name, '^(.*)_val_(auprc|recall|precision)$', 1) AS mk, regexp_extract(name, '^(.*)_val_(auprc|recall|precision)$', 2) AS mm, value FROM kept), cand AS (
  SELECT run_id, mk, max(value) FILTER (mm = 'auprc') AS a, max(value) FILTER (mm = 'recall') AS r, max(value) FILTER (mm = 'precision') AS p
  FROM x WHERE mm <> '' AND mk <> 'best' GROUP BY 1, 2), pick AS (
  SELECT run_id, coalesce(a, 0) AS a, coalesce(r, 0) AS r, coalesce(p, 0) AS p,
    row_number() OVER (PARTITION BY run_id ORDER BY (a IS NULL OR r IS NULL OR p IS NULL), coalesce(a, 0) DESC, mk) AS rn FROM cand)
SELECT q.run_id, round(CASE WHEN q.run_id LIKE '%-w1' THEN plain.a ELSE k.a END + 1e-9, 6) AS val_auprc,
  round(CASE WHEN q.run_id LIKE '%-w1' THEN plain.r ELSE k.r END + 1e-9, 6) AS val_recall,
  round(CASE WHEN q.run_id LIKE '%-w1' THEN plain.p ELSE k.p END + 1e-9, 6) AS val_precision,
  round(q.a + 1e-9, 6) AS auprc, round(q.r + 1e-9, 6) AS recall, round(q.p + 1e-9, 6) AS "precision"
FROM q LEFT JOIN plain ON plain.run_id = q.run_id LEFT JOIN pick k ON k.run_id = q.run_id AND rn = 1""",
)
def normalised_runs(spark, sf_dir):
    """Runs of the first week keep their validation names, and have a second run with nothing but plain names; all
    others only have per-model names."""
    rows = run_table(spark, sf_dir).select("run_id", "name", "value")
    first, validation = F.col("run_id").endswith("-w1"), F.col("name").isin("val_recall", "val_precision", "val_auprc")
    plain = rows.where(first & validation).select(
        F.concat("run_id", F.lit("-plain")).alias("run_id"), F.substring("name", 5, 100).alias("name"), "value"
    )
    table = rows.where(first | ~validation).unionByName(plain)
    return rounded(promotion_metrics(table))


@query("champion_lookup", f"WITH {SCORED}, {REGISTRY_SQL}, {CHAMPION_SQL} SELECT model_name, version, run_id FROM champions")
def champion(spark, sf_dir):
    return champion_versions(registry(spark, sf_dir))


@query(
    "promotion_gate",
    f"""WITH {GATE_SQL} SELECT model_name, promoted, reason, round(cr + 1e-9, 6) AS challenger_recall, round(pr + 1e-9, 6) AS champion_recall,
  round(cp + 1e-9, 6) AS challenger_precision, round(rp + 1e-9, 6) AS required_precision FROM gated""",
)
def gate(spark, sf_dir):
    table, reg = settle(run_table(spark, sf_dir)), settle(registry(spark, sf_dir))
    measured_runs = challengers(reg).join(promotion_metrics(table), "run_id", "left")
    return rounded(promotion_gate(measured_runs, champion_metrics(reg, table)))


@query(
    "promotion_report",
    f"""WITH {GATE_SQL} SELECT g.model_name, g.run_id AS challenger_run_id, c.run_id AS champion_run_id, c.version AS champion_version,
  promoted, reason FROM gated g LEFT JOIN champions c ON g.model_name = c.model_name""",
)
def promotion(spark, sf_dir):
    reg = settle(registry(spark, sf_dir))
    out, _ = promote(challengers(reg), settle(run_table(spark, sf_dir)), reg)
    return out.select("model_name", "challenger_run_id", "champion_run_id", "champion_version", "promoted", "reason")


@query(
    "promotion_document",
    f"""WITH {GATE_SQL}, sides AS (
  SELECT g.model_name, promoted, 'challenger' AS side, g.run_id FROM gated g UNION ALL
  SELECT g.model_name, promoted, 'champion', c.run_id FROM gated g JOIN champions c ON g.model_name = c.model_name)
SELECT model_name, promoted, side, name, round(value + 1e-9, 6) AS value FROM sides JOIN rm ON sides.run_id = rm.run_id""",
)
def promotion_document(spark, sf_dir):
    """The metrics of both runs of every decision, from the written report."""
    path, reg = scratch_path(spark, "promotions"), settle(registry(spark, sf_dir))
    promotion_job(challengers(reg), run_table(spark, sf_dir), reg, path, "r1")
    report = read_part(spark, path, "r1", "report")
    sides = [
        report.select("model_name", "promoted", F.lit(side).alias("side"), F.explode(f"{side}_metrics").alias("name", "value"))
        for side in ("challenger", "champion")
    ]
    return rounded(sides[0].unionByName(sides[1]))


@query("drift_document", ORACLES["drift_report"])
def drift_document(spark, sf_dir):
    """The drift report's figures, read back from a complete run."""
    train, test = train_and_test(spark, sf_dir)
    columns, path = shared_numeric(train, test), scratch_path(spark, "drift")
    drift_job(train.select(*columns), test.select(*columns), path, "r1")
    return report_figures(read_part(spark, path, "r1", "report"))


@query(
    "promotion_apply",
    f"""WITH {SCORED}, {REGISTRY_SQL}, pr AS (SELECT model_name, run_id FROM registry WHERE version = 4 AND model_name <> 'detector-view')
SELECT r.model_name, r.version, CASE WHEN pr.model_name IS NOT NULL AND stage = 'Production' THEN 'Archived' ELSE stage END AS stage,
  CASE WHEN pr.model_name IS NOT NULL AND alias = 'champion' THEN NULL ELSE alias END AS alias, r.run_id
FROM registry r LEFT JOIN pr ON r.model_name = pr.model_name
UNION ALL SELECT pr.model_name, (SELECT max(version) FROM registry x WHERE x.model_name = pr.model_name) + 1, 'Production', 'champion', pr.run_id FROM pr""",
)
def promoted_registry(spark, sf_dir):
    reg = settle(registry(spark, sf_dir))
    return apply_promotions(reg, challengers(reg).where("model_name <> 'detector-view'"))


# --------------------------------------------------------------------------- baseline against tuned
_VARIANTS = """v AS (SELECT 'detector' AS model, split, max(auprc) FILTER (model = 'Amount Rule') AS baseline, max(auprc) FILTER (model = 'Blend Rule') AS tuned
  FROM m GROUP BY 2)"""


def variants(spark, sf_dir) -> DataFrame:
    """The two scorers as baseline and tuned variant of one model."""
    variant = F.when(F.col("model") == SCORERS[0], F.lit("baseline")).otherwise(F.lit("tuned"))
    return measured(spark, sf_dir).withColumn("variant", variant).withColumn("model", F.lit("detector"))


@query(
    "tuning_comparison",
    f"{MS}, {_VARIANTS} SELECT model, split, round(baseline + 1e-9, 6) AS baseline, round(tuned + 1e-9, 6) AS tuned, round(tuned - baseline + 1e-9, 6) AS improvement FROM v",
)
def comparison(spark, sf_dir):
    return rounded(tuning_comparison(variants(spark, sf_dir)))


@query(
    "improvement_flags",
    f"""{MS}, {_VARIANTS} SELECT coalesce(bool_or(tuned - baseline > 0), false) AS any_improved, round(max(abs(tuned - baseline)) + 1e-9, 6) AS max_abs_change,
  coalesce(max(abs(tuned - baseline)) < 0.01e0, false) AS near_optimal FROM v WHERE split = 'test'""",
)
def flags(spark, sf_dir):
    return rounded(improvement_flags(tuning_comparison(variants(spark, sf_dir))))


@query(
    "param_diff",
    f"""{_SIDED}, a AS (SELECT category AS model, 'max_amt' AS param, CAST(max(floor(amt)) AS BIGINT)::VARCHAR AS value FROM sp WHERE split = 'train' GROUP BY 1
  UNION ALL SELECT category, 'months', count(DISTINCT substr(trans_date_trans_time, 1, 7))::VARCHAR FROM sp WHERE split = 'train' GROUP BY 1
  UNION ALL SELECT category, 'train_only', 'yes' FROM sp WHERE split = 'train' GROUP BY 1), b AS (
  SELECT category AS model, 'max_amt' AS param, CAST(max(floor(amt)) AS BIGINT)::VARCHAR AS value FROM sp WHERE split <> 'train' GROUP BY 1
  UNION ALL SELECT category, 'months', count(DISTINCT substr(trans_date_trans_time, 1, 7))::VARCHAR FROM sp WHERE split <> 'train' GROUP BY 1)
SELECT model, param, a.value AS original, b.value AS tuned, a.value IS NOT DISTINCT FROM b.value AS same FROM a FULL JOIN b USING (model, param)""",
)
def diff(spark, sf_dir):
    """Parameters measured inside and outside the training split, as original and tuned sets."""
    rows = hash_split(transactions(spark, sf_dir), KEY)

    def part(inside: bool) -> DataFrame:
        wide = (
            rows.where((F.col("split") == "train") == F.lit(inside))
            .groupBy(F.col("category").alias("model"))
            .agg(
                F.max(F.floor("amt")).cast("string").alias("max_amt"),
                F.count_distinct(F.substring("trans_date_trans_time", 1, 7)).cast("string").alias("months"),
                F.lit("yes").alias("train_only"),
            )
        )
        names = ["max_amt", "months"] + (["train_only"] if inside else [])
        return wide.unpivot(["model"], names, "param", "value")

    return parameter_diff(part(True), part(False))


