"""Binary-classification metrics over scored tables.

Input rows are ``(by..., label, score)``; every function evaluates all groups (model, split, ...)
in one plan. Equal scores are collapsed before anything is shuffled, so heavy ties cost nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwarden.operators.ordered import add_buckets, bucket_offsets, choose_buckets, running_totals

# Diagnosis limits and texts, class names of the report.
LOW_TRAIN_METRIC = 0.5
LARGE_GAP = 0.15
NOTICEABLE_GAP = 0.05
DIAGNOSES = {
    "bias": "HIGH BIAS (Underfitting)",
    "variance": "HIGH VARIANCE (Overfitting)",
    "moderate": "MODERATE VARIANCE",
    "good": "GOOD FIT",
}
CLASS_NAMES = ["Legit (0)", "Fraud (1)"]
METRIC_NAMES = ["auc_roc", "auprc", "recall", "precision", "f1"]


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    return F.coalesce(F.try_divide(numerator, denominator), F.lit(0.0))


def ranked_scores(
    df: DataFrame,
    by: list[str],
    label: str = "label",
    score: str = "score",
    buckets: int | None = None,
    following: bool = False,
) -> DataFrame:
    """One row per group and distinct score, best first.

    ``pos`` and ``n`` count the rows at the score, ``pos_upto`` and ``n_upto`` all rows scored at
    least as high, ``pos_all`` and ``n_all`` the group. ``following`` adds ``pos_next`` and ``n_next``,
    the counts at the next lower score (NULL at the lowest).
    """
    narrow = df.select(*by, F.col(label).cast("int").alias("y"), F.col(score).cast("double").alias("value"))
    buckets = choose_buckets(narrow) if buckets is None else buckets
    marked = add_buckets(narrow, ["value"], buckets).withColumnRenamed("value_bucket", "bucket")
    collapsed = marked.groupBy(*by, "bucket", "value").agg(
        F.sum("y").alias("pos"), F.count(F.lit(1)).alias("n")
    )
    if not following:
        return running_totals(collapsed, by, ["pos", "n"], descending=True, buckets=buckets)
    inside = Window.partitionBy(*by, "bucket").orderBy(F.desc("value"))
    ahead = {f"{m}_next": F.lead(m).over(inside) for m in ("pos", "n")}
    if buckets <= 1:
        return running_totals(collapsed.withColumns(ahead), by, ["pos", "n"], descending=True, buckets=buckets)
    # The next score of a bucket's last row opens the next bucket; one row per bucket carries it over.
    totals = collapsed.groupBy(*by, "bucket").agg(
        F.sum("pos").alias("pos"), F.sum("n").alias("n"), F.max(F.struct("value", "pos", "n")).alias("top")
    )
    behind = F.lead("top").over(Window.partitionBy(*by).orderBy(F.desc("bucket")))
    offsets = bucket_offsets(totals, by, ["pos", "n"], descending=True).withColumn("behind", behind).drop("top")
    ranked = running_totals(
        collapsed.withColumns(ahead), by, ["pos", "n"], descending=True, buckets=buckets, offsets=offsets
    )
    carried = {f"{m}_next": F.coalesce(f"{m}_next", f"behind.{m}") for m in ("pos", "n")}
    return ranked.withColumns(carried).drop("behind")


def ranking_metrics(
    df: DataFrame, by: list[str], label: str = "label", score: str = "score", buckets: int | None = None
) -> DataFrame:
    """``auc_roc`` (ties count half), ``auprc`` (step-wise average precision) and
    ``pr_trapezoid`` (area under the linearly joined precision-recall points) per group.

    ``auc_roc`` is NULL for one-class groups; without positives the other two are 0.
    """
    ranked = ranked_scores(df, by, label, score, buckets)
    pos, n = F.col("pos"), F.col("n")
    pos_before, n_before = F.col("pos_upto") - pos, F.col("n_upto") - n
    neg_all = F.col("n_all") - F.col("pos_all")
    precision = F.col("pos_upto") / F.col("n_upto")
    # Ahead of the best score the curve starts at recall 0 with precision 1.
    precision_before = F.coalesce(F.try_divide(pos_before, n_before), F.lit(1.0))
    return (
        ranked.groupBy(*by)
        .agg(
            F.sum((n - pos) * (pos_before + pos * 0.5)).alias("_pairs"),
            F.sum(pos * precision).alias("_steps"),
            F.sum(pos * (precision + precision_before) / 2.0).alias("_area"),
            F.max("pos_all").alias("_pos"),
            F.max(neg_all).alias("_neg"),
        )
        .select(
            *by,
            F.try_divide(F.col("_pairs"), F.col("_pos").cast("double") * F.col("_neg")).alias("auc_roc"),
            ratio_or_zero(F.col("_steps"), F.col("_pos")).alias("auprc"),
            ratio_or_zero(F.col("_area"), F.col("_pos")).alias("pr_trapezoid"),
        )
    )


def confusion_counts(
    df: DataFrame,
    by: list[str],
    label: str = "label",
    score: str = "score",
    threshold: float = 0.5,
    strict: bool = False,
) -> DataFrame:
    """``tp, fp, fn, tn`` per group; a score equal to the threshold is positive unless ``strict``."""
    said = F.col(score) > threshold if strict else F.col(score) >= threshold
    real = F.col(label) == 1
    return df.groupBy(*by).agg(
        F.count_if(said & real).alias("tp"),
        F.count_if(said & ~real).alias("fp"),
        F.count_if(~said & real).alias("fn"),
        F.count_if(~said & ~real).alias("tn"),
    )


def threshold_metrics(
    df: DataFrame,
    by: list[str],
    label: str = "label",
    score: str = "score",
    threshold: float = 0.5,
    strict: bool = False,
) -> DataFrame:
    """Precision, recall, F1, accuracy and false-positive rate; an empty denominator gives 0."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return confusion_counts(df, by, label, score, threshold, strict).select(
        *by,
        ratio_or_zero(tp, tp + fn).alias("recall"),
        ratio_or_zero(tp, tp + fp).alias("precision"),
        ratio_or_zero(2 * tp, 2 * tp + fp + fn).alias("f1"),
        ratio_or_zero(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        ratio_or_zero(fp, fp + tn).alias("false_positive_rate"),
    )


def confusion_matrix(
    df: DataFrame, by: list[str], label: str = "label", score: str = "score", threshold: float = 0.5
) -> DataFrame:
    """Four rows ``(actual, predicted, rows)`` per group, zero cells included."""
    cells = [
        F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(c).alias("rows"))
        for a, p, c in [(0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp")]
    ]
    counts = confusion_counts(df, by, label, score, threshold)
    return counts.select(*by, F.inline(F.array(*cells)))


def classification_report(
    df: DataFrame, by: list[str], label: str = "label", score: str = "score", threshold: float = 0.5
) -> DataFrame:
    """Rows ``(entry, precision, recall, f1, support)``: both classes, accuracy, two averages."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    total = tp + fp + fn + tn

    def one_class(hit: Column, wrong: Column, missed: Column) -> dict[str, Column]:
        return {
            "precision": ratio_or_zero(hit, hit + wrong),
            "recall": ratio_or_zero(hit, hit + missed),
            "f1": ratio_or_zero(2 * hit, 2 * hit + wrong + missed),
        }

    legit, fraud = one_class(tn, fn, fp), one_class(tp, fp, fn)
    accuracy = ratio_or_zero(tp + tn, total)

    def entry(name: str, values: dict[str, Column], support: Column) -> Column:
        return F.struct(
            F.lit(name).alias("entry"), *[values[k].alias(k) for k in values], support.alias("support")
        )

    rows = [
        entry(CLASS_NAMES[0], legit, tn + fp),
        entry(CLASS_NAMES[1], fraud, tp + fn),
        entry("accuracy", {k: accuracy for k in legit}, total),
        entry("macro avg", {k: (legit[k] + fraud[k]) / 2.0 for k in legit}, total),
        entry(
            "weighted avg",
            {k: ratio_or_zero(legit[k] * (tn + fp) + fraud[k] * (tp + fn), total) for k in legit},
            total,
        ),
    ]
    counts = confusion_counts(df, by, label, score, threshold)
    return counts.select(*by, F.inline(F.array(*rows)))


def _points(
    ranked: DataFrame, by: list[str], values: dict[str, Column], start: dict[str, float], wanted: Column | None = None
) -> DataFrame:
    """``threshold`` and ``values`` of the wanted rows; the row of the best score also gives the point that lies
    before any score (its threshold is NULL), so the ranked table is read once."""
    point = F.struct(F.col("value").alias("threshold"), *[v.alias(k) for k, v in values.items()])
    first = F.struct(F.lit(None).cast("double").alias("threshold"), *[F.lit(v).alias(k) for k, v in start.items()])
    own = F.array(point) if wanted is None else F.when(wanted, F.array(point)).otherwise(F.array())
    both = F.when(F.col("n_upto") == F.col("n"), F.concat(F.array(first), own)).otherwise(own)
    return ranked.select(*by, F.inline(both))


def pr_curve(
    df: DataFrame, by: list[str], label: str = "label", score: str = "score", buckets: int | None = None
) -> DataFrame:
    """``(threshold, precision, recall)`` at every distinct score plus the end point (1, 0)."""
    ranked = ranked_scores(df, by, label, score, buckets)
    values = {
        "precision": F.col("pos_upto") / F.col("n_upto"),
        "recall": ratio_or_zero(F.col("pos_upto"), F.col("pos_all")),
    }
    return _points(ranked, by, values, {"precision": 1.0, "recall": 0.0})


def roc_curve(
    df: DataFrame,
    by: list[str],
    label: str = "label",
    score: str = "score",
    buckets: int | None = None,
    corners: bool = False,
) -> DataFrame:
    """``(threshold, fpr, tpr)`` at every distinct score plus the origin.

    ``corners``: only the points where the curve turns, and its end. The others lie on the line between two
    corners, so the curve and its area stay the same.
    """
    ranked = ranked_scores(df, by, label, score, buckets, following=corners)
    values = {
        "fpr": ratio_or_zero(F.col("n_upto") - F.col("pos_upto"), F.col("n_all") - F.col("pos_all")),
        "tpr": ratio_or_zero(F.col("pos_upto"), F.col("pos_all")),
    }
    turns = None
    if corners:
        # Cross product of the steps to and from the point, in decimals that hold products of two counts.
        step = {c: F.col(c).cast("decimal(18,0)") for c in ("pos", "n", "pos_next", "n_next")}
        cross = step["pos"] * step["n_next"] - step["n"] * step["pos_next"]
        turns = F.col("n_next").isNull() | (cross != 0)
    return _points(ranked, by, values, {"fpr": 0.0, "tpr": 0.0}, turns)


def evaluate(
    df: DataFrame,
    by: list[str],
    label: str = "label",
    score: str = "score",
    threshold: float = 0.5,
    buckets: int | None = None,
) -> DataFrame:
    """All report metrics per group: ``auc_roc, auprc, recall, precision, f1``."""
    ranking = ranking_metrics(df, by, label, score, buckets).drop("pr_trapezoid")
    decided = threshold_metrics(df, by, label, score, threshold).drop("accuracy", "false_positive_rate")
    # Both sides are one row per group and share their keys' partitioning.
    return ranking.join(decided, by)


def metrics_long(wide: DataFrame, by: list[str], metrics: list[str] | None = None) -> DataFrame:
    """Rows ``(by..., metric, value)``."""
    return wide.unpivot(by, metrics or METRIC_NAMES, "metric", "value")


def flatten_nested(report: DataFrame, column: str = "results") -> DataFrame:
    """``map<model, map<split, map<metric, value>>>`` to rows ``(model, split, metric, value)``."""
    return (
        report.select(F.explode(column).alias("model", "splits"))
        .select("model", F.explode("splits").alias("split", "metrics"))
        .select("model", "split", F.explode("metrics").alias("metric", "value"))
    )


def nest_metrics(long: DataFrame) -> DataFrame:
    """Rows ``(model, split, metric, value)`` to one nested map, for reports.

    The table has one row per model, split and metric, whatever the size of the data.
    """
    per_split = long.groupBy("model", "split").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("metric", "value")))).alias("m")
    )
    per_model = per_split.groupBy("model").agg(
        F.map_from_entries(F.collect_list(F.struct("split", "m"))).alias("s")
    )
    return per_model.agg(F.map_from_entries(F.collect_list(F.struct("model", "s"))).alias("results"))


def bias_variance(long: DataFrame, metric: str = "auprc") -> DataFrame:
    """Gaps between the splits and the diagnosis, one row per model."""
    by_split = (
        long.where(F.col("metric") == metric)
        .groupBy("model")
        .pivot("split", ["train", "val", "test"])
        .agg(F.first("value"))
    )
    train, val, test = F.col("train"), F.col("val"), F.col("test")
    gap = F.abs(train - val)
    diagnosis = (
        # Without a training or validation value there is no diagnosis.
        F.when(gap.isNull(), F.lit(None).cast("string"))
        .when(train < LOW_TRAIN_METRIC, DIAGNOSES["bias"])
        .when(gap > LARGE_GAP, DIAGNOSES["variance"])
        .when(gap > NOTICEABLE_GAP, DIAGNOSES["moderate"])
        .otherwise(DIAGNOSES["good"])
    )
    return by_split.select(
        "model",
        train.alias(f"train_{metric}"),
        val.alias(f"val_{metric}"),
        test.alias(f"test_{metric}"),
        gap.alias(f"train_val_gap_{metric}"),
        F.abs(train - test).alias(f"train_test_gap_{metric}"),
        F.abs(val - test).alias(f"val_test_gap_{metric}"),
        diagnosis.alias("diagnosis"),
    )
