import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

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
from cardwarden.operators.ordered import exact_quantiles
from cardwarden.operators.selection import best_model


def brute(labels, scores):
    """AUC over all pairs, step-wise average precision, trapezoid area."""
    y, s = np.array(labels), np.array(scores)
    pos, neg = s[y == 1], s[y == 0]
    auc = None
    if len(pos) and len(neg):
        d = pos[:, None] - neg[None, :]
        auc = ((d > 0).sum() + 0.5 * (d == 0).sum()) / d.size
    ap = area = 0.0
    recall_before, precision_before = 0.0, 1.0
    for t in sorted(set(scores), reverse=True):
        hit = s >= t
        tp = (y[hit] == 1).sum()
        recall = tp / max(len(pos), 1)
        precision = tp / hit.sum()
        ap += (recall - recall_before) * precision
        area += (recall - recall_before) * (precision + precision_before) / 2
        recall_before, precision_before = recall, precision
    return auc, ap, area


def frame(spark, labels, scores, model="m"):
    return spark.createDataFrame(
        [(model, int(a), float(b)) for a, b in zip(labels, scores)], "model string, label int, score double"
    )


def check(row, labels, scores):
    auc, ap, area = brute(labels, scores)
    if auc is None:
        assert row["auc_roc"] is None
    else:
        assert row["auc_roc"] == pytest.approx(auc, abs=1e-12)
    assert row["auprc"] == pytest.approx(ap, abs=1e-12)
    assert row["pr_trapezoid"] == pytest.approx(area, abs=1e-12)


@pytest.mark.parametrize("buckets", [1, 2, 7, 64])
def test_ranking_metrics_against_all_pairs(spark, buckets):
    rng = np.random.default_rng(3)
    labels = rng.integers(0, 2, 400)
    scores = np.round(rng.random(400) ** 3, 2)
    df = frame(spark, labels, scores).unionByName(frame(spark, 1 - labels, scores, "n"))
    rows = {r["model"]: r for r in ranking_metrics(df, ["model"], buckets=buckets).collect()}
    check(rows["m"], labels, scores)
    check(rows["n"], 1 - labels, scores)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 5)), min_size=1, max_size=30), st.sampled_from([1, 3]))
def test_ranking_properties(spark, pairs, buckets):
    labels, scores = [p[0] for p in pairs], [p[1] / 5 for p in pairs]
    row = ranking_metrics(frame(spark, labels, scores), ["model"], buckets=buckets).first()
    check(row, labels, scores)
    mirrored = ranking_metrics(frame(spark, labels, [1 - s for s in scores]), ["model"], buckets=buckets).first()
    if row["auc_roc"] is not None:
        assert mirrored["auc_roc"] == pytest.approx(1 - row["auc_roc"], abs=1e-12)


@pytest.mark.parametrize(
    "labels, scores, auc, ap",
    [
        ([0, 1, 0, 1], [0.5, 0.5, 0.5, 0.5], 0.5, 0.5),
        ([0, 0, 1, 1], [0.1, 0.2, 0.8, 0.9], 1.0, 1.0),
        ([1, 1], [0.1, 0.9], None, 1.0),
        ([0, 0], [0.1, 0.9], None, 0.0),
    ],
)
def test_edge_cases(spark, labels, scores, auc, ap):
    row = evaluate(frame(spark, labels, scores), ["model"]).first()
    assert row["auc_roc"] == auc and row["auprc"] == pytest.approx(ap)


def test_threshold_is_inclusive_unless_strict(spark):
    df = frame(spark, [1, 0], [0.5, 0.4])
    assert threshold_metrics(df, ["model"]).first()["recall"] == 1.0
    strict = threshold_metrics(df, ["model"], strict=True).first()
    assert (strict["recall"], strict["precision"], strict["f1"]) == (0.0, 0.0, 0.0)


def test_confusion_matrix_has_all_cells(spark):
    cells = confusion_matrix(frame(spark, [1, 1, 0], [0.9, 0.8, 0.7]), ["model"]).collect()
    assert {(r["actual"], r["predicted"]): r["rows"] for r in cells} == {(0, 0): 0, (0, 1): 1, (1, 0): 0, (1, 1): 2}


def test_report_averages(spark):
    labels, scores = [1, 1, 0, 0, 0], [0.9, 0.1, 0.8, 0.2, 0.3]
    rows = {r["entry"]: r for r in classification_report(frame(spark, labels, scores), ["model"]).collect()}
    assert rows["Fraud (1)"]["precision"] == pytest.approx(0.5)
    assert rows["Legit (0)"]["recall"] == pytest.approx(2 / 3)
    assert rows["accuracy"]["f1"] == pytest.approx(0.6)
    assert rows["macro avg"]["recall"] == pytest.approx((0.5 + 2 / 3) / 2)
    assert rows["weighted avg"]["recall"] == pytest.approx(0.6)
    assert rows["weighted avg"]["support"] == 5


@pytest.mark.parametrize("buckets", [1, 4])
def test_curves(spark, buckets):
    df = frame(spark, [1, 0, 1, 0], [0.9, 0.8, 0.8, 0.1])
    pr = {r["threshold"]: (r["precision"], r["recall"]) for r in pr_curve(df, ["model"], buckets=buckets).collect()}
    assert pr[None] == (1.0, 0.0) and pr[0.9] == (1.0, 0.5)
    assert pr[0.8] == (pytest.approx(2 / 3), 1.0) and pr[0.1] == (0.5, 1.0)
    roc = {r["threshold"]: (r["fpr"], r["tpr"]) for r in roc_curve(df, ["model"], buckets=buckets).collect()}
    assert roc[None] == (0.0, 0.0) and roc[0.8] == (0.5, 1.0) and roc[0.1] == (1.0, 1.0)


def corners_of(labels, scores):
    """Points of the curve by plain counting, without those on the line between their neighbours."""
    y, s = np.array(labels), np.array(scores)
    points = [(None, 0, 0)] + [(t, int((y[s >= t] == 0).sum()), int((y[s >= t] == 1).sum())) for t in sorted(set(scores), reverse=True)]
    def turns(a, b, c):
        return (b[1] - a[1]) * (c[2] - b[2]) != (b[2] - a[2]) * (c[1] - b[1])
    kept = [points[0]] + [p for a, p, c in zip(points, points[1:], points[2:]) if turns(a, p, c)] + [points[-1]]
    return [(t, x / max(1, (y == 0).sum()), z / max(1, (y == 1).sum())) for t, x, z in kept]


@pytest.mark.parametrize("buckets", [1, 4, 64])
def test_corners_equal_brute_force(spark, buckets):
    rng = np.random.default_rng(2)
    groups = {
        "ties": (rng.integers(0, 2, 200), rng.integers(0, 30, 200) / 30.0),
        "free": (rng.integers(0, 2, 300), rng.random(300)),
        "ones": (np.ones(40, int), rng.random(40)),
        "line": (np.tile([0, 1], 30), np.repeat(np.arange(30), 2) / 30.0),
        "single": (np.array([1]), np.array([0.3])),
    }
    df = None
    for name, (y, s) in groups.items():
        part = frame(spark, y, s, name)
        df = part if df is None else df.unionByName(part)
    got = roc_curve(df, ["model"], buckets=buckets, corners=True).collect()
    every = roc_curve(df, ["model"], buckets=buckets).count()
    for name, (y, s) in groups.items():
        mine = sorted(((r["threshold"], r["fpr"], r["tpr"]) for r in got if r["model"] == name), key=lambda p: (p[1], p[2]))
        want = corners_of(y.tolist(), s.tolist())
        assert [p[0] for p in mine] == [p[0] for p in want]
        assert [p[1:] for p in mine] == [pytest.approx(p[1:]) for p in want]
    # Only the origin and the end are left of a straight line.
    assert sum(r["model"] == "line" for r in got) == 2 and len(got) < every
    assert roc_curve(df.where("false"), ["model"], buckets=buckets, corners=True).count() == 0


def test_curves_read_their_input_once(spark, tmp_path):
    rng = np.random.default_rng(4)
    frame(spark, rng.integers(0, 2, 500), rng.random(500)).write.parquet(str(tmp_path / "scored"))
    df = spark.read.parquet(str(tmp_path / "scored"))
    for curve in (pr_curve(df, ["model"], buckets=1), roc_curve(df, ["model"], buckets=1, corners=True)):
        curve.collect()
        assert curve._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("FileScan parquet") == 1


def test_nested_report_roundtrip(spark):
    rows = [("a", s, m, v) for s in ("train", "val") for m, v in (("auprc", 0.5), ("f1", 0.25))]
    long = spark.createDataFrame(rows, "model string, split string, metric string, value double")
    back = flatten_nested(nest_metrics(long))
    assert sorted(map(tuple, back.collect())) == sorted(rows)


@pytest.mark.parametrize(
    "train, val, text",
    [
        (0.49, 0.49, "HIGH BIAS (Underfitting)"),
        (0.9, 0.7, "HIGH VARIANCE (Overfitting)"),
        (0.9, 0.8, "MODERATE VARIANCE"),
        (0.99774, 0.95099, "GOOD FIT"),
        (0.9, 0.85, "MODERATE VARIANCE"),
    ],
)
def test_diagnosis(spark, train, val, text):
    rows = [("a", "train", "auprc", train), ("a", "val", "auprc", val), ("a", "test", "auprc", val)]
    long = spark.createDataFrame(rows, "model string, split string, metric string, value double")
    row = bias_variance(long).first()
    expected = text if abs(train - val) != 0.05 else "GOOD FIT"
    assert row["diagnosis"] == expected
    assert row["train_val_gap_auprc"] == abs(train - val)


def test_first_model_wins_ties(spark):
    df = spark.createDataFrame([("a", 1, 0.5), ("b", 0, 0.5), ("c", 2, 0.4)], "model string, position int, auprc double")
    assert best_model(df).first()["best_model"] == "b"


def test_long_form(spark):
    wide = evaluate(frame(spark, [1, 0], [0.9, 0.1]), ["model"])
    assert {r["metric"] for r in metrics_long(wide, ["model"]).collect()} == {"auc_roc", "auprc", "recall", "precision", "f1"}


@pytest.mark.parametrize("buckets", [1, 3, 16])
def test_quantiles_match_numpy(spark, buckets):
    rng = np.random.default_rng(5)
    a = np.round(rng.exponential(size=301), 1)
    b = rng.normal(size=301)
    rows = [(float(x), float(y) if i % 10 else None) for i, (x, y) in enumerate(zip(a, b))]
    rows += [(float("nan"), None)]
    df = spark.createDataFrame(rows, "a double, b double")
    fractions = [0.0, 0.1, 0.5, 0.95, 1.0]
    got = {(r["feature"], r["fraction"]): r["value"] for r in exact_quantiles(df, ["a", "b"], fractions, buckets).collect()}
    present = b[[i for i in range(301) if i % 10]]
    for q in fractions:
        assert got[("a", q)] == pytest.approx(np.quantile(a, q))
        assert got[("b", q)] == pytest.approx(np.quantile(present, q))
