import itertools
import math
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cardwarden.functions.pvalues import binomial_two_sided, chi2_tail, ks_exact_tail
from cardwarden.operators.ordered import add_buckets
from cardwarden.operators import drift
from cardwarden.operators.drift import (
    category_counts,
    category_drift,
    distribution_drift,
    drift_summary,
    feature_drift,
    ks_distances,
    shared_numeric,
    target_drift,
    two_sides,
)
from cardwarden.operators.stability import category_share_shift, population_stability
from cardwarden.plans.drift_report import drift_report

SCHEMA = "amt double, city_pop long, is_fraud int"


@pytest.fixture(scope="module")
def tables(spark):
    ref = spark.createDataFrame([(10.0, 100, 0), (12.0, 200, 0), (14.0, 300, 1), (16.0, 400, 0)], SCHEMA)
    cur = spark.createDataFrame([(11.0, 110, 0), (13.0, 210, 1), (15.0, 310, 0), (17.0, 410, 0)], SCHEMA)
    return ref, cur


def test_fixture(tables):
    ref, cur = tables
    columns = shared_numeric(ref, cur)
    both = two_sides(ref, cur, columns)
    rows = {r["feature"]: r for r in feature_drift(both, columns, p_method="exact").collect()}
    assert rows["amt"]["statistic"] == 0.25 and rows["city_pop"]["statistic"] == 0.25
    assert rows["is_fraud"]["statistic"] == 0.0
    assert rows["amt"]["p_value"] == pytest.approx(1.0)
    assert not any(r["drifted"] for r in rows.values())
    target = target_drift(both).first()
    assert (target["reference_fraud_rate"], target["current_fraud_rate"]) == (0.25, 0.25)
    assert target["p_value"] == pytest.approx(1.0) and target["drifted"] is False
    summary = drift_summary(feature_drift(both, columns)).first()
    assert summary["total_features_checked"] == 3 and summary["overall_drift_detected"] is False


def test_report_sections(tables):
    ref, cur = tables
    rows = drift_report(ref, cur).collect()
    assert sorted(r["section"] for r in rows) == ["feature", "feature", "feature", "summary", "target"]
    without = drift_report(ref.drop("is_fraud"), cur).collect()
    assert "target" not in {r["section"] for r in without}


def brute_distance(a, b):
    points = np.unique(np.concatenate([a, b]))
    fa = np.searchsorted(np.sort(a), points, side="right") / len(a)
    fb = np.searchsorted(np.sort(b), points, side="right") / len(b)
    return np.abs(fa - fb).max()


@pytest.mark.parametrize("buckets", [1, 2, 5, 40])
@pytest.mark.parametrize("shift", [0.0, 0.05, 1.0])
def test_distance_against_brute_force(spark, buckets, shift):
    rng = np.random.default_rng(11)
    a = {"smooth": rng.normal(size=300), "tied": rng.integers(0, 4, 300).astype(float), "spike": np.zeros(300)}
    b = {"smooth": rng.normal(shift, 1, 200), "tied": rng.integers(0, 4, 200) + shift, "spike": rng.random(200) * shift}
    names = list(a)
    ref = spark.createDataFrame([tuple(float(a[n][i]) for n in names) for i in range(300)], names)
    cur = spark.createDataFrame([tuple(float(b[n][i]) for n in names) for i in range(200)], names)
    for one, other, left, right in [(ref, cur, a, b), (cur, ref, b, a)]:
        d = ks_distances(two_sides(one, other, names), names, ["ref", "cur"], [("ref", "cur")], buckets)
        for r in d.collect():
            assert r["ks_ref_cur"] == pytest.approx(brute_distance(left[r["feature"]], right[r["feature"]]), abs=1e-12)


def test_three_sides_at_once(spark):
    rng = np.random.default_rng(2)
    parts = {"train": rng.normal(size=120), "val": rng.normal(0.3, 1, 50), "test": rng.normal(-0.4, 1, 70)}
    df = spark.createDataFrame([(s, float(v)) for s, vs in parts.items() for v in vs], "side string, x double")
    for buckets in (1, 6):
        r = ks_distances(df, ["x"], list(parts), [("train", "val"), ("train", "test")], buckets).first()
        assert r["ks_train_val"] == pytest.approx(brute_distance(parts["train"], parts["val"]))
        assert r["ks_train_test"] == pytest.approx(brute_distance(parts["train"], parts["test"]))


def test_missing_values_and_empty_sides(spark):
    df = spark.createDataFrame(
        [("ref", 1.0, None), ("ref", None, None), ("cur", 1.0, 2.0), ("cur", float("nan"), 3.0)],
        "side string, a double, b double",
    )
    for buckets in (1, 3):
        rows = ks_distances(df, ["a", "b"], ["ref", "cur"], [("ref", "cur")], buckets).collect()
        assert [(r["feature"], r["n_ref"], r["n_cur"], r["ks_ref_cur"]) for r in rows] == [("a", 1, 1, 0.0)]


def test_exact_tail_by_enumeration():
    n, m = 4, 5
    worst = []
    for chosen in itertools.combinations(range(n + m), n):
        first = set(chosen)
        i = j = 0
        top = 0.0
        for k in range(n + m):
            i, j = (i + 1, j) if k in first else (i, j + 1)
            top = max(top, abs(i / n - j / m))
        worst.append(top)
    for d in sorted(set(worst)):
        share = sum(w >= d - 1e-12 for w in worst) / len(worst)
        assert ks_exact_tail(d, n, m) == pytest.approx(share, abs=1e-12)
        assert ks_exact_tail(d, m, n) == pytest.approx(share, abs=1e-12)
    assert ks_exact_tail(0.25, 4, 4) == pytest.approx(1.0)
    assert ks_exact_tail(0.0, 10, 10) == 1.0


def step_by_step(d, n, m):
    """Chance of leaving the corridor, one merged value at a time."""
    limit, i = round(d * n * m), np.arange(n + 1)
    inside = np.where(i == 0, 1.0, 0.0)
    for s in range(1, n + m + 1):
        came = inside * ((s - i) / s) + np.concatenate([[0.0], inside[:-1]]) * (i / s)
        inside = np.where((i <= s) & (s - i <= m) & (np.abs(i * (n + m) - s * n) < limit), came, 0.0)
    return 1.0 - inside[n]


@pytest.mark.parametrize("n, m", [(1, 1), (1, 300), (40, 41), (128, 128), (300, 700), (900, 2100)])
def test_exact_tail_by_strides_equals_single_steps(n, m):
    for z in (0.01, 0.2, 0.5, 0.8, 1.2, 2.5, 6.0):
        d = min(1.0, z / math.sqrt(n * m / (n + m)))
        assert ks_exact_tail(d, n, m) == pytest.approx(step_by_step(d, n, m), abs=1e-11)


def test_exact_tail_of_large_samples_takes_seconds():
    began, n, m = time.perf_counter(), 20_000, 70_000
    p = ks_exact_tail(0.8 / math.sqrt(n * m / (n + m)), n, m)
    assert p == pytest.approx(2 * sum((-1) ** (k + 1) * math.exp(-2 * k * k * 0.64) for k in range(1, 50)), rel=0.01)
    assert ks_exact_tail(0.5, 10_000_000, 30_000_000) == 0.0
    assert time.perf_counter() - began < 25


def test_exact_p_values_are_spread_over_tasks(spark):
    df = spark.createDataFrame([(float(i), "ref" if i % 3 else "cur") for i in range(300)], "a double, side string")
    names = [f"x{k}" for k in range(4)]
    wide = df.select("side", *[(F.col("a") * (k + 1)).alias(n) for k, n in enumerate(names)])
    assert feature_drift(wide, names, p_method="exact").rdd.getNumPartitions() == 4


def test_large_sample_tail_is_close_to_the_exact_one(spark):
    df = spark.createDataFrame([(0.04, 3000, 2500), (0.001, 3000, 2500)], "d double, n long, m long")
    from cardwarden.functions.pvalues import ks_asymptotic

    near, zero = [r[0] for r in df.select(ks_asymptotic(F.col("d"), F.col("n"), F.col("m"))).collect()]
    assert near == pytest.approx(ks_exact_tail(0.04, 3000, 2500), rel=0.03)
    assert zero == 1.0


@pytest.mark.parametrize("df", [1, 2, 3, 4, 7, 10])
def test_chi_square_tail_by_integration(df):
    x = 3.7
    grid = np.linspace(x, 200, 2_000_001)
    density = grid ** (df / 2 - 1) * np.exp(-grid / 2) / (2 ** (df / 2) * math.gamma(df / 2))
    area = float(((density[1:] + density[:-1]) / 2 * np.diff(grid)).sum())
    assert chi2_tail(x, df) == pytest.approx(area, abs=1e-7)
    assert chi2_tail(0.0, df) == 1.0 and chi2_tail(float("inf"), df) == 0.0


@pytest.mark.parametrize("k, n, p0", [(3, 20, 0.1), (0, 15, 0.3), (15, 15, 0.3), (7, 40, 0.5), (1, 4, 0.25)])
def test_binomial_by_full_sum(k, n, p0):
    pmf = [math.comb(n, i) * p0**i * (1 - p0) ** (n - i) for i in range(n + 1)]
    want = sum(p for p in pmf if p <= pmf[k] * (1 + 1e-7))
    assert binomial_two_sided(k, n, p0) == pytest.approx(min(1.0, want), abs=1e-12)


def test_binomial_extremes():
    assert binomial_two_sided(0, 10, 0.0) == 1.0 and binomial_two_sided(1, 10, 0.0) == 0.0
    assert binomial_two_sided(5_000_000_000, 10**12, 0.005) == pytest.approx(1.0, abs=1e-6)
    assert binomial_two_sided(6_000_000_000, 10**12, 0.005) == 0.0


def test_categories(spark):
    df = spark.createDataFrame(
        [("ref", "a")] * 6 + [("ref", "b")] * 4 + [("cur", "a")] * 3 + [("cur", "b")] * 7, "side string, kind string"
    )
    row = category_drift(df, ["kind"]).first()
    assert row["statistic"] == pytest.approx(9 / 6 + 9 / 4)
    assert row["p_value"] == pytest.approx(chi2_tail(3.75, 1))
    fresh = df.unionByName(spark.createDataFrame([("cur", "c")], df.schema))
    counts = {r["category_value"]: (r["n_ref"], r["n_cur"]) for r in category_counts(fresh, "kind").collect()}
    assert counts["c"] == (0, 1)
    new = category_drift(fresh, ["kind"]).first()
    assert new["new_categories"] == 1 and new["drifted"]
    assert category_drift(fresh, ["kind"], scale_expected=False).first()["statistic"] is None
    with pytest.raises(ValueError):
        distribution_drift(df, "kind", "other")
    shift = {r["category_value"]: r for r in category_share_shift(df, "kind").collect()}
    assert shift["a"]["share_diff"] == pytest.approx(0.3) and shift["a"]["status"] == "alert"


def test_stability_index(spark):
    rng = np.random.default_rng(4)
    rows = [("ref", float(x), 1.0) for x in rng.normal(size=500)] + [("cur", float(x), 1.0) for x in rng.normal(0.8, 1, 400)]
    df = spark.createDataFrame(rows, "side string, x double, flat double")
    got = {r["feature"]: r for r in population_stability(df, ["x", "flat"]).collect()}
    ref = np.array([r[1] for r in rows if r[0] == "ref"])
    cur = np.array([r[1] for r in rows if r[0] == "cur"])
    edges = np.quantile(ref, np.arange(1, 10) / 10)
    r = np.maximum(np.bincount(np.searchsorted(edges, ref, "right"), minlength=10) / 500, 1e-4)
    c = np.maximum(np.bincount(np.searchsorted(edges, cur, "right"), minlength=10) / 400, 1e-4)
    assert got["x"]["psi"] == pytest.approx(((c - r) * np.log(c / r)).sum(), abs=1e-9)
    assert got["x"]["status"] == "alert"
    assert got["flat"]["psi"] == 0.0 and got["flat"]["status"] == "ok"


def test_empty_sides_give_no_verdict(spark):
    from cardwarden.operators.metrics import bias_variance
    from cardwarden.operators.stability import population_stability

    one_sided = spark.createDataFrame([("ref", 1.0, 1), ("ref", 2.0, 0)], "side string, x double, is_fraud int")
    row = target_drift(one_sided).first()
    assert row["p_value"] is None and row["drifted"] is None
    assert target_drift(one_sided.where("false")).first()["p_value"] is None
    row = population_stability(one_sided, ["x"]).first()
    assert row["psi"] is None and row["status"] == "no data"
    long = spark.createDataFrame([("m", "val", "auprc", 0.5)], "model string, split string, metric string, value double")
    assert bias_variance(long).first()["diagnosis"] is None


def test_buckets_cut_in_two_levels_keep_the_order_and_equal_values_together(spark):
    values = [None, float("nan"), *[float(i % 97) for i in range(1000)], *[5.0] * 500, -3.0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, x double")
    spark.conf.set("cardwarden.bucketsPerLevel", "4")
    try:
        rows = add_buckets(df, ["x"], 50).collect()
    finally:
        spark.conf.unset("cardwarden.bucketsPerLevel")
    known = [(r["x"], r["x_bucket"]) for r in rows if r["x"] is not None and r["x"] == r["x"]]
    assert len(rows) == len(values)
    bucket_of = dict(known)
    assert all(bucket_of[x] == b for x, b in known)
    ordered = [bucket_of[x] for x in sorted(bucket_of)]
    assert ordered == sorted(ordered)
    assert len(set(ordered)) > 20


def test_few_rows_are_sorted_when_nothing_moved(spark, monkeypatch):
    """Level-wise bounds leave some hundredths of the rows; the distance stays exact."""
    rng = np.random.default_rng(11)
    sides = {"ref": rng.normal(0, 1, 60_000), "cur": rng.normal(0, 1, 40_000)}
    # A feature with heavy ties and one that moved beside the one that did not.
    data = {s: {"same": x, "tied": np.round(x, 1), "moved": x + (0.3 if s == "cur" else 0.0)} for s, x in sides.items()}
    frames = [pd.DataFrame(columns).assign(side=s) for s, columns in data.items()]
    df = spark.createDataFrame(pd.concat(frames)).repartition(4)
    seen, whole = [], drift.narrow

    def recorded(*args, **kwargs):
        seen.append(whole(*args, **kwargs))
        return seen[-1]

    monkeypatch.setattr(drift, "narrow", recorded)
    spark.conf.set("cardwarden.rowsPerBucket", "500")
    try:
        names = ["same", "tied", "moved"]
        got = {r["feature"]: r for r in drift.ks_distances(df, names, ["ref", "cur"], [("ref", "cur")], 256).collect()}
    finally:
        spark.conf.unset("cardwarden.rowsPerBucket")
    for name in names:
        a, b = np.sort(data["ref"][name]), np.sort(data["cur"][name])
        at = np.concatenate([a, b])
        want = np.abs(np.searchsorted(a, at, "right") / len(a) - np.searchsorted(b, at, "right") / len(b)).max()
        assert got[name]["ks_ref_cur"] == pytest.approx(want, abs=1e-12)
    assert seen[0].total == 300_000 and seen[0].left <= 0.02 * seen[0].total
