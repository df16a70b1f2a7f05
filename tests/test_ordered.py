import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cardwarden.operators import ordered
from cardwarden.operators.drift import feature_drift
from cardwarden.operators.metrics import roc_curve

TINY = {"cardwarden.rowsPerBucket": "40", "cardwarden.bucketsPerLevel": "4"}


@pytest.fixture
def tiny(spark):
    for k, v in TINY.items():
        spark.conf.set(k, v)
    yield spark
    for k in TINY:
        spark.conf.unset(k)


@pytest.mark.parametrize("most", [1, 2, 7, 8, 31, 100])
def test_borders_passed_are_counted(spark, most):
    rng = np.random.default_rng(most)
    rows = [(sorted(set(np.round(rng.normal(size=k), 1).tolist())), float(v)) for k in (0, 1, most // 2, most) for v in np.round(rng.normal(size=20), 1)]
    rows += [(None, 1.0), ([0.5], None)]
    df = spark.createDataFrame(rows, "b array<double>, v double")
    got = ordered.add_passed(df, {"n": ("b", F.col("v"))}, most).collect()
    assert [r["n"] for r in got] == [0 if b is None or v is None else sum(x <= v for x in b) for b, v in rows]


def test_pruning_begins_with_few_buckets_at_any_size(tiny):
    assert ordered.pruning_buckets(tiny.range(40)) == 1
    assert ordered.pruning_buckets(tiny.range(20_000)) == 4


def test_buckets_of_wanted_ranks_are_cut_until_few_rows_are_sorted(tiny, monkeypatch):
    rng = np.random.default_rng(3)
    values = {"smooth": rng.normal(size=20_000), "tied": np.round(rng.exponential(size=20_000), 0), "wide": np.exp(5 * rng.normal(size=20_000))}
    cuts, whole = [], ordered.cut_again

    def recorded(rows, cells):
        cuts.append(cells.where("several").agg(F.max("n")).first()[0])
        return whole(rows, cells)

    monkeypatch.setattr(ordered, "cut_again", recorded)
    fractions = [0.0, 0.1, 0.5, 0.93, 1.0]
    df = tiny.createDataFrame(pd.DataFrame(values))
    got = {(r["feature"], r["fraction"]): r["value"] for r in ordered.exact_quantiles(df, list(values), fractions).collect()}
    assert got == {(c, q): pytest.approx(np.quantile(v, q)) for c, v in values.items() for q in fractions}
    assert cuts and max(cuts) > 4_000


def test_curve_over_many_buckets_of_the_second_level(tiny):
    rng = np.random.default_rng(4)
    score, label = np.round(rng.normal(size=6_000), 3), rng.integers(0, 2, 6_000)
    df = tiny.createDataFrame(pd.DataFrame({"m": "a", "label": label, "score": score}))
    curve = roc_curve(df, ["m"])
    # No row looks at all borders of its bucket.
    assert "lambdafunction" not in curve._jdf.queryExecution().optimizedPlan().toString()
    got = {r["threshold"]: (r["fpr"], r["tpr"]) for r in curve.collect()}
    assert len(got) == len(set(score)) + 1
    for t in sorted(set(score))[::500]:
        hit = score >= t
        assert got[t] == pytest.approx((hit[label == 0].mean(), hit[label == 1].mean()))


def test_searches_are_not_repeated_in_conditions(tiny):
    df = tiny.range(400).select(*[(F.col("id") * (k + 1) % 397).cast("double").alias(f"c{k}") for k in range(3)])
    names = df.columns
    long = ordered.to_long(ordered.add_buckets(df, names, 4), [], names)
    cells = long.groupBy("feature", "bucket").agg(F.count(F.lit(1)).alias("n"))
    again = ordered.cut_again(long, cells)
    joined = again.join(F.broadcast(again.select("feature", "bucket").distinct()), ["feature", "bucket"], "left_semi")
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert joined.count() == 1200 and plan.count("_cuts") < 60


def test_distances_over_few_buckets_to_begin_with(tiny):
    rng = np.random.default_rng(6)
    a, b = rng.normal(size=3_000), rng.normal(0.02, 1, 2_000)
    rows = pd.concat([pd.DataFrame({"x": a, "side": "ref"}), pd.DataFrame({"x": b, "side": "cur"})])
    found = feature_drift(tiny.createDataFrame(rows), ["x"]).first()["statistic"]
    at = np.concatenate([a, b])
    want = np.abs(np.searchsorted(np.sort(a), at, "right") / 3_000 - np.searchsorted(np.sort(b), at, "right") / 2_000).max()
    assert found == pytest.approx(want, abs=1e-12)
