"""Penalised leaf values against a plain recomputation."""

import math

import pytest
from pyspark.sql import functions as F

from cardwarden.operators.leaf_values import leaf_table, newton_value, objective, with_leaf_values
from cardwarden.operators.models import fit_trees
from cardwarden.operators.scoring import positive_probability

PLAIN = {"n_estimators": 5, "learning_rate": 0.3, "num_leaves": 8, "subsample": 1.0, "colsample_bytree": 1.0,
         "min_child_samples": 5, "reg_lambda": 0.0, "reg_alpha": 0.0}


@pytest.fixture(scope="module")
def rows(spark):
    a, b = F.rand(3), F.rand(4)
    df = spark.range(1500).select("id", a.alias("a"), b.alias("b"))
    y = (F.col("a") + F.col("b") + F.rand(5) * 0.3 > 1.4).cast("double")
    return df.withColumn("is_fraud", y).withColumn("w", 1 + F.col("id") % 3).repartition(3).cache()


@pytest.fixture(scope="module")
def shape(rows):
    return fit_trees(rows, ["a", "b"], PLAIN)


@pytest.mark.parametrize("l1, l2, block", [(0.0, 1.0, 16), (5.0, 3.0, 2), (1e9, 0.0, 16)])
def test_values_and_model_agree_with_plain_boosting(rows, shape, l1, l2, block):
    leaves, start = leaf_table(rows, shape, "is_fraud", "w", 0.3, l1, l2, block)
    data = rows.orderBy("id").collect()
    marked = shape.stages[-1].copy()._set(leafCol="leaves")
    placed = marked.transform(shape.stages[0].transform(rows)).orderBy("id").select("leaves").collect()
    weights = sum(r.w for r in data if r.is_fraud), sum(r.w for r in data if not r.is_fraud)
    assert start == pytest.approx(math.log(weights[0] / weights[1]))
    margin, want = [start] * len(data), {}
    for tree in range(5):
        sums = {}
        for r, p, m in zip(data, placed, margin):
            q = 1 / (1 + math.exp(-m))
            g, h = sums.get(int(p.leaves[tree]), (0.0, 0.0))
            sums[int(p.leaves[tree])] = g + r.w * (q - r.is_fraud), h + r.w * q * (1 - q)
        for leaf, (g, h) in sums.items():
            want[tree, leaf] = 0.3 * newton_value(g, h, l1, l2)
        margin = [m + want[tree, int(p.leaves[tree])] for m, p in zip(margin, placed)]
    got = {(r.tree, r.leaf): r.value for r in leaves.collect()}
    assert got == pytest.approx(want, abs=1e-9)
    model = with_leaf_values(shape, leaves, start)
    scored = model.transform(rows).orderBy("id").select(positive_probability().alias("p")).collect()
    assert [r.p for r in scored] == pytest.approx([1 / (1 + math.exp(-m)) for m in margin], abs=1e-9)
    steps = objective(leaves).orderBy("tree").collect()
    assert all(r.step <= 0 and r.rows == 1500 for r in steps)
    if l1 < 1e9:
        assert all(x.loss > y.loss for x, y in zip(steps, steps[1:]))
    else:
        assert set(got.values()) == {0.0}


def test_penalties_shrink(rows):
    def spread(**penalty):
        model = fit_trees(rows, ["a", "b"], {**PLAIN, **penalty})
        return model.transform(rows).select(F.stddev(positive_probability())).first()[0]

    assert spread(reg_lambda=1.0) > spread(reg_lambda=300.0) > 0
    assert spread(reg_alpha=1e9) == pytest.approx(0.0, abs=1e-12)


def test_step_is_the_minimum():
    def cost(v, g, h, l1, l2):
        return g * v + (h + l2) * v * v / 2 + l1 * abs(v)

    for g, h, l1, l2 in [(4.0, 2.0, 1.0, 3.0), (-7.0, 0.5, 2.0, 0.0), (0.5, 1.0, 1.0, 1.0)]:
        v = newton_value(g, h, l1, l2)
        assert all(cost(v, g, h, l1, l2) <= cost(v + d, g, h, l1, l2) for d in (-1e-3, 1e-3, -0.5, 0.5))
