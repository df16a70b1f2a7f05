from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import cardwarden.operators.splitting as splitting
from cardwarden.operators.splitting import (
    fit_split,
    hash_split,
    proportional_shares,
    split_sizes,
    stratified_sample,
    with_folds,
    with_split,
)


@pytest.fixture(scope="module")
def labelled(spark):
    return spark.range(300).select(
        F.col("id").alias("row_id"), (F.col("id") % 20 == 0).cast("int").alias("is_fraud")
    ).cache()


def test_published_sizes():
    assert split_sizes(1_852_394, 0.2, 0.1) == (1_296_675, 185_240, 370_479)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 1000), min_size=1, max_size=5), st.data())
def test_shares_add_up_and_stay_proportional(sizes, data):
    counts = dict(enumerate(sizes))
    total = sum(sizes)
    wanted = data.draw(st.integers(0, total))
    shares = proportional_shares(counts, wanted)
    assert sum(shares.values()) == wanted
    for c, n in counts.items():
        assert abs(shares[c] - n * wanted / total) < 1
        assert 0 <= shares[c] <= n


def test_split_is_an_exact_stratified_partition(labelled):
    rows = with_split(labelled, fit_split(labelled, ["row_id"])).collect()
    by_split = Counter(r["split"] for r in rows)
    assert by_split == {"train": 210, "val": 30, "test": 60}
    positives = Counter(r["split"] for r in rows if r["is_fraud"])
    assert positives["test"] == 3 and 1 <= positives["val"] <= 2
    assert sum(positives.values()) == 15


def test_split_without_strata_and_independent_of_partitioning(labelled):
    one = with_split(labelled.coalesce(1), fit_split(labelled.coalesce(1), ["row_id"]))
    many = with_split(labelled.repartition(7), fit_split(labelled.repartition(7), ["row_id"]))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect()))
    plain = with_split(labelled, fit_split(labelled, ["row_id"], stratify=False))
    assert Counter(r["split"] for r in plain.collect()) == {"train": 210, "val": 30, "test": 60}


def test_narrowing_over_several_digit_groups(labelled, monkeypatch):
    wanted = sorted(map(tuple, with_split(labelled, fit_split(labelled, ["row_id"])).collect()))
    monkeypatch.setattr(splitting, "_SMALL_RANGE", 0)
    got = sorted(map(tuple, with_split(labelled, fit_split(labelled, ["row_id"])).collect()))
    assert got == wanted


def test_hash_split_close_to_sizes(spark):
    df = spark.range(20_000).withColumnRenamed("id", "row_id")
    share = {r["split"]: r["count"] / 20_000 for r in hash_split(df, ["row_id"]).groupBy("split").count().collect()}
    assert share["test"] == pytest.approx(0.2, abs=0.015)
    assert share["val"] == pytest.approx(0.1, abs=0.015)


def test_sample_has_exact_class_sizes(labelled):
    rows = stratified_sample(labelled, ["row_id"], 0.5).collect()
    assert Counter(r["is_fraud"] for r in rows) == {0: round(0.5 * 285), 1: round(0.5 * 15)}
    assert len({r["row_id"] for r in rows}) == len(rows)


@pytest.mark.parametrize("folds", [3, 5])
def test_folds_are_level(labelled, folds):
    rows = with_folds(labelled, ["row_id"], folds).collect()
    total = Counter(r["fold"] for r in rows)
    positive = Counter(r["fold"] for r in rows if r["is_fraud"])
    assert set(total) == set(range(folds)) and sum(total.values()) == 300
    assert max(total.values()) - min(total.values()) <= 1
    assert max(positive.values()) - min(positive.values()) <= 1


def test_text_labels(spark):
    df = spark.range(100).select(
        F.col("id").alias("row_id"), F.when(F.col("id") < 30, "a").otherwise("b").alias("kind")
    )
    rows = stratified_sample(df, ["row_id"], 0.1, label="kind").collect()
    assert Counter(r["kind"] for r in rows) == {"a": 3, "b": 7}


def test_rows_without_a_label_belong_to_no_split(spark):
    df = spark.range(20).selectExpr("id AS row_id", "if(id = 3, NULL, cast(id % 2 AS int)) AS is_fraud")
    with pytest.raises(ValueError, match="no split"):
        fit_split(df, ["row_id"])


def test_a_label_with_very_many_values_is_refused(spark):
    df = spark.range(1500).selectExpr("id AS row_id", "id AS is_fraud")
    with pytest.raises(ValueError, match="no label"):
        fit_split(df, ["row_id"])
