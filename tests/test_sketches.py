"""Daily summaries with sketches: united results against one exact pass."""

import pytest
from pyspark.sql import functions as F

from cardwarden.catalog.base import transactions
from cardwarden.operators.sketches import KEYS, daily_summaries, read_days, relative_errors, store_days, unite_summaries
from cardwarden.operators.summaries import dataset_summary


@pytest.fixture(scope="module")
def txn(spark):
    """More cards than registers, so that the sketches have to estimate."""
    return transactions(spark, "/root/testdata/sf0.01").withColumn("cc_num", F.concat("cc_num", F.lit("-"), F.col("row_id").cast("string")))


def test_united_days_equal_one_pass(spark, txn, tmp_path):
    path = str(tmp_path / "days")
    store_days(daily_summaries(txn, ["category"]), path)
    exact = dataset_summary(txn, ["category"])
    united = unite_summaries(read_days(spark, path), ["category"])
    assert united.columns == exact.columns
    plain = [c for c in exact.columns if c not in KEYS.values()]
    for got, want in zip(*(d.select(plain).orderBy("category").collect() for d in (united, exact))):
        assert [g if not isinstance(g, float) else pytest.approx(g) for g in got] == list(want)
    errors = relative_errors(united, exact, ["category"]).collect()
    assert len(errors) == 3 * exact.count() and max(r["error"] for r in errors) < 0.03


def test_a_day_is_replaced_and_others_stay(spark, txn, tmp_path):
    path = str(tmp_path / "days")
    store_days(daily_summaries(txn), path)
    before = {r["day"]: r["rows"] for r in read_days(spark, path).collect()}
    day = sorted(before)[1]
    one = txn.where(F.to_date("trans_date_trans_time") == F.lit(day))
    # Written twice: nothing is counted twice.
    for _ in range(2):
        store_days(daily_summaries(one.unionByName(one)), path)
    after = {r["day"]: r["rows"] for r in read_days(spark, path).collect()}
    assert after == {**before, day: 2 * before[day]}
    some = read_days(spark, path, str(day), str(day))
    assert [r["day"] for r in some.collect()] == [day]
    assert "PartitionFilters: [isnotnull(day" in some._jdf.queryExecution().executedPlan().toString()


def test_missing_values_and_empty_tables(spark):
    columns = "trans_date_trans_time string, cc_num string, merchant string, category string, amt double, is_fraud int"
    rows = [("2019-01-01 00:00:00", "1", None, "a", None, None), (None, None, None, None, 2.0, 1), ("nonsense", "1", "m", "a", 4.0, 0)]
    df = spark.createDataFrame(rows, columns)
    row = unite_summaries(daily_summaries(df)).first()
    assert (row["rows"], row["fraud_rows"], row["fraud_rate"], row["amt_mean"]) == (3, 1, 0.5, 3.0)
    assert (row["unique_cards"], row["unique_merchants"], row["unique_categories"]) == (1, 1, 1)
    assert daily_summaries(df.where("false")).count() == 0
