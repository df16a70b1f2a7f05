import numpy as np
import pytest
from pyspark.sql import functions as F

from cardwarden.operators.history import apply_statistics, earlier_statistics, fit_statistics
from cardwarden.operators.group_stats import CARD
from cardwarden.schema import GROUP_STATS


@pytest.fixture(scope="module")
def ledger(spark):
    """One card owns half of the rows; several rows share a second; some rows have no card."""
    rng = np.random.default_rng(6)
    rows = []
    for i in range(400):
        card = "hot" if i % 2 else (None if i % 40 == 0 else f"c{i % 9}")
        rows.append((i, card, int(rng.integers(0, 90)), float(np.round(rng.exponential(50), 2)), int(rng.random() < 0.2)))
    return spark.createDataFrame(rows, "row_id long, cc_num string, unix_time long, amt double, is_fraud int"), rows


@pytest.mark.parametrize("slice_seconds, rows_per_task", [(7, 1), (1, 50), (1000, 1_000_000)])
def test_only_strictly_earlier_rows_count(ledger, slice_seconds, rows_per_task):
    df, rows = ledger
    out = earlier_statistics(
        df, "cc_num", spread_by=["row_id"], slice_seconds=slice_seconds, rows_per_task=rows_per_task
    )
    got = {r["row_id"]: r for r in out.collect()}
    assert len(got) == len(rows)
    for i, card, time, _, _ in rows:
        r = got[i]
        if card is None:
            assert r["prior_txn_count"] is None
            continue
        past = [x for x in rows if x[1] == card and x[2] < time]
        amounts = np.array([x[3] for x in past])
        assert r["prior_txn_count"] == len(past)
        if not past:
            assert r["prior_avg_amt"] is None and r["prior_std_amt"] == 0.0 and r["prior_fraud_rate"] == 0.0
            continue
        assert r["prior_avg_amt"] == pytest.approx(amounts.mean())
        assert r["prior_std_amt"] == pytest.approx(amounts.std(ddof=1) if len(past) > 1 else 0.0, abs=1e-9)
        assert r["prior_fraud_rate"] == pytest.approx(np.mean([x[4] for x in past]))


def test_later_rows_change_nothing(ledger):
    df, _ = ledger
    changed = df.withColumn("amt", F.when(F.col("unix_time") >= 50, F.col("amt") * 3).otherwise(F.col("amt")))
    columns = ["row_id", "prior_txn_count", "prior_fraud_rate"]
    before = earlier_statistics(df, "cc_num", spread_by=["row_id"]).where("unix_time <= 50")
    after = earlier_statistics(changed, "cc_num", spread_by=["row_id"]).where("unix_time <= 50")
    assert before.select(*columns).exceptAll(after.select(*columns)).count() == 0
    a = {r["row_id"]: r["prior_avg_amt"] for r in before.collect()}
    for r in after.collect():
        assert r["prior_avg_amt"] == (pytest.approx(a[r["row_id"]]) if a[r["row_id"]] is not None else None)


def test_fitted_statistics_use_defaults_for_new_keys(spark):
    schema = "row_id long, cc_num string, amt double, is_fraud int"
    train = spark.createDataFrame([(1, "a", 10.0, 1), (2, "a", 30.0, 0)], schema)
    # The unseen key is the hot one here.
    test = spark.createDataFrame([(3, "a", 1.0, 0), (5, None, 1.0, 0)] + [(i, "z", 1.0, 0) for i in range(10, 60)], schema)
    fitted = fit_statistics(train, (CARD,))
    for limits in ({}, {"broadcast_bytes": 0, "rows_per_task": 7}):
        out = apply_statistics(test, fitted, dict.fromkeys(GROUP_STATS, 7.0), ["row_id"], **limits)
        rows = out.orderBy("row_id").collect()
        assert len(rows) == 52 and out.columns[:4] == test.columns
        assert rows[0]["customer_avg_amt"] == 20.0 and rows[0]["customer_txn_count"] == 2.0
        assert {r["customer_avg_amt"] for r in rows[1:]} == {7.0}
