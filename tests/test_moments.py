"""Point-in-time moments with missing amounts and large offsets, in batch and over micro-batches."""

import numpy as np
import pytest

from cardwarden.operators.history import earlier_statistics
from cardwarden.session import scratch_path
from cardwarden.streaming.transactions import stream_history

SCHEMA = "trans_num string, cc_num string, unix_time long, amt double, is_fraud int"


def expected(rows):
    out = {}
    for name, card, time, _, _ in rows:
        past = [r for r in rows if r[1] == card and r[2] < time]
        amounts = np.array([r[3] for r in past if r[3] is not None])
        labels = [r[4] for r in past if r[4] is not None]
        out[name] = (
            len(past), amounts.mean() if len(amounts) else None,
            amounts.std(ddof=1) if len(amounts) > 1 else 0.0, float(np.mean(labels)) if labels else 0.0,
        )
    return out


ROWS = [
    ("a", "x", 1, None, 1), ("b", "x", 2, None, 1), ("c", "x", 3, 5.0, 0), ("d", "x", 4, 7.0, None),
    ("e", "y", 1, 1e8, 0), ("f", "y", 2, 1e8 + 1, 0), ("g", "y", 3, 1e8 + 2, 1), ("h", "y", 4, 1e8, 0),
    ("i", "x", 100_000, 6.0, 0), ("j", "y", 200_000, 3.0, 0), ("k", "y", 300_000, 3.0, 0),
]


def check(got, rows):
    want = expected(rows)
    assert len(got) == len(rows)
    for r in got:
        n, mean, deviation, rate = want[r["trans_num"]]
        assert r["prior_txn_count"] == n, r
        assert r["prior_avg_amt"] == (None if mean is None else pytest.approx(mean, rel=1e-12)), r
        assert r["prior_std_amt"] == pytest.approx(deviation, rel=1e-6, abs=1e-6), r
        assert r["prior_fraud_rate"] == pytest.approx(rate), r


@pytest.mark.parametrize("slice_seconds", [2, 86_400])
def test_batch(spark, slice_seconds):
    df = spark.createDataFrame(ROWS, SCHEMA)
    check(earlier_statistics(df, "cc_num", slice_seconds=slice_seconds).collect(), ROWS)


def test_three_micro_batches(spark):
    source, output, state, checkpoint = (scratch_path(spark, n) for n in ("in", "out", "state", "cp"))
    rows = sorted(ROWS, key=lambda r: r[2])
    cuts = [rows[:4], rows[4:8], rows[8:]]
    for some in cuts:  # in order of time, so that batches and times agree
        spark.createDataFrame(some, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(SCHEMA).parquet(source)
        stream_history(stream, "cc_num", output, state, checkpoint)
    got = spark.read.parquet(output)
    assert got.select("batch").distinct().count() == 3
    check_rows = {r["trans_num"]: r for r in got.collect()}
    # Rows of one second that fall into different batches see each other.
    want = expected(rows)
    for name in ("i", "j", "k"):
        assert check_rows[name]["prior_std_amt"] == pytest.approx(want[name][2], rel=1e-6)
        assert check_rows[name]["prior_txn_count"] == want[name][0]
