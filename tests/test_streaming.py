import pytest
from pyspark.sql import functions as F

from cardwarden.operators.features import flag
from cardwarden.operators.history import earlier_statistics
from cardwarden.operators.group_stats import customer_statistics
from cardwarden.sources.events import table, transactions
from cardwarden.streaming.transactions import (
    deduplicated,
    file_stream,
    history_folders,
    latest_state,
    outcome_windows,
    p95_windows,
    run_available,
    running_card_statistics,
    stream_history,
    write_updates,
)


@pytest.fixture(scope="module")
def pieces(spark, sf_dir, tmp_path_factory):
    """The transactions in three files, in time order, one file per micro-batch."""
    folder = tmp_path_factory.mktemp("pieces")
    txn = transactions(spark, sf_dir).cache()
    low, high = txn.approxQuantile("unix_time", [0.3, 0.7], 0.0)
    for i, part in enumerate(
        [f"unix_time < {low}", f"unix_time >= {low} AND unix_time < {high}", f"unix_time >= {high}"]
    ):
        txn.where(part).coalesce(1).write.parquet(str(folder / f"p{i}"))
    names = sorted(p for d in sorted(folder.iterdir()) for p in d.glob("*.parquet"))
    flat = tmp_path_factory.mktemp("flat")
    for i, p in enumerate(names):
        (flat / f"{i}.parquet").write_bytes(p.read_bytes())
        # Files are taken in order of their modification time.
        import os

        os.utime(flat / f"{i}.parquet", (1_700_000_000 + i, 1_700_000_000 + i))
    return txn, str(flat)


def stream(spark, pieces, files=1):
    txn, folder = pieces
    return file_stream(spark, folder, txn.schema, "*.parquet", files)


def test_state_is_one_snapshot_and_few_logs():
    assert history_folders("s", 0, 3) == []
    assert history_folders("s", 2, 3) == ["s/log/batch=0", "s/log/batch=1"]
    assert history_folders("s", 3, 3) == ["s/snapshot/before=3"]
    assert history_folders("s", 100, 3) == ["s/snapshot/before=99", "s/log/batch=99"]
    assert all(len(history_folders("s", n, 16)) <= 16 for n in range(200))


@pytest.mark.parametrize("compact_every", [1, 2, 16])
def test_history_along_the_stream_equals_the_batch(spark, pieces, tmp_path, compact_every):
    """Whatever of the state is in a snapshot."""
    txn, _ = pieces
    out = str(tmp_path / "out")
    stream_history(
        stream(spark, pieces), "cc_num", out, str(tmp_path / "state"), str(tmp_path / "cp"),
        keep=["row_id"], spread_by=["row_id"], compact_every=compact_every,
    )
    snapshots = sorted(p.name for p in (tmp_path / "state" / "snapshot").glob("*"))
    assert snapshots == [f"before={n}" for n in range(compact_every, 4, compact_every)]
    stored = spark.read.parquet(out)
    assert stored.select("batch").distinct().count() == 3
    got = {r["row_id"]: r for r in stored.collect()}
    columns = ["prior_txn_count", "prior_avg_amt", "prior_std_amt", "prior_fraud_rate"]
    for r in earlier_statistics(txn, "cc_num", spread_by=["row_id"]).collect():
        for c in columns:
            want = r[c]
            assert got[r["row_id"]][c] == (want if want is None else pytest.approx(want, abs=1e-6)), c


def test_running_statistics_end_at_the_batch_result(spark, pieces, tmp_path):
    txn, _ = pieces
    write_updates(running_card_statistics(stream(spark, pieces)), str(tmp_path / "u"), str(tmp_path / "cp"))
    updates = spark.read.parquet(str(tmp_path / "u"))
    final = {r["cc_num"]: r for r in latest_state(updates, "cc_num").collect()}
    assert updates.count() > len(final)
    for r in customer_statistics(txn).collect():
        for c in ("customer_txn_count", "customer_avg_amt", "customer_std_amt", "customer_fraud_rate"):
            assert final[r["cc_num"]][c] == pytest.approx(r[c], abs=1e-9)


def test_windows_hold_every_closed_row(spark, sf_dir, tmp_path):
    schema = table(spark, sf_dir, "events").schema
    events = file_stream(spark, sf_dir, schema, "events.parquet").select(
        F.col("ts").cast("timestamp").alias("ts"), "value", (F.col("value") > 100).alias("is_fraud")
    )
    run_available(outcome_windows(events, delay="2 hours"), str(tmp_path / "o"), str(tmp_path / "c1"))
    run_available(p95_windows(events, "value", delay="2 hours"), str(tmp_path / "p"), str(tmp_path / "c2"))
    counts, p95 = spark.read.parquet(str(tmp_path / "o")), spark.read.parquet(str(tmp_path / "p"))
    batch = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    limit = batch.agg(F.max("ts")).first()[0]
    closed = batch.where((F.date_trunc("day", "ts") + F.expr("INTERVAL 1 DAY")) <= F.lit(limit) - F.expr("INTERVAL 2 HOURS"))
    assert counts.agg(F.sum("predictions")).first()[0] == closed.count()
    assert counts.where("outcome = 'fraud'").agg(F.sum("predictions")).first()[0] == closed.agg(
        F.sum(flag(F.col("value") > 100))
    ).first()[0]
    assert p95.agg(F.sum("observations")).first()[0] == closed.count()


def test_repeated_deliveries_are_dropped(spark, pieces, tmp_path):
    txn, _ = pieces
    rows = stream(spark, pieces, 3).withColumn("ts", F.timestamp_seconds("unix_time"))
    run_available(deduplicated(rows.unionByName(rows)).select("trans_num"), str(tmp_path / "d"), str(tmp_path / "cp"))
    got = spark.read.parquet(str(tmp_path / "d"))
    assert got.count() == got.distinct().count() == txn.count()


def test_a_stream_with_an_interval_keeps_running(spark, pieces, tmp_path):
    txn, _ = pieces
    out = str(tmp_path / "out")
    query = run_available(
        stream(spark, pieces).select("row_id"), out, str(tmp_path / "cp"), every="1 second"
    )
    try:
        query.processAllAvailable()
        assert query.isActive
        assert spark.read.parquet(out).count() == txn.count()
    finally:
        query.stop()
