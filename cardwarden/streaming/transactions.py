"""Structured Streaming over transactions: scoring, outcome windows, running card statistics."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from cardwarden.operators.history import (
    MOMENTS,
    added,
    earlier_moments,
    merged_sums,
    moment_statistics,
    moment_sums,
)
from cardwarden.operators.keyed_join import attach
from cardwarden.operators.scoring import score_requests
from cardwarden.operators.summaries import bucket_of
from cardwarden.operators.validation import Rule, request_rules, with_reasons
from cardwarden.schema import LABEL


def file_stream(
    spark: SparkSession, folder: str, schema: T.StructType, name_filter: str, files_per_trigger: int | None = None
) -> DataFrame:
    """A Parquet folder as a stream; only files matching ``name_filter`` belong to it."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", name_filter)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def start(writer: DataStreamWriter, every: str | None = None) -> StreamingQuery:
    """Without ``every`` all that is there is processed before this returns. Otherwise the query keeps running,
    one micro-batch per interval (such as ``"10 seconds"``), and the caller stops it."""
    if every is not None:
        return writer.trigger(processingTime=every).start()
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def run_available(df: DataFrame, path: str, checkpoint: str, mode: str = "append", every: str | None = None) -> StreamingQuery:
    """Append a stream to a Parquet folder, exactly once; ``every`` as in :func:`start`."""
    writer = (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode(mode)
    )
    return start(writer, every)


def score_stream(
    requests: DataFrame,
    model: PipelineModel,
    defaults: dict[str, float],
    output: str,
    rejected: str,
    checkpoint: str,
    threshold: float = 0.5,
    rules: list[Rule] | None = None,
    keep: list[str] | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Score valid requests and set invalid ones aside with their reasons.

    Both outputs of a micro-batch are written below its batch number, so a batch that is repeated
    after a failure replaces itself.
    """
    checks = rules or request_rules()
    kept = keep or ["trans_num"]

    def write_batch(batch: DataFrame, number: int) -> None:
        checked = with_reasons(batch, checks).persist()
        try:
            good = checked.where("valid").drop("valid", "reasons")
            scored = score_requests(good, model, defaults, threshold, kept)
            scored.write.mode("overwrite").parquet(f"{output}/batch={number}")
            bad = checked.where("NOT valid").drop("valid")
            bad.write.mode("overwrite").parquet(f"{rejected}/batch={number}")
        finally:
            checked.unpersist()

    writer = (
        requests.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
    )
    return start(writer, every)


def outcome_windows(
    decisions: DataFrame, time: str = "ts", window: str = "1 day", delay: str = "1 hour"
) -> DataFrame:
    """Predictions per outcome and tumbling event-time window; late rows beyond ``delay`` drop out."""
    outcome = F.when(F.col("is_fraud"), F.lit("fraud")).otherwise(F.lit("legit"))
    return (
        decisions.withWatermark(time, delay)
        .groupBy(F.window(time, window), outcome.alias("outcome"))
        .agg(F.count(F.lit(1)).alias("predictions"))
        .select(F.col("window.start").alias("window_start"), "outcome", "predictions")
    )


def p95_windows(
    df: DataFrame, value: str, time: str = "ts", window: str = "1 day", delay: str = "1 hour", accuracy: int = 10000
) -> DataFrame:
    """95th percentile of a value per tumbling event-time window, from a mergeable sketch."""
    return (
        df.withWatermark(time, delay)
        .groupBy(F.window(time, window))
        .agg(F.percentile_approx(value, 0.95, accuracy).alias("p95"), F.count(F.lit(1)).alias("observations"))
        .select(F.col("window.start").alias("window_start"), "p95", "observations")
    )


def histogram_windows(
    df: DataFrame, value: str, bounds: list[float], time: str = "ts", window: str = "1 day", delay: str = "1 hour"
) -> DataFrame:
    """Observations per bucket and closed event-time window; state is one counter per bucket. Quantiles come from the
    written counts, of one window or of many together, by ``histogram_quantile``."""
    some = df.where(F.col(value).isNotNull()).withColumn("le", bucket_of(F.col(value).cast("double"), bounds))
    counted = some.withWatermark(time, delay).groupBy(F.window(time, window), "le").agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.col("window.start").alias("window_start"), "le", "n")


def deduplicated(df: DataFrame, key: str = "trans_num", time: str = "ts", delay: str = "1 hour") -> DataFrame:
    """Repeated deliveries of a transaction removed, with state bounded by the delay."""
    return df.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def running_card_statistics(df: DataFrame, amount: str = "amt", label: str = LABEL) -> DataFrame:
    """Statistics per card over everything seen so far.

    The built-in aggregation combines a micro-batch's rows per card before the shuffle, so a card
    with most of the traffic costs one partial row per task; the state is one row per card.
    """
    return df.groupBy("cc_num").agg(
        F.count(F.lit(1)).alias("customer_txn_count"),
        F.avg(amount).alias("customer_avg_amt"),
        F.coalesce(F.stddev_samp(amount), F.lit(0.0)).alias("customer_std_amt"),
        F.coalesce(F.avg(label), F.lit(0.0)).alias("customer_fraud_rate"),
    )


def write_updates(df: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Changed rows of every micro-batch, below the batch number."""

    def write_batch(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = (
        df.writeStream.foreachBatch(write_batch)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
    )
    return start(writer, every)


def history_folders(state: str, number: int, compact_every: int) -> list[str]:
    """Folders that together hold the moments of all batches before ``number``: the latest snapshot and the logs since."""
    base = number // compact_every * compact_every
    snapshot = [f"{state}/snapshot/before={base}"] if base else []
    return snapshot + [f"{state}/log/batch={i}" for i in range(base, number)]


def stream_history(
    transactions: DataFrame,
    key: str,
    output: str,
    state: str,
    checkpoint: str,
    prefix: str = "prior",
    keep: list[str] | None = None,
    spread_by: list[str] | None = None,
    every: str | None = None,
    compact_every: int = 16,
) -> StreamingQuery:
    """Statistics of a key's earlier transactions for every row of a stream.

    A row sees the strictly earlier rows of its own micro-batch and all rows of earlier batches.
    Earlier batches count as the past, whatever the times of their rows.
    The state is one row of moments per key in a snapshot, written anew after every ``compact_every`` batches, and a log
    per batch since then: a batch reads one snapshot and fewer than ``compact_every`` logs, however long the stream has
    run, and merges as many entries per key. Output, log and snapshot of a batch are written below its number and only
    lower numbers are read, so a repeated batch gives the same result.
    """
    spark = transactions.sparkSession
    kept = keep or ["trans_num"]
    schema = f"{key} string, n bigint, k bigint, mean double, m2 double, l bigint, p bigint"

    def stored(number: int) -> DataFrame:
        folders = history_folders(state, number, compact_every)
        return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)

    def write_batch(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        try:
            own = batch.where(F.col(key).isNotNull()).groupBy(key).agg(*moment_sums(F.col("amt")))
            own.write.mode("overwrite").parquet(f"{state}/log/batch={number}")
            own = spark.read.schema(schema).parquet(f"{state}/log/batch={number}")
            past = stored(number).groupBy(key).agg(*merged_sums()).select(key, *[F.col(m).alias(f"past_{m}") for m in MOMENTS])
            now = own.select(key, F.col("n").alias("_rows"))
            # Only keys of this batch, with their row counts for the skew-safe join.
            known = now.join(past, key, "left")
            rows = earlier_moments(batch, key, spread_by=spread_by)
            joined = attach(rows, known, [key], "_rows", spread_by or ["trans_num"])
            total = added([F.coalesce(f"past_{m}", F.lit(0)) for m in MOMENTS], [F.col(m) for m in MOMENTS])
            stats = moment_statistics(*total, prefix)
            joined.select(*kept, *[c.alias(n) for n, c in stats.items()]).write.mode(
                "overwrite"
            ).parquet(f"{output}/batch={number}")
            if (number + 1) % compact_every == 0:
                folders = [*history_folders(state, number, compact_every), f"{state}/log/batch={number}"]
                merged = spark.read.schema(schema).parquet(*folders).groupBy(key).agg(*merged_sums())
                merged.write.mode("overwrite").parquet(f"{state}/snapshot/before={number + 1}")
        finally:
            batch.unpersist()

    writer = (
        transactions.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
    )
    return start(writer, every)


def latest_state(updates: DataFrame, key: str) -> DataFrame:
    """The last row written per key."""
    values = [c for c in updates.columns if c not in (key, "batch")]
    return (
        updates.groupBy(key)
        .agg(F.max_by(F.struct(*values), F.col("batch")).alias("v"))
        .select(key, "v.*")
    )
