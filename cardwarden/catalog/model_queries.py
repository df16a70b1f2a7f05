"""Model fitting, tuning, batch scoring and streaming queries.

Registered fits use few iterations; the defaults of the library are those of the contract.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardwarden.catalog.base import KEY, RAW, TXN, query, raw_transactions, rounded, split_sql, table, transactions
from cardwarden.catalog.feature_queries import _BOUNDS, earlier_sql, histogram_sql
from cardwarden.catalog.ingest import _REASON_LIST
from cardwarden.operators.halving import successive_halving
from cardwarden.operators.leaf_values import leaf_table, objective
from cardwarden.operators.models import (
    feature_importance,
    fit_logistic,
    fit_trees,
    load_model,
    logistic_coefficients,
    logistic_gradient,
    save_model,
)
from cardwarden.operators.scoring import collect_defaults, decide, score_requests
from cardwarden.operators.splitting import stratified_sample, with_folds
from cardwarden.operators.summaries import histogram_quantile, serving_defaults
from cardwarden.operators.tuning import (
    LOGISTIC_CV_SPACE,
    LOGISTIC_SPACE,
    TREE_CV_SPACE,
    TREE_SPACE,
    cross_validate_logistic,
    cross_validate_trees,
    draw_parameters,
)
from cardwarden.operators.validation import request_rules
from cardwarden.plans.prepare import settled_features
from cardwarden.plans.train import LOGISTIC, TREES, evaluate_saved, train_and_save, train_models, training_job
from cardwarden.plans.promote import promote
from cardwarden.plans.score import score_job
from cardwarden.plans.tune import tune, tune_one
from cardwarden.schema import numeric_features
from cardwarden.session import scratch_path, settle_table
from cardwarden.sources.events import project_transactions
from cardwarden.sources.run_documents import read_part
from cardwarden.sources.split_files import train_val_pool
from cardwarden.streaming.transactions import (
    deduplicated,
    file_stream,
    histogram_windows,
    latest_state,
    outcome_windows,
    p95_windows,
    run_available,
    running_card_statistics,
    score_stream,
    stream_history,
    write_updates,
)

#: Largest entry of the gradient at the end of a fit (the solver stops at a relative change of 1e-6).
GRADIENT_TOLERANCE = 1e-4

SMALL_TREES = {"n_estimators": 5, "learning_rate": 0.3, "num_leaves": 8, "subsample": 1.0, "colsample_bytree": 1.0}
SMALL_LOGISTIC_SPACE = {**LOGISTIC_SPACE, "max_iter": (50, 100, 50)}
SMALL_TREE_SPACE = {**TREE_SPACE, "n_estimators": (2, 4, 1), "num_leaves": (4, 16, 4)}
SMALL_TREE_CV_SPACE = {**TREE_CV_SPACE, "n_estimators": (2, 3, 1), "max_depth": (3, 4, 1), "num_leaves": (10, 15, 5)}


def features(spark, sf_dir) -> DataFrame:
    return settled_features(transactions(spark, sf_dir), KEY)


@query("logistic_fit")
def logistic_fit(spark, sf_dir):
    df = features(spark, sf_dir)
    names = numeric_features(df)
    model = fit_logistic(df.where("split = 'train'"), names, {"max_iter": 100})
    return rounded(logistic_coefficients(model, names, df))


@query(
    "logistic_gradient",
    f"""WITH {TXN}, n AS (SELECT count(*) AS rows FROM (SELECT {split_sql()} AS split FROM txn) WHERE split = 'train')
SELECT CAST(29 AS BIGINT) AS entries, true AS at_minimum FROM n WHERE rows > 0""",
)
def logistic_gradient_norm(spark, sf_dir):
    """Whether the objective's gradient is zero at the fit with the full number of iterations: no other solver needed."""
    df = features(spark, sf_dir)
    names, train = numeric_features(df), df.where("split = 'train'")
    gradient = logistic_gradient(train, names, fit_logistic(train, names))
    return gradient.agg(F.count(F.lit(1)).alias("entries"), (F.max(F.abs("gradient")) < GRADIENT_TOLERANCE).alias("at_minimum"))


@query("gbt_fit")
def gbt_fit(spark, sf_dir):
    """Training rows by label and decision of a small boosted model."""
    df = features(spark, sf_dir)
    model = fit_trees(df.where("split = 'train'"), numeric_features(df), SMALL_TREES)
    return model.transform(df).groupBy("split", "is_fraud", "prediction").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "tree_leaf_values",
    f"""WITH {TXN}, n AS (SELECT count(*) AS rows FROM (SELECT {split_sql()} AS split FROM txn) WHERE split = 'train')
SELECT CAST(t AS INT) AS tree, rows, true AS values_fit, true AS step_helps, true AS loss_falls FROM n, range(5) r(t)""",
)
def tree_leaf_values(spark, sf_dir):
    """Leaves of a penalised fit, from their stored table: every value is the penalised minimum, shrunk; no step raises
    its tree's objective; the loss before a tree is below that before the tree before it."""
    df = features(spark, sf_dir)
    names = numeric_features(df)
    train = df.where("split = 'train'").withColumn("unit", F.lit(1.0))
    shape = fit_trees(train, names, {**SMALL_TREES, "reg_lambda": 0.0})
    leaves, _ = leaf_table(train, shape, "is_fraud", "unit", SMALL_TREES["learning_rate"], 2.0, 3.0)
    leaves = settle_table(leaves, "leaf-values")
    expected = F.expr("-learning_rate * sign(gradient) * greatest(abs(gradient) - l1, 0) / (curvature + l2)")
    fits = leaves.groupBy("tree").agg(F.bool_and(F.abs(F.col("value") - expected) < 1e-9).alias("values_fit"))
    steps = objective(leaves).join(fits, "tree")
    before = F.lag("loss").over(Window.orderBy("tree"))  # one row per tree
    return steps.select(
        "tree", "rows", "values_fit", (F.col("step") <= 0).alias("step_helps"), F.coalesce(F.col("loss") < before, F.lit(True)).alias("loss_falls")
    )


@query("feature_importance")
def importance(spark, sf_dir):
    df = features(spark, sf_dir)
    names = numeric_features(df)
    return rounded(feature_importance(fit_trees(df.where("split = 'train'"), names, SMALL_TREES), names, df))


@query("train_compare")
def train_compare(spark, sf_dir):
    """Both models on all splits, with the choice beside them."""
    t = train_models(features(spark, sf_dir), {"max_iter": 50}, SMALL_TREES)
    return rounded(t.metrics.withColumn("is_best", F.col("model") == F.lit(t.best)))


@query("evaluate_saved")
def evaluate_from_disk(spark, sf_dir):
    df = features(spark, sf_dir)
    path = scratch_path(spark, "model")
    train_and_save(df, path, logistic_params={"max_iter": 50}, tree_params=SMALL_TREES)
    metrics, gaps = evaluate_saved(df, path)
    return rounded(metrics.join(gaps.select("model", "diagnosis"), "model"))


@query("tune_logistic")
def tune_logistic(spark, sf_dir):
    trials, _ = tune_one(features(spark, sf_dir), LOGISTIC, 3, SMALL_LOGISTIC_SPACE)
    return rounded(trials.withColumn("params", F.to_json("params")))


@query("tune_gbt")
def tune_gbt(spark, sf_dir):
    trials, _ = tune_one(features(spark, sf_dir), TREES, 2, SMALL_TREE_SPACE)
    return rounded(trials.withColumn("params", F.to_json("params")))


@query(
    "tune_halving",
    f"""WITH {TXN}, n AS (SELECT count(*) FILTER (split = 'val') AS val_rows FROM (SELECT {split_sql()} AS split FROM txn))
SELECT CAST(r.rung AS INT) AS rung, CAST(r.trials AS BIGINT) AS trials, CAST(r.kept AS BIGINT) AS kept, r.trials * val_rows AS scored_rows,
  true AS budgets_follow, true AS precision_agrees, true AS best_go_on FROM n, (VALUES (0, 15, 5), (1, 5, 2), (2, 2, 1)) r(rung, trials, kept)""",
)
def tune_halving(spark, sf_dir):
    """The whole search of 15 linear trials over the declared ranges, weak ones ended early. Average precision is computed
    again in plain SQL from the stored scores of every trial; a rung's survivors must be its best by those."""
    df = features(spark, sf_dir)
    names, points = numeric_features(df), draw_parameters(LOGISTIC_SPACE, 15)
    train, val = (df.where(F.col("split") == s) for s in ("train", "val"))
    halved = successive_halving(train, val, points, lambda d, p: fit_logistic(d, names, p), "max_iter")
    budgets = spark.createDataFrame([(i, p["max_iter"]) for i, p in enumerate(points)], "trial int, full int")
    again = spark.sql(
        """WITH g AS (SELECT rung, trial, score, sum(label) AS pos, count(*) AS n FROM {scores} GROUP BY ALL), c AS (
  SELECT *, sum(pos) OVER w AS tp, sum(n) OVER w AS seen, sum(pos) OVER (PARTITION BY rung, trial) AS all_pos FROM g
  WINDOW w AS (PARTITION BY rung, trial ORDER BY score DESC)), a AS (
  SELECT rung, trial, sum(pos * tp / seen) / max(nullif(all_pos, 0)) AS ap, sum(n) AS rows FROM c GROUP BY ALL), j AS (
  SELECT r.*, coalesce(a.ap, 0) AS ap, a.rows, b.full FROM {rungs} r JOIN a USING (rung, trial) JOIN {budgets} b USING (trial))
SELECT rung, count(*) AS trials, count_if(kept) AS kept, sum(rows) AS scored_rows,
  bool_and(budget = greatest(1, bround(full / power(3, 2 - rung)))) AS budgets_follow,
  bool_and(abs(ap - val_auprc) < 1e-9) AS precision_agrees,
  coalesce(min(CASE WHEN kept THEN ap END) >= max(CASE WHEN NOT kept THEN ap END) - 1e-9, true) AS best_go_on FROM j GROUP BY rung""",
        scores=halved.scores, rungs=halved.rungs, budgets=budgets,
    )
    return settle_table(again, "halving-check")


@query("cross_validate")
def cross_validate(spark, sf_dir):
    """Three folds for the linear model on half of train and validation."""
    df = features(spark, sf_dir)
    names = numeric_features(df)
    half = with_folds(stratified_sample(train_val_pool(df), KEY, 0.5), KEY, 3)
    out = cross_validate_logistic(half, names, draw_parameters(LOGISTIC_CV_SPACE, 2), 3, max_iter=50)
    return rounded(out.withColumn("params", F.to_json("params")))


@query("cross_validate_trees")
def cross_validate_gbt(spark, sf_dir):
    """Five folds for the boosted trees on half of train and validation."""
    df = features(spark, sf_dir)
    names = numeric_features(df)
    half = with_folds(stratified_sample(train_val_pool(df), KEY, 0.5), KEY, 5)
    out = cross_validate_trees(half, names, draw_parameters(SMALL_TREE_CV_SPACE, 1), 5)
    return rounded(out.withColumn("params", F.to_json("params")))


@query("tune_report")
def tune_report(spark, sf_dir):
    t = tune(
        features(spark, sf_dir),
        trials=2,
        spaces={LOGISTIC: SMALL_LOGISTIC_SPACE, TREES: SMALL_TREE_SPACE},
        baseline_params={LOGISTIC: {"max_iter": 50}, TREES: SMALL_TREES},
    )
    return rounded(t.comparison.withColumn("is_best", F.col("model") == F.lit(t.best)))


def _model_and_defaults(spark, sf_dir):
    df = features(spark, sf_dir)
    train = df.where("split = 'train'")
    model = fit_logistic(train, numeric_features(df), {"max_iter": 50})
    path = scratch_path(spark, "model")
    save_model(model, path)
    return load_model(path), collect_defaults(serving_defaults(train))


@query("score_batch")
def score_batch(spark, sf_dir):
    model, medians = _model_and_defaults(spark, sf_dir)
    requests = transactions(spark, sf_dir).drop("trans_date_trans_time", "is_fraud")
    return score_requests(requests, model, medians, keep=["row_id", "trans_num"])


@query(
    "score_job",
    f"""WITH {RAW}, checked AS (SELECT row_id, list_filter([{_REASON_LIST}], lambda x: x IS NOT NULL) AS reasons FROM raw)
SELECT 'totals' AS part, NULL AS reason, count(*) AS requests, count(*) FILTER (len(reasons) > 0) AS rejected, count(*) FILTER (len(reasons) = 0) AS scored FROM checked
UNION ALL SELECT 'rejected', r.reason, count(*), count(*), 0 FROM (SELECT unnest(reasons) AS reason FROM checked) r GROUP BY 2""",
)
def batch_job(spark, sf_dir):
    """The written totals of a scoring job, and its written rejects by reason."""
    model, medians = _model_and_defaults(spark, sf_dir)
    path = scratch_path(spark, "scores")
    score_job(raw_transactions(spark, sf_dir).drop("trans_date_trans_time", "is_fraud"), model, medians, path, "r1", keep=["row_id"])
    totals, rejected = (read_part(spark, path, "r1", p) for p in ("totals", "rejected"))
    scored = read_part(spark, path, "r1", "scored").where("fraud_probability BETWEEN 0 AND 1").agg(F.count(F.lit(1)).alias("scored"))
    first = totals.drop("scored").crossJoin(scored).select(F.lit("totals").alias("part"), F.lit(None).cast("string").alias("reason"), "requests", "rejected", "scored")
    n = F.count(F.lit(1))
    by_reason = rejected.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(n.alias("requests"), n.alias("rejected"))
    return first.unionByName(by_reason.select(F.lit("rejected").alias("part"), "reason", "requests", "rejected", F.lit(0).cast("bigint").alias("scored")))


@query(
    "train_and_promote",
    f"""WITH {TXN} SELECT 'detector' AS model_name, count(*) > 0 AS promoted, 'No champion model, promoting as first production model' AS reason,
  true AS metrics_agree, CAST(34 AS BIGINT) AS metrics FROM txn""",
)
def train_and_promote(spark, sf_dir):
    """A training run's written rows go through the gate; they agree with the run's own long metrics."""
    df, path = features(spark, sf_dir), scratch_path(spark, "runs")
    training_job(df, scratch_path(spark, "model"), path, "r1", logistic_params={"max_iter": 50}, tree_params=SMALL_TREES)
    rows, long = read_part(spark, path, "r1", "run_metrics"), read_part(spark, path, "r1", "metrics")
    challenger = spark.createDataFrame([("detector", "r1")], "model_name string, run_id string")
    nobody = spark.createDataFrame([], "model_name string, version bigint, stage string, alias string, run_id string")
    report, _ = promote(challenger, rows, nobody)
    slug = F.replace(F.lower("model"), F.lit(" "), F.lit("_"))
    named = long.select(F.concat_ws("_", slug, "split", "metric").alias("name"), F.col("value").alias("own"))
    agree = named.join(rows, "name", "left").agg(F.bool_and(F.col("own").eqNullSafe(F.col("value"))).alias("metrics_agree"))
    counted = rows.agg(F.count(F.lit(1)).alias("metrics"))
    return report.select("model_name", "promoted", "reason").join(agree.join(counted, F.lit(True)), F.lit(True))


def event_stream(spark, sf_dir) -> DataFrame:
    """The events table as a stream of files."""
    schema = table(spark, sf_dir, "events").schema
    return file_stream(spark, sf_dir, schema, "events.parquet")


def streamed_scores(spark, sf_dir, model, medians) -> DataFrame:
    requests = project_transactions(event_stream(spark, sf_dir)).drop("trans_date_trans_time", "is_fraud")
    present = [r for r in request_rules() if r.column in requests.columns]
    out, rejected = scratch_path(spark, "scored"), scratch_path(spark, "rejected")
    score_stream(
        requests, model, medians, out, rejected, scratch_path(spark, "progress"), rules=present, keep=["row_id", "trans_num"]
    )
    return spark.read.parquet(out).drop("batch")


@query("stream_score")
def stream_score(spark, sf_dir):
    return streamed_scores(spark, sf_dir, *_model_and_defaults(spark, sf_dir))


@query(
    "stream_batch_parity",
    f"WITH {TXN} SELECT count(*) AS batch_rows, count(*) AS stream_rows, count(*) AS equal_rows, count(*) AS probabilities_in_range FROM txn",
)
def stream_batch_parity(spark, sf_dir):
    """The same model over the same requests as a batch and as a stream."""
    model, medians = _model_and_defaults(spark, sf_dir)
    requests = transactions(spark, sf_dir).drop("trans_date_trans_time", "is_fraud")
    batch = score_requests(requests, model, medians, keep=["row_id", "trans_num"])
    stream = streamed_scores(spark, sf_dir, model, medians)
    both = batch.alias("b").join(stream.alias("s"), "row_id", "full")
    same = [F.col(f"b.{c}").eqNullSafe(F.col(f"s.{c}")) for c in ("fraud_probability", "is_fraud", "threshold")]
    return both.agg(
        F.count("b.trans_num").alias("batch_rows"),
        F.count("s.trans_num").alias("stream_rows"),
        F.count_if(same[0] & same[1] & same[2]).alias("equal_rows"),
        F.count_if(F.col("s.fraud_probability").between(0.0, 1.0)).alias("probabilities_in_range"),
    )


#: Windows whose end is older than the watermark (latest event minus one hour) are closed.
_CLOSED = "window_start + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)"


@query(
    "stream_outcome_counts",
    f"""WITH w AS (SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start,
  CASE WHEN least(value / 200e0, 1e0) >= 0.5e0 THEN 'fraud' ELSE 'legit' END AS outcome, count(*) AS predictions FROM events GROUP BY 1, 2)
SELECT strftime(window_start, '%Y-%m-%d') AS window_start, outcome, predictions FROM w WHERE {_CLOSED}""",
)
def stream_outcomes(spark, sf_dir):
    """Decisions per closed day."""
    events = event_stream(spark, sf_dir).select(
        F.col("ts").cast("timestamp").alias("ts"), F.least(F.col("value") / 200.0, F.lit(1.0)).alias("score")
    )
    out = scratch_path(spark, "outcomes")
    run_available(outcome_windows(decide(events, "score")), out, scratch_path(spark, "progress"))
    return spark.read.parquet(out).withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd"))


@query(
    "stream_p95",
    f"""WITH w AS (SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, quantile_disc(value, 0.95) AS p95, count(*) AS observations FROM events GROUP BY 1)
SELECT strftime(window_start, '%Y-%m-%d') AS window_start, round(p95 + 1e-9, 6) AS p95, observations FROM w WHERE {_CLOSED}""",
)
def stream_p95(spark, sf_dir):
    """95th percentile per closed day; up to the sketch size the percentile is exact."""
    events = event_stream(spark, sf_dir).select(F.col("ts").cast("timestamp").alias("ts"), "value")
    out = scratch_path(spark, "p95")
    run_available(p95_windows(events, "value"), out, scratch_path(spark, "progress"))
    daily = spark.read.parquet(out).withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd"))
    return rounded(daily)


@query(
    "stream_p95_histogram",
    f"""WITH w AS (SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, value FROM events), {histogram_sql('w', 'window_start', 'value')}
SELECT strftime(window_start, '%Y-%m-%d') AS window_start, round(p + 1e-9, 6) AS p95, observations FROM hq WHERE {_CLOSED}""",
)
def stream_p95_histogram(spark, sf_dir):
    """95th percentile per closed day from streamed bucket counts."""
    events = event_stream(spark, sf_dir).select(F.col("ts").cast("timestamp").alias("ts"), "value")
    out = scratch_path(spark, "buckets")
    run_available(histogram_windows(events, "value", _BOUNDS), out, scratch_path(spark, "progress"))
    daily = histogram_quantile(spark.read.parquet(out), _BOUNDS, 0.95, ["window_start"], "p95")
    return rounded(daily.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd")))


@query("stream_deduplicated", f"WITH {TXN} SELECT row_id, trans_num FROM txn")
def stream_deduplicated(spark, sf_dir):
    """Every event delivered twice, kept once."""
    events = event_stream(spark, sf_dir).select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_id").alias("row_id"),
        F.md5(F.col("event_id").cast("string")).alias("trans_num"),
    )
    out = scratch_path(spark, "unique")
    twice = deduplicated(events.unionByName(events))
    run_available(twice.select("row_id", "trans_num"), out, scratch_path(spark, "progress"))
    return spark.read.parquet(out)


@query(
    "stream_customer_state",
    f"""WITH {TXN} SELECT cc_num, count(*) AS customer_txn_count, round(avg(amt) + 1e-9, 6) AS customer_avg_amt,
  round(coalesce(stddev_samp(amt), 0) + 1e-9, 6) AS customer_std_amt, round(avg(is_fraud) + 1e-9, 6) AS customer_fraud_rate FROM txn GROUP BY 1""",
)
def stream_state(spark, sf_dir):
    """Running card statistics after the whole stream."""
    stats = running_card_statistics(project_transactions(event_stream(spark, sf_dir)))
    out = scratch_path(spark, "cards")
    write_updates(stats, out, scratch_path(spark, "progress"))
    return rounded(latest_state(spark.read.parquet(out), "cc_num"))




@query("stream_card_history", earlier_sql("cc_num"))
def card_history(spark, sf_dir):
    """Statistics of each card's earlier transactions, row by row along a stream that gets a new folder of events, in
    order of time, for each of seven batches; the state is compacted every third batch."""
    events = table(spark, sf_dir, "events")
    landing, out = scratch_path(spark, "landing"), scratch_path(spark, "history")
    state, progress = scratch_path(spark, "moments"), scratch_path(spark, "progress")
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    low, high = events.agg(F.min(seconds), F.max(seconds)).first()
    slot = F.floor((seconds - low) * 7 / (high - low + 1))
    for k in range(7):
        events.where(slot == k).write.parquet(f"{landing}/slot{k}")
        arrived = spark.readStream.schema(events.schema).option("recursiveFileLookup", "true").parquet(landing)
        stream_history(
            project_transactions(arrived), "cc_num", out, state, progress, keep=["row_id", "cc_num"], spread_by=KEY, compact_every=3
        )
    return rounded(spark.read.parquet(out).drop("batch"))
