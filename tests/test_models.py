import numpy as np
import pytest
from pyspark.sql import functions as F

from cardwarden.operators.features import feature_matrix
from cardwarden.operators.models import (
    feature_importance,
    fit_logistic,
    fit_trees,
    load_model,
    save_model,
    standardized,
    tree_depth,
)
from cardwarden.operators.scoring import collect_defaults, positive_probability, request_features, score_requests
from cardwarden.operators.splitting import hash_split
from cardwarden.operators.summaries import serving_defaults
from cardwarden.operators.tuning import (
    LOGISTIC_SPACE,
    TREE_SPACE,
    draw_parameters,
    improvement_flags,
    parameter_diff,
    parameter_table,
    tuning_comparison,
)
from cardwarden.operators.validation import request_rules
from cardwarden.plans.prepare import settled_features
from cardwarden.plans.train import evaluate_saved, train_and_save, training_report
from cardwarden.schema import GROUP_STATS, numeric_features
from cardwarden.sources.events import project_transactions, table, transactions
from cardwarden.streaming.transactions import file_stream, score_stream

SMALL = {"n_estimators": 3, "learning_rate": 0.3, "num_leaves": 8, "min_child_samples": 2}


@pytest.fixture(scope="module")
def rows120(spark):
    return spark.range(120).select(
        (F.col("id") % 50).cast("double").alias("amt"),
        (F.col("id") + 1000).alias("city_pop"),
        (F.col("id") + 1546300800).alias("unix_time"),
        (F.col("id") % 15 == 0).cast("int").alias("is_fraud"),
        F.lit("m1").alias("merchant"),
    )


def test_numeric_predictors(rows120):
    assert numeric_features(rows120) == ["amt", "city_pop", "unix_time"]
    assert feature_matrix(rows120).columns == ["amt", "city_pop", "unix_time", "is_fraud"]


def newton(x, y, c):
    """Balanced, L2-penalised logistic regression on population-scaled columns."""
    x = (x - x.mean(0)) / x.std(0)
    x = np.column_stack([x, np.ones(len(x))])
    w = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    penalty = np.diag([1.0] * (x.shape[1] - 1) + [0.0])
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ beta))
        gradient = c * x.T @ (w * (p - y)) + penalty @ beta
        hessian = c * (x * (w * p * (1 - p))[:, None]).T @ x + penalty
        beta -= np.linalg.solve(hessian, gradient)
    return 1 / (1 + np.exp(-x @ beta))


@pytest.mark.parametrize("c", [1.0, 0.01])
def test_logistic_solves_the_stated_objective(spark, c):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(60, 2)) * [1.0, 5.0] + [0.0, 3.0]
    y = (x[:, 0] + rng.normal(size=60) > 1.0).astype(int)
    df = spark.createDataFrame([(float(a), float(b), int(t)) for (a, b), t in zip(x, y)], "a double, b double, is_fraud int")
    model = fit_logistic(df, ["a", "b"], {"C": c, "max_iter": 500})
    got = [r[0] for r in model.transform(df).select(positive_probability()).collect()]
    assert got == pytest.approx(newton(x, y, c).tolist(), abs=1e-4)


def test_both_models_give_probabilities(rows120):
    names = numeric_features(rows120)
    for model in (fit_logistic(rows120, names, {"max_iter": 200}), fit_trees(rows120, names, SMALL)):
        p = [r[0] for r in model.transform(rows120).select(positive_probability()).collect()]
        assert len(p) == 120 and 0 <= min(p) <= max(p) <= 1
    importance = feature_importance(model, names, rows120).collect()
    assert sum(r["importance"] for r in importance) == pytest.approx(1.0)
    assert importance[0]["importance"] >= importance[-1]["importance"]


def test_depth_of_leaves():
    assert [tree_depth(n) for n in (2, 15, 31, 63, 64, 127)] == [1, 4, 5, 6, 6, 7]


def test_standardized(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "a double, b double")
    rows = standardized(df, ["a", "b"]).orderBy("a").collect()
    assert [r["a"] for r in rows] == pytest.approx([-1.224744871, 0, 1.224744871])
    assert {r["b"] for r in rows} == {0.0}


def test_training_beats_the_prior_and_survives_storage(spark, sf_dir, tmp_path):
    df = settled_features(transactions(spark, sf_dir), ["row_id"])
    path = str(tmp_path / "model")
    t = train_and_save(df, path, logistic_params={"max_iter": 30}, tree_params=SMALL)
    assert set(t.models) == {"Logistic Regression", "Boosted Trees"}
    prior = df.where("split = 'val'").agg(F.avg("is_fraud")).first()[0]
    assert t.best_val_auprc > prior
    assert training_report(t, "run-1").first()["best_model"] == t.best
    metrics, gaps = evaluate_saved(df, path, t.best)
    stored = {(r["split"], r["metric"]): r["value"] for r in metrics.collect()}
    trained = {(r["split"], r["metric"]): r["value"] for r in t.metrics.where(F.col("model") == t.best).collect()}
    assert stored == pytest.approx(trained)
    assert gaps.count() == 1


def test_batch_and_stream_scores_agree(spark, sf_dir, tmp_path):
    df = settled_features(transactions(spark, sf_dir), ["row_id"])
    train = df.where("split = 'train'")
    save_model(fit_logistic(train, numeric_features(df), {"max_iter": 20}), str(tmp_path / "m"))
    model, defaults = load_model(str(tmp_path / "m")), collect_defaults(serving_defaults(train))
    requests = transactions(spark, sf_dir).drop("trans_date_trans_time", "is_fraud")
    assert numeric_features(request_features(requests, defaults)) != []
    batch = score_requests(requests, model, defaults, keep=["row_id"])
    stream = project_transactions(
        file_stream(spark, sf_dir, table(spark, sf_dir, "events").schema, "events.parquet")
    ).drop("trans_date_trans_time", "is_fraud")
    broken = stream.withColumn("amt", F.when(F.col("row_id") % 10 == 0, -F.col("amt")).otherwise(F.col("amt")))
    rules = [r for r in request_rules() if r.column in broken.columns]
    score_stream(
        broken, model, defaults, str(tmp_path / "out"), str(tmp_path / "bad"), str(tmp_path / "cp"),
        rules=rules, keep=["row_id"],
    )
    got = spark.read.parquet(str(tmp_path / "out")).drop("batch")
    want = batch.where("row_id % 10 <> 0")
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0
    bad = spark.read.parquet(str(tmp_path / "bad"))
    assert bad.where("row_id % 10 <> 0").count() == 0
    assert {r[0] for r in bad.select(F.explode("reasons")).distinct().collect()} == {"non_negative:amt"}


def test_defaults_fall_back_without_statistics(spark, sf_dir):
    train = transactions(spark, sf_dir)
    got = collect_defaults(serving_defaults(train))
    assert set(got) == set(GROUP_STATS)
    assert got["customer_txn_count"] == 1.0 and got["merchant_fraud_rate"] == 0.0
    assert got["category_avg_amt"] == pytest.approx(train.agg(F.avg("amt")).first()[0])


def test_drawn_parameters_are_seeded_and_inside_their_ranges():
    for space in (LOGISTIC_SPACE, TREE_SPACE):
        points = draw_parameters(space, 50, seed=1)
        assert points == draw_parameters(space, 50, seed=1) != draw_parameters(space, 50, seed=2)
        for p in points:
            for name, (low, high, step) in space.items():
                assert low <= p[name] <= high
                if isinstance(step, int):
                    assert (p[name] - low) % step == 0


def test_parameter_diff_and_improvement(spark):
    a = parameter_table(spark, {"lr": {"C": 1.0, "max_iter": 1000}})
    b = parameter_table(spark, {"lr": {"C": 1.0, "max_iter": 500, "extra": None}})
    rows = {r["param"]: r["same"] for r in parameter_diff(a, b).collect()}
    assert rows == {"C": True, "max_iter": False, "extra": True}
    long = spark.createDataFrame(
        [("lr", "test", "auprc", "baseline", 0.5), ("lr", "test", "auprc", "tuned", 0.505)],
        "model string, split string, metric string, variant string, value double",
    )
    flags = improvement_flags(tuning_comparison(long)).first()
    assert flags["any_improved"] and flags["near_optimal"]


def test_split_of_features_is_deterministic(spark, sf_dir):
    txn = transactions(spark, sf_dir)
    a = hash_split(txn, ["row_id"]).select("row_id", "split")
    b = hash_split(txn.repartition(5), ["row_id"]).select("row_id", "split")
    assert a.exceptAll(b).count() == 0
