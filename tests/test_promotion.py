import pytest

from cardwarden.operators.promotion import (
    apply_promotions,
    champion_versions,
    promotion_gate,
    promotion_metrics,
    run_metrics,
)
from cardwarden.plans.promote import promote

GATE = "model_name string, recall double, precision double"


def gate(spark, challenger, champion):
    left = spark.createDataFrame([("m", *challenger)], GATE)
    right = spark.createDataFrame([("m", *champion)] if champion else [], GATE)
    return promotion_gate(left, right).first()


@pytest.mark.parametrize(
    "challenger, champion, promoted, reason",
    [
        ((0.90, 0.40), (0.88, 0.42), True, "Recall: 0.9000 >= 0.8800 | Precision: 0.4000 >= 0.3990"),
        ((0.10, 0.10), None, True, "No champion model, promoting as first production model"),
        ((0.87, 0.99), (0.88, 0.42), False, "Challenger Recall (0.8700) < Champion (0.8800)"),
        ((0.90, 0.39), (0.88, 0.42), False, "Challenger Precision (0.3900) < Min required (0.3990)"),
        ((0.88, 0.42), (0.88, 0.42), True, "Recall: 0.8800 >= 0.8800 | Precision: 0.4200 >= 0.3990"),
        ((None, None), (0.1, 0.1), False, "Challenger Recall (0.0000) < Champion (0.1000)"),
    ],
)
def test_gate(spark, challenger, champion, promoted, reason):
    row = gate(spark, challenger, champion)
    assert (row["promoted"], row["reason"]) == (promoted, reason)


def test_validation_figures_come_before_plain_ones(spark):
    left = spark.createDataFrame([("m", 0.5, 0.9, 0.5)], "model_name string, val_recall double, recall double, precision double")
    right = spark.createDataFrame([("m", 0.6, 0.5)], GATE)
    assert not promotion_gate(left, right).first()["promoted"]


def names(spark, rows):
    return spark.createDataFrame(rows, "run_id string, name string, value double")


def test_plain_names_win(spark):
    df = names(spark, [("r", "val_recall", 0.1), ("r", "val_precision", 0.2), ("r", "a_val_recall", 0.9)])
    row = promotion_metrics(df).first()
    assert (row["val_auprc"], row["val_recall"], row["val_precision"]) == (None, 0.1, 0.2)


def test_complete_models_come_first_then_average_precision(spark):
    df = names(
        spark,
        [
            ("r", "b_val_auprc", 0.99),
            ("r", "best_val_auprc", 1.0),
            ("r", "a_val_auprc", 0.5), ("r", "a_val_recall", 0.4), ("r", "a_val_precision", 0.3),
            ("r", "c_val_auprc", 0.6), ("r", "c_val_recall", 0.7), ("r", "c_val_precision", 0.8),
            ("s", "x_val_auprc", 0.2),
            ("t", "train_auprc", 0.2),
        ],
    )
    rows = {r["run_id"]: (r["val_auprc"], r["val_recall"], r["val_precision"]) for r in promotion_metrics(df).collect()}
    assert rows == {"r": (0.6, 0.7, 0.8), "s": (0.2, 0.0, 0.0), "t": (None, None, None)}


def test_run_metric_names_and_tie(spark):
    rows = []
    for position, model in enumerate(["Logistic Regression", "Boosted Trees"]):
        for metric, value in [("auprc", 0.5), ("recall", 0.1 + position), ("precision", 0.2)]:
            rows.append(("r", position, model, "val", metric, value))
    long = spark.createDataFrame(rows, "run_id string, position int, model string, split string, metric string, value double")
    got = {r["name"]: r["value"] for r in run_metrics(long).collect()}
    assert got["logistic_regression_val_auprc"] == 0.5 and got["best_val_auprc"] == 0.5
    assert got["val_recall"] == pytest.approx(0.1)


REGISTRY = "model_name string, version long, stage string, alias string, run_id string"


def test_champion_by_alias_then_stage(spark):
    registry = spark.createDataFrame(
        [
            ("a", 1, "Archived", "champion", "r1"), ("a", 2, "Production", None, "r2"),
            ("b", 1, "Production", None, "r3"), ("b", 2, "Production", None, "r4"), ("b", 3, "None", None, "r5"),
            ("c", 1, "None", None, "r6"),
            ("d", 1, "Production", "champion", None),
            ("e", 1, "None", "champion", None), ("e", 2, "Production", None, "r7"),
        ],
        REGISTRY,
    )
    got = {r["model_name"]: (r["version"], r["run_id"]) for r in champion_versions(registry).collect()}
    assert got == {"a": (1, "r1"), "b": (2, "r4"), "e": (2, "r7")}


def test_promotion_moves_stage_and_alias(spark):
    registry = spark.createDataFrame(
        [("a", 1, "Archived", None, "r1"), ("a", 2, "Production", "champion", "r2"), ("b", 5, "Production", "champion", "r3")],
        REGISTRY,
    )
    promoted = spark.createDataFrame([("a", "r9"), ("new", "r8")], "model_name string, run_id string")
    got = {(r["model_name"], r["version"]): (r["stage"], r["alias"]) for r in apply_promotions(registry, promoted).collect()}
    assert got == {
        ("a", 1): ("Archived", None),
        ("a", 2): ("Archived", None),
        ("a", 3): ("Production", "champion"),
        ("b", 5): ("Production", "champion"),
        ("new", 1): ("Production", "champion"),
    }
    staged = apply_promotions(registry, promoted, stage="Staging").where("version = 3").first()
    assert (staged["stage"], staged["alias"]) == ("Staging", None)


def test_whole_job(spark):
    registry = spark.createDataFrame([("m", 1, "Production", "champion", "old")], REGISTRY)
    metrics = names(
        spark,
        [("old", "val_recall", 0.88), ("old", "val_precision", 0.42), ("new", "val_recall", 0.9), ("new", "val_precision", 0.4)],
    )
    challengers = spark.createDataFrame([("m", "new"), ("n", "new")], "model_name string, run_id string")
    report, after = promote(challengers, metrics, registry)
    rows = {r["model_name"]: r for r in report.collect()}
    assert rows["m"]["promoted"] and rows["m"]["champion_run_id"] == "old"
    assert rows["n"]["reason"].startswith("No champion")
    assert {(r["model_name"], r["version"]) for r in champion_versions(after).collect()} == {("m", 2), ("n", 1)}


def test_plain_names_are_compared(spark):
    from cardwarden.plans.promote import promote

    challengers = spark.createDataFrame([("m", "new")], "model_name string, run_id string")
    metrics = spark.createDataFrame(
        [("new", "recall", 0.90), ("new", "precision", 0.9), ("old", "recall", 0.95), ("old", "precision", 0.9)],
        "run_id string, name string, value double",
    )
    registry = spark.createDataFrame(
        [("m", 1, "Production", "champion", "old")],
        "model_name string, version int, stage string, alias string, run_id string",
    )
    report, _ = promote(challengers, metrics, registry)
    row = report.first()
    assert not row["promoted"] and row["reason"].startswith("Challenger Recall (0.9000)")
    # A champion whose run has no metrics is compared all the same.
    report, after = promote(challengers, metrics.where("run_id = 'new'"), registry)
    row = report.first()
    assert row["promoted"] and row["champion_run_id"] == "old" and row["reason"].startswith("Recall: 0.9000 >= 0.0000")
    assert {(r["version"], r["stage"]) for r in after.collect()} == {(1, "Archived"), (2, "Production")}


def test_equal_models_go_by_order(spark):
    from cardwarden.operators.promotion import promotion_metrics

    rows = [("r", f"{m}_val_{k}", 0.5 + d, p) for m, d, p in (("zeta", 0.1, 0), ("alpha", 0.2, 1)) for k in ("recall", "precision")]
    rows += [("r", f"{m}_val_auprc", 0.7, p) for m, p in (("zeta", 0), ("alpha", 1))]
    metrics = spark.createDataFrame(rows, "run_id string, name string, value double, position int")
    assert promotion_metrics(metrics).first()["val_recall"] == 0.6


def test_two_promotions_of_a_model(spark):
    from cardwarden.operators.promotion import apply_promotions

    registry = spark.createDataFrame(
        [("m", 4, "Production", "champion", "old")],
        "model_name string, version int, stage string, alias string, run_id string",
    )
    promoted = spark.createDataFrame([("m", "r1"), ("m", "r2")], "model_name string, run_id string")
    got = {(r["version"], r["stage"], r["alias"]) for r in apply_promotions(registry, promoted).collect()}
    assert got == {(4, "Archived", None), (5, "Archived", None), (6, "Production", "champion")}
