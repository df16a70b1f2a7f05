"""Training, evaluation and model choice over a split feature table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwarden.operators.metrics import bias_variance, evaluate, metrics_long, nest_metrics
from cardwarden.operators.models import fit_logistic, fit_trees, load_model, save_model, score_splits
from cardwarden.operators.promotion import run_metrics
from cardwarden.operators.selection import best_model
from cardwarden.schema import LABEL, numeric_features
from cardwarden.session import settle_table
from cardwarden.sources.run_documents import write_run

LOGISTIC, TREES = "Logistic Regression", "Boosted Trees"


@dataclass
class Training:
    """Both models, their metrics ``(model, split, metric, value)`` and the chosen one."""

    models: dict[str, PipelineModel]
    features: list[str]
    metrics: DataFrame
    best: str
    best_val_auprc: float


def positions(models: list[str]) -> F.Column:
    """Order of training, used to break ties."""
    expr = None
    for i, name in enumerate(models):
        hit = F.col("model") == name
        expr = F.when(hit, F.lit(i)) if expr is None else expr.when(hit, F.lit(i))
    return expr


def score_and_measure(df: DataFrame, models: dict[str, PipelineModel]) -> DataFrame:
    """Long metrics of all models on all splits.

    The scored rows are written once: bucket borders, ranking and threshold metrics then read a
    narrow table instead of scoring three times.
    """
    scored = settle_table(score_splits(df, models), "scored")
    return metrics_long(evaluate(scored, ["model", "split"]), ["model", "split"])


def train_models(
    df: DataFrame,
    logistic_params: dict | None = None,
    tree_params: dict | None = None,
    label: str = LABEL,
) -> Training:
    """Fit both models on train, measure on all splits, choose by validation average precision."""
    features = numeric_features(df, label)
    train = df.where(F.col("split") == "train")
    models = {
        LOGISTIC: fit_logistic(train, features, logistic_params, label),
        TREES: fit_trees(train, features, tree_params, label),
    }
    metrics = settle_table(score_and_measure(df, models), "metrics")
    val = metrics.where("split = 'val' AND metric = 'auprc'").select(
        "model", F.col("value").alias("auprc"), positions(list(models)).alias("position")
    )
    choice = best_model(val).first()
    return Training(models, features, metrics, choice["best_model"], choice["best_auprc"])


def training_report(training: Training, run_id: str) -> DataFrame:
    """One report row: choice and nested results."""
    return nest_metrics(training.metrics).select(
        F.lit(training.best).alias("best_model"),
        F.lit(training.best_val_auprc).alias("best_val_auprc"),
        F.lit(run_id).alias("best_run_id"),
        "results",
    )


def train_and_save(df: DataFrame, model_path: str, **params) -> Training:
    training = train_models(df, **params)
    save_model(training.models[training.best], model_path)
    return training


def run_rows(training: Training, run_id: str) -> DataFrame:
    """``(run_id, name, value)``: the run's metrics as the promotion gate reads them."""
    long = training.metrics.select(F.lit(run_id).alias("run_id"), positions(list(training.models)).alias("position"), "*")
    return run_metrics(long)


def training_job(df: DataFrame, model_path: str, path: str, run_id: str, **params) -> Training:
    """Train both models, store the better one, and write report, metrics and run rows as a run; the stored model comes
    first, so a complete run has one."""
    training = train_and_save(df, model_path, **params)
    reports = {"report": training_report(training, run_id), "metrics": training.metrics}
    write_run(df.sparkSession, path, run_id, reports, {"run_metrics": run_rows(training, run_id)})
    return training


def evaluate_saved(df: DataFrame, model_path: str, name: str = "model") -> tuple[DataFrame, DataFrame]:
    """Metrics and bias-variance row of a stored model."""
    metrics = settle_table(score_and_measure(df, {name: load_model(model_path)}), "metrics")
    return metrics, bias_variance(metrics)
