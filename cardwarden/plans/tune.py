"""The tuning job: search, refit on train and validation, compare with the baseline."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwarden.operators.halving import successive_halving
from cardwarden.operators.models import fit_logistic, fit_trees, save_model
from cardwarden.operators.tuning import (
    LOGISTIC_SPACE,
    TREE_SPACE,
    best_trial,
    draw_parameters,
    improvement_flags,
    parameter_rows,
    parameter_table,
    search,
    tuning_comparison,
)
from cardwarden.plans.train import LOGISTIC, TREES, score_and_measure
from cardwarden.schema import LABEL, numeric_features
from cardwarden.session import settle, settle_table
from cardwarden.sources.run_documents import write_run
from cardwarden.sources.split_files import train_val_pool

FITTERS = {LOGISTIC: fit_logistic, TREES: fit_trees}
SPACES = {LOGISTIC: LOGISTIC_SPACE, TREES: TREE_SPACE}
#: What a trial of halving gets a part of.
BUDGETS = {LOGISTIC: "max_iter", TREES: "n_estimators"}


@dataclass
class Tuning:
    best_params: dict[str, dict]
    models: dict[str, PipelineModel]
    comparison: DataFrame
    best: str
    trials: DataFrame | None = None


def tune_one(
    df: DataFrame, model: str, trials: int, space: dict | None = None, seed: int = 42, label: str = LABEL,
    parallelism: int = 4, eta: int | None = None,
) -> tuple[DataFrame, dict]:
    """Trials of one model family with their parameters, and the best parameter set. With ``eta`` weak trials end
    early (see ``operators/halving.py``): the rows are those of all rungs."""
    features = numeric_features(df, label)
    train, val = (df.where(F.col("split") == s) for s in ("train", "val"))
    points = draw_parameters(space or SPACES[model], trials, seed)

    def fit(d: DataFrame, p: dict) -> PipelineModel:
        return FITTERS[model](d, features, p, label)

    if eta is not None:
        halved = successive_halving(train, val, points, fit, BUDGETS[model], eta, label, parallelism)
        return settle(parameter_rows(halved.rungs, points)), points[halved.best]
    results, _ = search(train, val, points, fit, label, parallelism)
    trials_table = settle(parameter_rows(results, points))
    return trials_table, points[best_trial(trials_table)]


def tune(
    df: DataFrame,
    trials: int = 15,
    spaces: dict[str, dict] | None = None,
    baseline_params: dict[str, dict] | None = None,
    seed: int = 42,
    label: str = LABEL,
    eta: int | None = None,
) -> Tuning:
    """Tune both families, by halving if ``eta`` is given; the tree family wins an equal test average precision."""
    features = numeric_features(df, label)
    train, pool = df.where(F.col("split") == "train"), train_val_pool(df)
    best, tuned, baseline, trials_of = {}, {}, {}, {}
    for name, fit in FITTERS.items():
        trials_of[name], best[name] = tune_one(df, name, trials, (spaces or SPACES)[name], seed, label, eta=eta)
        tuned[name] = fit(pool, features, best[name], label)
        baseline[name] = fit(train, features, (baseline_params or {}).get(name), label)
    long = score_and_measure(df, tuned).withColumn("variant", F.lit("tuned")).unionByName(
        score_and_measure(df, baseline).withColumn("variant", F.lit("baseline"))
    )
    comparison = settle_table(tuning_comparison(long), "comparison")
    test = {r["model"]: r["tuned"] for r in comparison.where("split = 'test'").collect()}
    table = reduce(DataFrame.unionByName, [t.withColumn("model", F.lit(m)) for m, t in trials_of.items()])
    return Tuning(best, tuned, comparison, TREES if test[TREES] >= test[LOGISTIC] else LOGISTIC, table)


def tuning_job(df: DataFrame, model_path: str, path: str, run_id: str, **options) -> Tuning:
    """Tune, store the better refitted model, and write parameters, trials, comparison and flags as a run."""
    tuning = tune(df, **options)
    save_model(tuning.models[tuning.best], model_path)
    reports = {
        "best_parameters": parameter_table(df.sparkSession, tuning.best_params), "trials": tuning.trials,
        "comparison": tuning.comparison.withColumn("is_best", F.col("model") == F.lit(tuning.best)),
        "flags": improvement_flags(tuning.comparison),
    }
    write_run(df.sparkSession, path, run_id, reports)
    return tuning
