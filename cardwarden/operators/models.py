"""Fraud models as Spark ML pipelines."""

from __future__ import annotations

import math

from pyspark import SparkContext
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwarden.operators.features import assembler
from cardwarden.operators.leaf_values import penalised
from cardwarden.operators.scoring import positive_probability
from cardwarden.schema import LABEL, LOGISTIC_DEFAULTS, TREE_DEFAULTS
from cardwarden.session import scratch_root, settle_table

WEIGHT = "class_weight"


def class_sizes(df: DataFrame, label: str = LABEL) -> tuple[int, int]:
    """Negatives and positives."""
    row = df.agg(
        F.count_if(F.col(label) == 0).alias("neg"), F.count_if(F.col(label) == 1).alias("pos")
    ).first()
    return row["neg"], row["pos"]


def _either(label: str, positive: float, negative: float) -> Column:
    return F.when(F.col(label) == 1, F.lit(float(positive))).otherwise(F.lit(float(negative)))


def standardized(df: DataFrame, columns: list[str]) -> DataFrame:
    """Columns with mean 0 and population deviation 1; constant columns become 0.

    The moments (two numbers per column) become constants of a narrow projection.
    """
    row = df.agg(
        *[F.avg(c).alias(f"{c}__m") for c in columns], *[F.stddev_pop(c).alias(f"{c}__s") for c in columns]
    ).first()
    return df.withColumns(
        {c: (F.col(c) - row[f"{c}__m"]) / (row[f"{c}__s"] or 1.0) for c in columns}
    )


class SummaryFreeLogistic(LogisticRegression):
    """Models without their training summary: that holds the session, which can't be sent to tasks once anything has been
    observed in it."""

    def _create_model(self, java_model):
        java_model.setSummary(SparkContext._active_spark_context._jvm.scala.Option.empty())
        return super()._create_model(java_model)


def fit_logistic(
    df: DataFrame, features: list[str], params: dict | None = None, label: str = LABEL
) -> PipelineModel:
    """Class-balanced logistic regression on standardised features.

    ``C`` weighs the summed loss against half the squared coefficients. Spark minimises the mean
    loss instead, hence ``regParam = 1 / (C * sum of weights)``. The scaler divides by the sample
    deviation; the factor (n-1)/n moves that difference into the penalty, so the fitted model is
    the one on population-scaled features.
    """
    p = {**LOGISTIC_DEFAULTS, **(params or {})}
    neg, pos = class_sizes(df, label)
    n = neg + pos
    if p["class_weight"] == "balanced":
        weight = _either(label, n / (2 * max(pos, 1)), n / (2 * max(neg, 1)))
    else:
        weight = F.lit(1.0)
    weighted = df.select(*features, F.col(label).cast("double").alias(label), weight.alias(WEIGHT))
    pipeline = Pipeline(
        stages=[
            assembler(features),
            StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True),
            SummaryFreeLogistic(
                labelCol=label,
                weightCol=WEIGHT,
                maxIter=int(p["max_iter"]),
                regParam=(n - 1) / n / (p["C"] * n),
                elasticNetParam=0.0,
                standardization=False,
            ),
        ]
    )
    return pipeline.fit(weighted)


def logistic_gradient(
    df: DataFrame, features: list[str], model: PipelineModel, params: dict | None = None, label: str = LABEL
) -> DataFrame:
    """``(feature, gradient)`` of the fit's own objective at the fitted coefficients, the intercept last: one aggregation.

    The objective is the weighted mean of the log loss plus half the penalty times the squared coefficients, as in
    :func:`fit_logistic`; at its minimum all entries are zero, whatever solver got there.
    """
    p = {**LOGISTIC_DEFAULTS, **(params or {})}
    neg, pos = class_sizes(df, label)
    n, y = neg + pos, F.col(label).cast("double")
    weight = _either(label, n / (2 * max(pos, 1)), n / (2 * max(neg, 1))) if p["class_weight"] == "balanced" else F.lit(1.0)
    scored = model.transform(df.select(*features, label))
    x, away = vector_to_array("features"), (weight * (positive_probability() - y)).alias("away")
    rows = scored.select(x.alias("x"), away, weight.alias("w"))
    sums = rows.agg(
        F.sum("w").alias("w"), F.sum("away").alias("b"), *[F.sum(F.col("away") * F.get("x", F.lit(i))).alias(f"g{i}") for i in range(len(features))]
    ).first()
    fitted = model.stages[-1]
    out = [
        (f, sums[f"g{i}"] / sums["w"] + fitted.getRegParam() * float(fitted.coefficients[i])) for i, f in enumerate(features)
    ] + [("(intercept)", sums["b"] / sums["w"])]
    return df.sparkSession.createDataFrame(out, "feature string, gradient double")


#: Histogram bins of a feature (fixed value: the default of the usual leaf-wise learner).
MAX_BINS = 255


def tree_depth(leaves: int) -> int:
    """The smallest depth at which a balanced tree has at least this many leaves."""
    return max(1, math.ceil(math.log2(max(2, leaves))))


def fit_trees(
    df: DataFrame, features: list[str], params: dict | None = None, label: str = LABEL
) -> PipelineModel:
    """Boosted trees with positives weighted by the class ratio.

    Spark grows trees level by level, so a number of leaves becomes a depth. With a penalty (``reg_alpha``,
    ``reg_lambda``) the leaves get their values in a second step, see ``leaf_values``.
    """
    p = {**TREE_DEFAULTS, **(params or {})}
    # With a checkpoint folder the boosting rounds cut their lineage every few trees.
    scratch_root(df.sparkSession)
    neg, pos = class_sizes(df, label)
    weighted = df.select(
        *features,
        F.col(label).cast("double").alias(label),
        _either(label, neg / max(pos, 1), 1.0).alias(WEIGHT),
    )
    pipeline = Pipeline(
        stages=[
            assembler(features, "features"),
            GBTClassifier(
                labelCol=label,
                weightCol=WEIGHT,
                maxIter=int(p["n_estimators"]),
                stepSize=float(p["learning_rate"]),
                maxDepth=min(30, int(p.get("max_depth") or tree_depth(int(p["num_leaves"])))),
                subsamplingRate=float(p["subsample"]),
                featureSubsetStrategy=str(float(p["colsample_bytree"]))
                if p["colsample_bytree"] < 1.0
                else "all",
                minInstancesPerNode=int(p["min_child_samples"]),
                maxBins=MAX_BINS,
                seed=int(p["random_state"]),
                maxMemoryInMB=512,
                cacheNodeIds=False,
            ),
        ]
    )
    if not p["reg_alpha"] and not p["reg_lambda"]:
        return pipeline.fit(weighted)
    weighted = settle_table(weighted, "weighted")
    return penalised(
        weighted, pipeline.fit(weighted), label, WEIGHT, float(p["learning_rate"]), float(p["reg_alpha"]), float(p["reg_lambda"])
    )


def score_splits(df: DataFrame, models: dict[str, PipelineModel], label: str = LABEL) -> DataFrame:
    """Rows ``(model, split, label, score)`` of every model over the split table."""
    out = None
    for name, model in models.items():
        scored = model.transform(df).select(
            F.lit(name).alias("model"),
            "split",
            F.col(label).cast("int").alias("label"),
            positive_probability().alias("score"),
        )
        out = scored if out is None else out.unionByName(scored)
    return out


def feature_importance(model: PipelineModel, features: list[str], df: DataFrame) -> DataFrame:
    """Tree importances, largest first; one row per feature."""
    values = model.stages[-1].featureImportances.toArray().tolist()
    rows = [(f, float(v)) for f, v in zip(features, values)]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )


def logistic_coefficients(model: PipelineModel, features: list[str], df: DataFrame) -> DataFrame:
    """Coefficients on the standardised scale, intercept last."""
    lr = model.stages[-1]
    rows = [(f, float(v)) for f, v in zip(features, lr.coefficients.toArray())]
    rows.append(("(intercept)", float(lr.intercept)))
    return df.sparkSession.createDataFrame(rows, "feature string, coefficient double")


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
