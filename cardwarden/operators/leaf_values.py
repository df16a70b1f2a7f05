"""Leaf values of boosted trees under penalties.

Spark's learner fixes the shape of the trees and gives each leaf its mean residual; it knows no penalties. Here the
leaves get new values, tree by tree in boosting order. With the margins of all trees before it, a tree's leaf has the
summed gradient ``g`` and curvature ``h`` of the weighted log loss over its rows, and the value that minimises
``g v + (h + l2) v^2 / 2 + l1 |v|`` is a Newton step drawn towards zero; the learning rate shrinks it. One aggregation
a tree, at most one row per leaf reaches the driver. Margins are written every ``BLOCK`` trees, so a pass never adds up
more than those. The result is an ordinary Spark model again: its stored nodes are joined with the new values.
"""

from __future__ import annotations

import math

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwarden.session import scratch_path, settle_table

#: Trees whose values a row looks up between two writes of its margin.
BLOCK = 16

LEAF_SCHEMA = (
    "tree int, leaf int, rows bigint, gradient double, curvature double, loss double, l1 double, l2 double, "
    "learning_rate double, value double"
)


def newton_value(gradient: float, curvature: float, l1: float, l2: float) -> float:
    """The penalised Newton step: zero where the gradient doesn't exceed the first penalty."""
    excess = max(abs(gradient) - l1, 0.0)
    return -math.copysign(excess, gradient) / (curvature + l2) if excess else 0.0


def _chosen(values: list[float], position: Column) -> Column:
    return F.get(F.array(*map(F.lit, values)), position)


def leaf_table(
    df: DataFrame, model: PipelineModel, label: str, weight: str, learning_rate: float, l1: float, l2: float, block: int = BLOCK
) -> tuple[DataFrame, float]:
    """Every leaf with its sums and its new value (shrunk, on the log-odds scale), and the margin before the first tree.

    ``loss`` is the weighted log loss of the leaf's rows before its tree.
    """
    trees = model.stages[-1]
    marked = GBTClassificationModel.copy(trees)._set(leafCol="leaves")
    placed = marked.transform(PipelineModel(model.stages[:-1]).transform(df))
    columns = [F.col(label).cast("double").alias("y"), F.col(weight).cast("double").alias("w")]
    leaves = vector_to_array("leaves").cast("array<int>").alias("leaves")
    sums = df.agg(F.sum(F.col(weight) * F.col(label)), F.sum(F.col(weight) * (1 - F.col(label)))).first()
    start = math.log(sums[0] / sums[1]) if sums[0] and sums[1] else 0.0
    state = settle_table(placed.select(*columns, leaves, F.lit(start).alias("margin")), "leaves")
    rows: list[tuple] = []
    total = trees.getNumTrees
    for first in range(0, total, block):
        last, margin = min(first + block, total), F.col("margin")
        for tree in range(first, last):
            at = F.get("leaves", F.lit(tree - first))
            p = 1 / (1 + F.exp(-F.col("m")))
            # log(1 + exp(-|m|)) stays finite.
            loss = F.greatest(F.col("m"), F.lit(0.0)) - F.col("m") * F.col("y") + F.log1p(F.exp(-F.abs("m")))
            found = (
                state.select("y", "w", at.alias("leaf"), margin.alias("m"))
                .groupBy("leaf")
                .agg(F.count(F.lit(1)), F.sum(F.col("w") * (p - F.col("y"))), F.sum(F.col("w") * p * (1 - p)), F.sum(F.col("w") * loss))
                .collect()  # one row per leaf of the tree
            )
            values = [0.0] * (1 + max((r[0] for r in found), default=0))
            for leaf, n, g, h, value in found:
                values[leaf] = learning_rate * newton_value(g, h, l1, l2)
                rows.append((tree, leaf, n, g, h, value, l1, l2, learning_rate, values[leaf]))
            margin = margin + F.coalesce(_chosen(values, at), F.lit(0.0))
        if last < total:
            used = F.slice("leaves", F.lit(last - first + 1), F.size("leaves")).alias("leaves")
            state = settle_table(state.select("y", "w", used, margin.alias("margin")), "leaves")
    return df.sparkSession.createDataFrame(sorted(rows, key=lambda r: r[:2]), LEAF_SCHEMA), start


def with_leaf_values(model: PipelineModel, leaves: DataFrame, start: float) -> PipelineModel:
    """The model with the values of ``leaves (tree, leaf, value)`` in its nodes, and trees of weight one.

    Spark's classifier doubles the sum of its trees to log odds, so nodes hold half the values; the margin before the
    first tree goes into the first tree's leaves. Leaves are numbered as Spark does, from left to right; those that no
    row reached keep nothing.
    """
    spark = leaves.sparkSession
    old, new = scratch_path(spark, "trees"), scratch_path(spark, "trees")
    model.stages[-1].write().save(old)
    nodes = spark.read.parquet(f"{old}/data").select("treeID", "nodeData.*")
    # One row per node: trees times leaves, both parameters of the model, not of the data.
    counted = nodes.where("leftChild < 0").groupBy("treeID").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    numbers = counted.select("treeID", F.posexplode("ids").alias("leaf", "id"))
    values = leaves.select(F.col("tree").alias("treeID"), "leaf", "value")
    values = numbers.join(values, ["treeID", "leaf"], "left").select("treeID", "id", F.coalesce("value", F.lit(0.0)).alias("value"))
    first = F.when(F.col("treeID") == 0, F.lit(start)).otherwise(F.lit(0.0))
    own = F.when(F.col("leftChild") < 0, (F.col("value") + first) / 2).otherwise(F.col("prediction"))
    fields = [own.alias("prediction") if c == "prediction" else F.col(c) for c in nodes.columns if c != "treeID"]
    nodes.join(values, ["treeID", "id"], "left").select("treeID", F.struct(*fields).alias("nodeData")).write.parquet(f"{new}/data")
    spark.read.parquet(f"{old}/treesMetadata").withColumn("_3", F.lit(1.0)).write.parquet(f"{new}/treesMetadata")
    spark.read.text(f"{old}/metadata").coalesce(1).write.text(f"{new}/metadata")
    return PipelineModel([*model.stages[:-1], GBTClassificationModel.load(new)])


def objective(leaves: DataFrame) -> DataFrame:
    """``(tree, loss, step, rows)``: the weighted log loss before each tree, and what its step adds to the penalised
    second-order objective of the tree; a step never adds more than zero."""
    v = F.col("value")
    gain = F.col("gradient") * v + (F.col("curvature") + F.col("l2")) * v * v / 2 + F.col("l1") * F.abs(v)
    return leaves.groupBy("tree").agg(F.sum("loss").alias("loss"), F.sum(gain).alias("step"), F.sum("rows").alias("rows"))


def penalised(
    df: DataFrame, model: PipelineModel, label: str, weight: str, learning_rate: float, l1: float, l2: float
) -> PipelineModel:
    leaves, start = leaf_table(df, model, label, weight, learning_rate, l1, l2)
    return with_leaf_values(model, settle_table(leaves, "leaf-values"), start)
