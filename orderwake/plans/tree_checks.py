"""Fitted trees held against the rows that they were fitted on.

A saved tree model is a table of nodes. The leaf that each tree gives a row comes from the model
itself; what a leaf's value has to be follows from the rows in it. Rows are sent through all trees
in one pass and summed per tree and leaf, so only as many rows are shuffled as there are leaves.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .features import LABEL

#: Relative error up to which two sums of the same numbers agree.
CLOSE = 1e-6


def tree_nodes(model: PipelineModel, path: str, frame: DataFrame) -> DataFrame:
    """(tree, node, prediction, stats, rows, gain, feature, leaf) of a model's last stage, saved below `path`.

    `leaf` numbers the leaves of a tree from left to right, as the model does, and is NULL for inner nodes.
    """
    model.stages[-1].write().overwrite().save(path)
    nodes = frame.sparkSession.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    is_leaf = F.col("leftChild") < 0
    left_to_right = Window.partitionBy("treeID", is_leaf).orderBy("id")  # as many rows as a tree has leaves
    return nodes.select(
        F.col("treeID").alias("tree"),
        F.col("id").alias("node"),
        "prediction",
        F.col("impurityStats").alias("stats"),
        F.col("rawCount").alias("rows"),
        "gain",
        F.when(~is_leaf, F.col("split.featureIndex")).alias("feature"),
        F.when(is_leaf, F.row_number().over(left_to_right) - 1).alias("leaf"),
    )


def _leaves(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """The rows with `leaves`, the number of the leaf in each tree."""
    trees = model.stages[-1]
    trees.setLeafCol("leaf_vector")
    try:
        found = model.transform(rows)
    finally:
        trees.setLeafCol("")
    return found.select(*rows.columns, F.transform(vector_to_array("leaf_vector"), lambda leaf: leaf.cast("int")).alias("leaves"))


def _values(nodes: DataFrame) -> Column:
    """Leaf values by tree and leaf, as an array of arrays: one row, bounded by the size of the model."""
    per_tree = nodes.filter("leaf is not null").groupBy("tree").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("leaf", "prediction"))), lambda e: e["prediction"]).alias("values")
    )
    return per_tree.agg(F.transform(F.array_sort(F.collect_list(F.struct("tree", "values"))), lambda e: e["values"])).scalar()


def boosted_leaves(
    model: PipelineModel, nodes: DataFrame, rows: DataFrame, target: Column, residual: Callable[[Column, Column], Column], weight: Column
) -> DataFrame:
    """(tree, n_rows, is_mean) of boosted trees: is each leaf the weighted mean of what the trees before it leave over?

    `residual` gives what a tree is fitted on, from the target and the sum of the trees before; the first tree is
    fitted on the target itself.
    """
    weights = F.array(*map(F.lit, model.stages[-1].treeWeights))
    placed = _leaves(model, rows.withColumns({"_target": target, "_weight": weight}))
    placed = placed.select("_target", "_weight", "leaves", _values(nodes).alias("values"))
    placed = placed.withColumn(
        "parts", F.transform("leaves", lambda leaf, tree: F.get(F.get("values", tree), leaf) * F.get(weights, tree))
    )
    each = F.transform(
        "leaves",
        lambda leaf, tree: F.struct(
            tree.alias("tree"), leaf.alias("leaf"), F.aggregate(F.slice("parts", F.lit(1), tree), F.lit(0.0), lambda a, b: a + b).alias("before")
        ),
    )
    met = placed.select("_target", "_weight", F.explode(each).alias("at")).select("_target", "_weight", "at.*")
    met = met.withColumn("_left", F.when(F.col("tree") == 0, F.col("_target")).otherwise(residual(F.col("_target"), F.col("before"))))
    sums = met.groupBy("tree", "leaf").agg(
        (F.sum(F.col("_left") * F.col("_weight")) / F.sum("_weight")).alias("mean"), F.count(F.lit(1)).alias("n")
    )
    agrees = F.abs(F.col("mean") - F.col("prediction")) <= CLOSE * F.greatest(F.abs("mean"), F.lit(1.0))
    return _per_tree(nodes, sums, agrees)


def forest_leaves(model: PipelineModel, nodes: DataFrame, rows: DataFrame, weight: Column, label: str = LABEL) -> DataFrame:
    """(tree, n_rows, is_mean) of classification trees fitted on all rows: has each leaf the class weights of its rows?"""
    placed = _leaves(model, rows.withColumn("_weight", weight))
    met = placed.select(label, "_weight", F.posexplode("leaves").alias("tree", "leaf"))
    sums = met.groupBy("tree", "leaf").agg(
        F.sum(F.when(F.col(label) == 0, F.col("_weight")).otherwise(0.0)).alias("zeros"),
        F.sum(F.when(F.col(label) == 1, F.col("_weight")).otherwise(0.0)).alias("ones"),
        F.count(F.lit(1)).alias("n"),
    )
    whole = F.col("zeros") + F.col("ones")
    agrees = (F.abs(F.col("stats")[0] - F.col("zeros")) <= CLOSE * whole) & (F.abs(F.col("stats")[1] - F.col("ones")) <= CLOSE * whole)
    return _per_tree(nodes, sums, agrees)


def _per_tree(nodes: DataFrame, sums: DataFrame, agrees: Column) -> DataFrame:
    """Every leaf of the model must have met rows, as many as it was fitted on."""
    both = nodes.filter("leaf is not null").join(sums, ["tree", "leaf"], "full")
    fits = F.coalesce(agrees & (F.col("rows") == F.col("n")), F.lit(False))
    return both.groupBy("tree").agg(F.sum("n").alias("n_rows"), F.bool_and(fits).alias("is_mean"))


def importance_from_nodes(nodes: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, importance, n_trees): each feature's share of the gain of all splits, weighted by their rows.

    Shares are taken within each tree, then over all trees.
    """
    gained = F.col("gain") * F.aggregate("stats", F.lit(0.0), lambda a, b: a + b)
    per_tree = nodes.filter("feature is not null").groupBy("tree", "feature").agg(F.sum(gained).alias("gained"))
    share = F.col("gained") / F.sum("gained").over(Window.partitionBy("tree"))
    shares = per_tree.select("feature", share.alias("share")).groupBy("feature").agg(F.sum("share").alias("share"))
    totals = shares.agg(F.sum("share")).scalar()
    trees = nodes.agg(F.count_distinct("tree")).scalar()
    names = nodes.sparkSession.createDataFrame(list(enumerate(features)), "feature int, name string")
    # One row per feature on both sides.
    return names.join(shares, "feature", "left").select(
        F.col("name").alias("feature"), F.coalesce(F.col("share") / totals, F.lit(0.0)).alias("importance"), trees.alias("n_trees")
    )
