"""Fitted trees as rows, and scoring as a walk of joins (M-06, M-07, M-22).

A tree model is saved by Spark as Parquet rows of nodes; read back, they are a
table (tree, node, feature, cut, children) that can be joined, counted and
compared like any other.  Its size is the model's, not the data's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_path


def node_table(spark, model) -> DataFrame:
    """One row a node: (tree, weight, node, feature, cut, left, right, gain, n, prediction, stats).

    ``cut`` is the largest feature value that goes left; a leaf has null feature,
    cut, children and gain.  ``weight`` is the tree's weight in the ensemble,
    ``stats`` the node's class counts (classification).  Categorical splits aren't supported.
    """
    path = shared_path(spark, "tree-model")
    model.write().overwrite().save(path)
    # saved without names: tree, its parameters, its weight
    weights = spark.read.parquet(f"{path}/treesMetadata").toDF("tree", "parameters", "weight").drop("parameters")
    n, split = F.col("nodeData"), F.col("nodeData.split")
    inner = n["leftChild"] >= 0
    kind = F.when(inner & (split["numCategories"] >= 0), F.raise_error(F.lit("categorical split")))
    nodes = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), n["id"].alias("node"),
        F.when(inner, split["featureIndex"]).alias("feature"),
        F.coalesce(kind.cast("double"), F.when(inner, split["leftCategoriesOrThreshold"][0])).alias("cut"),
        F.when(inner, n["leftChild"]).alias("left"), F.when(inner, n["rightChild"]).alias("right"),
        F.when(inner, n["gain"]).alias("gain"), n["rawCount"].alias("n"), n["prediction"].alias("prediction"),
        n["impurityStats"].alias("stats"))
    return nodes.join(weights, "tree")


def walk(nodes: DataFrame, rows: DataFrame, key: str, features: str, trees: int, depth: int) -> DataFrame:
    """The leaf that each row reaches in each tree: (key, tree, weight, node, prediction, stats).

    ``features`` is an array column; ``trees`` their number, ``depth`` the most levels below a root.  Each
    level is one join of (row, tree) states with the nodes, by tree and node.  Null
    features go right, as NaN does.
    """
    step = nodes.select("tree", "node", "feature", "cut", "left", "right")
    at = rows.select(key, features, F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"),
                     F.lit(0).alias("node"))  # every tree's root is its node 0
    for _ in range(depth):
        goes_left = F.coalesce(F.element_at(features, F.col("feature") + 1) <= F.col("cut"), F.lit(False))
        at = (at.join(step, ["tree", "node"])
              .select(key, features, "tree", F.when(F.col("feature").isNull(), F.col("node"))
                      .when(goes_left, F.col("left")).otherwise(F.col("right")).alias("node")))
    return at.select(key, "tree", "node").join(
        nodes.select("tree", "node", "weight", "prediction", "stats"), ["tree", "node"])


def vote(leaves: DataFrame, key: str) -> DataFrame:
    """Forest predictions (key, prediction) of ``walk``: the class of most summed leaf shares, the lower on a tie."""
    total = F.aggregate("stats", F.lit(0.0), lambda a, x: a + x)
    share = F.posexplode(F.transform("stats", lambda x: x / total)).alias("label", "share")
    sums = leaves.select(key, share).groupBy(key, "label").agg(F.sum("share").alias("share"))
    best = F.max_by("label", F.struct(F.round("share", 9), -F.col("label")))
    return sums.groupBy(key).agg(best.cast("double").alias("prediction"))


def margin(leaves: DataFrame, key: str) -> DataFrame:
    """Boosted margins (key, margin) of ``walk``: the weighted sum of the trees' predictions."""
    return leaves.groupBy(key).agg(F.sum(F.col("weight") * F.col("prediction")).alias("margin"))
