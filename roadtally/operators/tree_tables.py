"""A fitted ensemble as a table of nodes, and scores by joins on it."""

from __future__ import annotations

from pyspark.ml.regression import (
    DecisionTreeRegressionModel,
    GBTRegressionModel,
    RandomForestRegressionModel,
)
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from roadtally.session import broadcast_if_small, cut_lineage, scratch_path


def tree_nodes(spark: SparkSession, model) -> DataFrame:
    """``tree, node, feature, threshold, left, right, value, weight`` of a fitted regression model.

    Read from the model as Spark stores it, in the shared folder.  A leaf has no feature.  ``value``
    is the mean of a node's training rows, ``weight`` what a tree counts in the sum of all.  Splits by
    categories are refused: the features of this library are numbers.
    """
    path = scratch_path(spark, "model")
    model.save(path)
    stored = spark.read.parquet(f"{path}/data")
    if isinstance(model, DecisionTreeRegressionModel):
        weights = [1.0]
        rows = stored.select(F.lit(0).alias("tree"), F.struct("*").alias("at"))
    elif isinstance(model, (GBTRegressionModel, RandomForestRegressionModel)):
        weights = list(model.treeWeights)
        if isinstance(model, RandomForestRegressionModel):
            weights = [1.0 / len(weights)] * len(weights)
        rows = stored.select(F.col("treeID").alias("tree"), F.col("nodeData").alias("at"))
    else:
        raise TypeError(f"{type(model).__name__} is no regression tree or ensemble of them")
    inner = F.col("at.leftChild") >= 0
    nodes = rows.select(
        F.col("tree").cast("int").alias("tree"),
        F.col("at.id").cast("int").alias("node"),
        F.when(inner, F.col("at.split.featureIndex")).cast("int").alias("feature"),
        F.when(inner, F.col("at.split.leftCategoriesOrThreshold")[0]).alias("threshold"),
        F.when(inner, F.col("at.leftChild")).cast("int").alias("left"),
        F.when(inner, F.col("at.rightChild")).cast("int").alias("right"),
        F.col("at.prediction").alias("value"),
        F.when(inner, F.col("at.split.numCategories")).alias("categories"),
    )
    if not nodes.where(F.col("categories") >= 0).isEmpty():
        raise ValueError("the model splits by categories")
    by_tree = F.array(*[F.lit(float(w)) for w in weights])
    return cut_lineage(nodes.drop("categories").withColumn("weight", by_tree[F.col("tree")]))


def tree_scores(df: DataFrame, nodes: DataFrame, key: str, features: Column) -> DataFrame:
    """``key, prediction``: every row goes down every tree, a join on (tree, node) for each level.

    ``features`` is an array of doubles in the order the model was fitted on.  The nodes are
    broadcast once their size is measured.  Rows that are done stay in place: a join of a level only
    moves on those at an inner node, so the depth of the trees is the number of joins, and all joins
    of a small model are one stage without a shuffle.  ``key`` tells rows apart; a null key is a
    key like any other.  A null in a feature that decides goes right, as a NaN does.
    """
    levels = _depth(nodes)
    table = broadcast_if_small(
        nodes.select(
            F.col("tree").alias("_t"), F.col("node").alias("_n"), "feature", "threshold", "left", "right", "value", "weight"
        ),
        stored=True,
    )
    trees = F.explode(F.array(*[F.lit(t) for t in _trees(nodes)])).alias("tree")
    at = df.select(F.col(key).alias("key"), features.alias("x"), trees).withColumn("node", F.lit(0))
    for _ in range(levels):
        met = at.join(table, (F.col("tree") == F.col("_t")) & (F.col("node") == F.col("_n")))
        goes_left = F.coalesce(F.get("x", F.col("feature")) <= F.col("threshold"), F.lit(False))
        step = F.when(F.col("feature").isNull(), F.col("node")).otherwise(F.when(goes_left, F.col("left")).otherwise(F.col("right")))
        at = met.select("key", "x", "tree", step.alias("node"))
    last = at.join(table, (F.col("tree") == F.col("_t")) & (F.col("node") == F.col("_n")))
    return last.groupBy(F.col("key").alias(key)).agg(F.sum(F.col("value") * F.col("weight")).alias("prediction"))


def _trees(nodes: DataFrame) -> list[int]:
    return sorted(r["tree"] for r in nodes.where("node = 0").select("tree").collect())


def _depth(nodes: DataFrame) -> int:
    """Levels below the roots; nodes are numbered in preorder, so walk them from the roots down."""
    arcs = nodes.where(F.col("feature").isNotNull()).select(
        F.col("tree").alias("_t"), F.col("node").alias("_n"), F.explode(F.array("left", "right")).alias("next")
    )
    arcs = broadcast_if_small(arcs, stored=True)
    level, depth = nodes.where("node = 0").select("tree", "node"), 0
    while True:
        joined = level.join(arcs, (F.col("tree") == F.col("_t")) & (F.col("node") == F.col("_n")))
        level = cut_lineage(joined.select("tree", F.col("next").alias("node")))
        if level.isEmpty():
            return depth
        depth += 1
