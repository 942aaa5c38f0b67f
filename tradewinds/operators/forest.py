"""Exact attribution of a fitted random forest's score to its features.

A saved forest is a table of nodes. Every step from a node to its child moves
the expected win rate by some amount, which is the contribution of the feature
that the node splits on. Along a path from root to leaf the steps add up to the
leaf's win rate; the forest's score is the mean over its trees. So a trade's
score is the base (mean win rate of the roots) plus the contributions of its
features, with nothing left over.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tradewinds.operators import learn
from tradewinds.session import cut_lineage, scratch_path

_ROW_LIMIT = "spark.sql.cteRecursionRowLimit"


def node_table(spark: SparkSession, forest) -> DataFrame:
    """``tree, node, left, right, feature, win_rate`` of every node of a fitted forest, read from its saved form. A leaf has no children."""
    path = scratch_path(spark, "forest")
    forest.write().save(path)
    stats = F.col("nodeData.impurityStats")
    return spark.read.parquet(path + "/data").select(
        F.col("treeID").alias("tree"), F.col("nodeData.id").alias("node"), F.col("nodeData.leftChild").alias("left"),
        F.col("nodeData.rightChild").alias("right"), F.col("nodeData.split.featureIndex").alias("feature"),
        (stats[1] / F.aggregate(stats, F.lit(0.0), lambda a, x: a + x)).alias("win_rate"))


def leaf_contributions(nodes: DataFrame) -> DataFrame:
    """``tree, leaf, parts``: what each feature adds on the way to each leaf, as an array of (feature, delta). Leaves count from the left.

    The paths are climbed by one recursive query over the nodes; a forest has a
    bounded number of them, whatever the number of trades.
    """
    spark = nodes.sparkSession
    inner = nodes.where("left >= 0")
    edges = inner.select("tree", F.col("node").alias("parent"), "feature", F.col("win_rate").alias("before"),
                         F.explode(F.array("left", "right")).alias("node"))
    edges = cut_lineage(edges.join(nodes.select("tree", "node", F.col("win_rate").alias("after"), (F.col("left") < 0).alias("ends")), ["tree", "node"]).select(
        "tree", "node", "parent", "feature", "ends", (F.col("after") - F.col("before")).alias("delta")))
    before = spark.conf.get(_ROW_LIMIT, None)
    spark.conf.set(_ROW_LIMIT, "-1")
    try:
        steps = cut_lineage(spark.sql("""
            with recursive climb(tree, leaf, at, feature, delta) as (
                select tree, node, parent, feature, delta from {edges} where ends
                union all
                select c.tree, c.leaf, e.parent, e.feature, e.delta from climb c join {edges} e on e.tree = c.tree and e.node = c.at)
            select tree, leaf, feature, delta from climb""", edges=edges))
    finally:
        if before is None:
            spark.conf.unset(_ROW_LIMIT)
        else:
            spark.conf.set(_ROW_LIMIT, before)
    numbers = nodes.where("left < 0").select("tree", F.col("node").alias("leaf"), (F.row_number().over(
        Window.partitionBy("tree").orderBy("node")) - 1).alias("nth"))
    summed = steps.groupBy("tree", "leaf", "feature").agg(F.sum("delta").alias("delta")).groupBy("tree", "leaf").agg(
        F.collect_list(F.struct("feature", "delta")).alias("parts"))
    return summed.join(numbers, ["tree", "leaf"]).select("tree", F.col("nth").alias("leaf"), "parts")


def forest_attribution(model: PipelineModel, trades: DataFrame, key: str = "fill_seq") -> tuple[DataFrame, float]:
    """(``key, feature, contribution`` of every trade and feature that moved its score, the base score).

    For every trade, base and contributions add up to the model's win
    probability. A trade meets one leaf of each tree; contributions are summed
    within tasks before trades meet.
    """
    spark, forest = trades.sparkSession, model.stages[-1]
    encoder = PipelineModel(stages=model.stages[:-1])
    nodes = cut_lineage(node_table(spark, forest))
    leaves = cut_lineage(leaf_contributions(nodes))
    base = nodes.where("node = 0").agg(F.avg("win_rate")).first()[0]
    names = F.array(*[F.lit(n) for n in learn.feature_names(encoder)])
    placed = forest.copy().setLeafCol("_leaves").transform(encoder.transform(trades)).select(
        key, F.posexplode(vector_to_array("_leaves")).alias("tree", "leaf"))
    met = placed.withColumn("leaf", F.col("leaf").cast("int")).join(leaves, ["tree", "leaf"])
    parts = met.select(key, F.explode("parts").alias("p")).groupBy(key, "p.feature").agg((F.sum("p.delta") / forest.getNumTrees).alias("contribution"))
    return parts.select(key, F.element_at(names, F.col("feature") + 1).alias("feature"), "contribution"), base
