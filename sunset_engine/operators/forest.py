"""Fitted forests as rows, and predictions by walking them (M1-M3, M7).

A saved forest is a table of nodes: (tree, node, feature, threshold, left, right, value). Node numbers of a tree
run from 0, the root; a leaf has no feature. Scoring needs no model library: every row walks
all trees as array lookups in one projection, so it runs wherever the rows lie, without a join or a
shuffle. The forest itself is a constant of the plan; its size is counted first, and ``MAX_NODES`` bounds it.
"""

from __future__ import annotations

import os

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A forest of 100 trees of depth 10 has at most 204,700 nodes, of some 80 bytes as text.
MAX_NODES = 250_000
NODE = "tree int, node int, feature int, threshold double, left int, right int, value double"


def node_table(spark: SparkSession, path: str) -> DataFrame:
    """The nodes of the forest that ends the pipeline saved at ``path``: ``NODE``."""
    stages = PipelineModel.load(path).stages
    data = spark.read.parquet(os.path.join(path, "stages", f"{len(stages) - 1}_{stages[-1].uid}", "data"))
    n = F.col("nodeData")
    inner = n["leftChild"] >= 0
    if not data.where(n["split"]["numCategories"] >= 0).isEmpty():
        raise ValueError("the forest splits on categories; its nodes have no thresholds")
    return data.select(F.col("treeID").alias("tree"), n["id"].alias("node"), F.when(inner, n["split"]["featureIndex"]).alias("feature"),
                       F.when(inner, n["split"]["leftCategoriesOrThreshold"][0]).alias("threshold"), F.when(inner, n["leftChild"]).alias("left"),
                       F.when(inner, n["rightChild"]).alias("right"), n["prediction"].alias("value"))


def as_array(nodes: DataFrame) -> Column:
    """The forest as one constant: an array of trees, each an array of nodes in the order of their numbers."""
    n = nodes.count()
    if not 0 < n <= MAX_NODES:
        raise ValueError(f"a forest of {n} nodes; 1 to {MAX_NODES} can be walked as an array")
    gaps = nodes.groupBy("tree").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("node").alias("d"), F.min("node").alias("lo"), F.max("node").alias("hi"))
    if not gaps.where("n <> d or lo <> 0 or hi <> n - 1").isEmpty():
        raise ValueError("the nodes of a tree must be numbered from 0 without gaps")
    node = F.struct("node", "feature", "threshold", "left", "right", "value")
    trees = nodes.groupBy("tree").agg(F.sort_array(F.collect_list(node)).alias("nodes"))
    whole = trees.agg(F.sort_array(F.collect_list(F.struct("tree", "nodes"))).alias("t"))
    text = whole.select(F.to_json(F.struct(F.col("t.nodes").alias("trees")))).first()[0]          # MAX_NODES bounds it
    kind = "struct<trees:array<array<struct<node:int,feature:int,threshold:double,left:int,right:int,value:double>>>>"
    return F.from_json(F.lit(text), kind)["trees"]


def walked(nodes: DataFrame, features: list[str], depth: int) -> Column:
    """Mean of the trees' values for a row: at a node, left if the feature is at most the threshold, else right.

    ``depth`` is the number of steps that reach every leaf. A missing feature value goes right, as NaN does.
    """
    values = F.array(*[F.col(f"`{f}`").cast("double") for f in features])

    def leaf(tree: Column) -> Column:
        def step(at: Column, _: Column) -> Column:
            node = F.get(tree, at)
            return F.when(node["feature"].isNull(), at).when(F.get(values, node["feature"]) <= node["threshold"], node["left"]).otherwise(node["right"])

        return F.get(tree, F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.lit(0), step) if depth else F.lit(0))["value"]

    forest = as_array(nodes)
    return F.aggregate(F.transform(forest, leaf), F.lit(0.0), lambda s, v: s + v) / F.size(forest)


def score(df: DataFrame, nodes: DataFrame, features: list[str], depth: int, prediction: str = "prediction") -> DataFrame:
    """``df`` with the forest's ``prediction``: the rows are scanned once, where they are."""
    return df.withColumn(prediction, walked(nodes, features, depth))
