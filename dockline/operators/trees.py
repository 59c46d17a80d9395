"""Regression trees as tables: a row per node, scored and explained by joins and aggregates."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def saved_nodes(spark: SparkSession, path: str) -> DataFrame:
    """The node table of a saved tree or forest: (tree, node, place, threshold, left, right, prediction, gain, rows).

    ``place`` is the feature that an inner node splits on, -1 in a leaf; rows with a value up to ``threshold`` go left.
    A split on listed categories instead of a threshold is refused: give the trees numeric columns.
    """
    saved = spark.read.parquet(f"{path}/data")
    if "treeID" not in saved.columns:
        saved = saved.select(F.lit(0).alias("treeID"), F.struct(*saved.columns).alias("nodeData"))
    n = F.col("nodeData")
    inner = n["leftChild"] >= 0
    cut = n["split"]["leftCategoriesOrThreshold"]
    threshold = F.when(~inner, None).when(n["split"]["numCategories"] == -1, F.element_at(cut, 1)) \
        .otherwise(F.raise_error(F.lit("a split on categories has no threshold")))
    return saved.select(
        F.col("treeID").cast("int").alias("tree"), n["id"].cast("int").alias("node"),
        F.when(inner, n["split"]["featureIndex"]).otherwise(-1).cast("int").alias("place"), threshold.cast("double").alias("threshold"),
        n["leftChild"].cast("int").alias("left"), n["rightChild"].cast("int").alias("right"), n["prediction"].alias("prediction"),
        n["gain"].alias("gain"), n["rawCount"].cast("double").alias("rows"))


def node_table(model, path: str) -> DataFrame:
    """Saves a fitted tree or forest at ``path`` and reads its nodes."""
    model.write().overwrite().save(path)
    return saved_nodes(SparkSession.getActiveSession(), path)


def importances(nodes: DataFrame, names: list[str]) -> DataFrame:
    """(feature, importance): gains weighted by rows, added up per tree, each tree scaled to 1, averaged and scaled again."""
    spark = nodes.sparkSession
    gains = nodes.where("place >= 0").groupBy("tree", "place").agg(F.sum(F.col("gain") * F.col("rows")).alias("gain"))
    per_tree = gains.groupBy("tree").agg(F.sum("gain").alias("whole"))
    shares = gains.join(per_tree, "tree").groupBy("place").agg(F.sum(F.col("gain") / F.nullif("whole", F.lit(0.0))).alias("share"))
    total = shares.agg(F.sum("share")).first()[0] or 1.0  # one number
    known = spark.createDataFrame(list(enumerate(names)), "place int, feature string")
    return known.join(shares, "place", "left").select("feature", F.coalesce(F.col("share") / F.lit(total), F.lit(0.0)).alias("importance"))


def scored_by_nodes(rows: DataFrame, nodes: DataFrame, key: list[str], features: list[str], trees: int, depth: int) -> DataFrame:
    """(key, prediction): the mean over the trees, every row walked down all trees level by level.

    A level is an equality join of (tree, node) with the node table. A row that has reached a leaf stays there.
    """
    values = rows.select(*key, F.array(*[F.col(f).cast("double") for f in features]).alias("x"))
    inner = nodes.select("tree", "node", "place", "threshold", "left", "right")
    at = values.select(*key, "x", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"), F.lit(0).alias("node"))
    for _ in range(depth):
        down = F.when(F.element_at("x", F.col("place") + 1) <= F.col("threshold"), F.col("left")).otherwise(F.col("right"))
        at = at.join(inner, ["tree", "node"]).select(
            *key, "x", "tree", F.when(F.col("place") < 0, F.col("node")).otherwise(down).alias("node"))
    return at.join(nodes.select("tree", "node", "prediction"), ["tree", "node"]).groupBy(*key).agg(F.avg("prediction").alias("prediction"))


def fit_tree(rows: DataFrame, features: list[str], target: str, depth: int = 2, seed: int = 42):
    """One regression tree on plain numeric columns, all rows and all columns."""
    vectors = VectorAssembler(inputCols=features, outputCol="features").transform(
        rows.select(*[F.col(f).cast("double").alias(f) for f in features], F.col(target).cast("double").alias(target))).select("features", target)
    return DecisionTreeRegressor(featuresCol="features", labelCol=target, maxDepth=depth, seed=seed).fit(vectors)


def split_report(nodes: DataFrame, names: list[str]) -> DataFrame:
    """(node, feature, threshold, rows, prediction) of one tree, nodes numbered as in a heap: the children of k are 2k and 2k + 1."""
    spark = nodes.sparkSession
    known = spark.createDataFrame(list(enumerate(names)), "place int, feature string")
    depth, heap = 0, nodes.where("node = 0").select("node", F.lit(1).cast("bigint").alias("heap"))
    out = heap
    while depth < 62:
        inner = heap.join(nodes.where("place >= 0"), "node")
        heap = inner.select(F.explode(F.array(
            F.struct(F.col("left").alias("node"), (2 * F.col("heap")).alias("heap")),
            F.struct(F.col("right").alias("node"), (2 * F.col("heap") + 1).alias("heap")))).alias("c")).select("c.*")
        if heap.isEmpty():
            break
        out, depth = out.unionByName(heap), depth + 1
    return out.join(nodes, "node").join(known, "place", "left").select(F.col("heap").alias("node"), "feature", "threshold", "rows", "prediction")
