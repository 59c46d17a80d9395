"""Connected components of a link table, by alternating large and small stars.

Both steps keep the components and bring every node nearer to its smallest member; each is one grouping that
Spark combines before the shuffle, and one join. Links are written to the shared folder after every round,
so lost executors cost a round at most. Only two counts reach the driver.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockline.session import cut_lineage


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); root is the smallest node of the component.

    Loops and repeated links change nothing; nodes without a link to another node are not returned.
    """
    now = cut_lineage(links.select("a", "b").where("a != b").distinct(), "links")
    while True:
        two_way = _both_ways(now)
        least = two_way.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = two_way.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # Here every row points from a node to a smaller one; each node hands its other targets to its least.
        down = large.distinct()
        target = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(target, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"),
                                              F.col("m").alias("b")).where("a != b").distinct()
        after = cut_lineage(small, "links")
        # Stars at last: every node points once, and at a node that points nowhere.
        inner = after.join(after.select(F.col("a").alias("b")), "b", "left_semi").isEmpty()
        if inner and after.count() == after.select("a").distinct().count():
            return after.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
                after.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        now = after


def local_roots(size: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For the nodes 0 .. size-1 the smallest node of their component, links given as two arrays."""
    root = np.arange(size)
    while True:
        ra, rb = root[a], root[b]
        low, high = np.minimum(ra, rb), np.maximum(ra, rb)
        if (low == high).all():
            return root
        np.minimum.at(root, high, low)
        while True:  # follow every chain to its end
            shorter = root[root]
            if (shorter == root).all():
                break
            root = shorter
