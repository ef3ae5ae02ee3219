"""Connected components of a table of links, by hooking and pointer jumping over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.storage import stable


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in ``links`` (a, b); the root is the smallest node of its component.

    Union-find in rounds: every node hooks on its smallest neighbour, pointers jump until they end at a root, and links
    are put between roots, until none is left. Each round at least halves the nodes of a component; every step is
    written, so a lost executor never repeats earlier rounds.
    """
    both = links.where(F.col("a") != F.col("b")).select("a", "b")
    edges = stable(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    found = stable(edges.select(F.col("a").alias("node")).distinct().withColumn("root", F.col("node")))
    while not edges.isEmpty():
        lowest = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("_b"))
        parent = stable(lowest.select("node", F.least("node", "_b").alias("root")))
        while True:
            above = parent.select(F.col("node").alias("root"), F.col("root").alias("_up"))
            jumped = stable(parent.join(above, "root").select("node", F.col("_up").alias("root"), (F.col("_up") != F.col("root")).alias("_moved")))
            parent = jumped.drop("_moved")
            if jumped.where("_moved").isEmpty():
                break
        top = parent.select(F.col("node").alias("root"), F.col("root").alias("_top"))
        found = stable(found.join(top, "root", "left").select("node", F.coalesce("_top", "root").alias("root")))
        a = parent.select(F.col("node").alias("a"), F.col("root").alias("_a"))
        b = parent.select(F.col("node").alias("b"), F.col("root").alias("_b"))
        edges = stable(
            edges.join(a, "a").join(b, "b").where(F.col("_a") != F.col("_b")).select(F.col("_a").alias("a"), F.col("_b").alias("b")).distinct()
        )
    return found
