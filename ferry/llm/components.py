"""Connected components of a graph of links, in rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferry.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """`node, root` for every node of the links `a, b` (longs): the smallest node that can be reached.

    In each round every node takes its smallest neighbour, if that is smaller, as parent; pointers are then doubled
    until they reach a root, and links are rewritten to roots. Links inside a tree vanish, so the rounds end when none
    is left. Minima are summed up before they are shuffled, so a node with very many links costs a task no more than
    others. Each round is a written table. Only counts reach the driver.
    """
    left = stored(_both(links))
    labels = None
    while not left.isEmpty():
        parents = left.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
        parents = stored(parents.withColumn("root", F.least("node", "root")))
        while True:
            above = parents.select(F.col("node").alias("root"), F.col("root").alias("top"))
            jumped = stored(
                parents.join(above, "root").select(
                    "node", F.col("top").alias("root"), (F.col("top") != F.col("root")).alias("moved")
                )
            )
            parents = jumped.select("node", "root")
            if jumped.filter("moved").isEmpty():
                break
        to = parents.withColumnRenamed("node", "old")
        if labels is None:
            labels = parents
        else:
            renamed = labels.join(to.withColumnRenamed("root", "new"), labels.root == F.col("old"), "left")
            labels = stored(renamed.select("node", F.coalesce("new", "root").alias("root")))
        moved = left.join(to.select(F.col("old").alias("a"), F.col("root").alias("x")), "a").join(
            to.select(F.col("old").alias("b"), F.col("root").alias("y")), "b"
        )
        left = stored(moved.filter("x != y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct())
    if labels is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root")).limit(0)
    return labels


def _both(links: DataFrame) -> DataFrame:
    """Each link once in either direction, none from a node to itself."""
    there = links.filter("a != b").select("a", "b")
    return there.union(there.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
