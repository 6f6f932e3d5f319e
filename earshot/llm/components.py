"""Connected components of links between rows, as union-find by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (a, b); the root is the smallest node of its component.

    Union: every root that has a smaller neighbour hangs itself under the
    smallest one. Find: every node takes its parent's parent until nothing
    moves, which halves the depth each time. Links between different trees go
    on to the next round. Every step is a written table, so a lost executor
    costs no more than a step, and only counts come to the driver.
    """
    pairs = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct()
    pairs = materialize(pairs, "links")
    nodes = pairs.select("a").union(pairs.select("b")).distinct().select(F.col("a").alias("node"), F.col("a").alias("root"))
    while not pairs.isEmpty():
        parents = materialize(pairs.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("up")), "parents")
        while True:
            above = parents.select(F.col("node").alias("up"), F.col("up").alias("top"))
            jumped = materialize(
                parents.join(above, "up", "left").select("node", F.coalesce("top", "up").alias("up"), F.col("top").isNotNull().alias("moved")),
                "parents",
            )
            parents = jumped.select("node", "up")
            if jumped.filter("moved").isEmpty():
                break
        nodes = materialize(
            nodes.join(parents.select(F.col("node").alias("root"), "up"), "root", "left").select("node", F.coalesce("up", "root").alias("root")),
            "roots",
        )
        ends = pairs
        for end in ("a", "b"):
            ends = ends.join(parents.select(F.col("node").alias(end), F.col("up").alias(f"{end}_up")), end, "left")
            ends = ends.withColumn(end, F.coalesce(f"{end}_up", end)).drop(f"{end}_up")
        pairs = materialize(ends.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct(), "links")
    return nodes
