"""Connected components of an edge table by rounds of hooking and contraction, all distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import forgotten


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """edges (a, b) -> (node, label): nodes of one component have one label, its smallest node.

    In each round a label takes the smallest label next to it as its parent, parents are followed four
    steps, and the edges are rewritten to what is left. Hot labels only meet in joins, which adaptive
    execution splits, and in a minimum, which is taken before the shuffle. Null ends are dropped.
    """
    edges = forgotten(edges.where("a is not null and b is not null and a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    nodes = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    labels = forgotten(nodes.select("node", F.col("node").alias("label")))
    for _ in range(most_rounds):
        if edges.isEmpty():
            return labels
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = both.groupBy("a").agg(F.min("b").alias("p")).select(F.col("a").alias("x"), F.least("a", "p").alias("p"))
        for _ in range(2):
            up = parent.select(F.col("x").alias("p"), F.col("p").alias("q"))
            parent = forgotten(parent.join(up, "p", "left").select("x", F.coalesce("q", "p").alias("p")))
        moved = lambda df, c: df.join(parent.select(F.col("x").alias(c), F.col("p").alias("_p")), c, "left").withColumn(c, F.coalesce("_p", c)).drop("_p")
        labels = forgotten(moved(labels, "label"))
        edges = forgotten(moved(moved(edges, "a"), "b").where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    raise RuntimeError("components did not settle")
