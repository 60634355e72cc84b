"""Connected components of a link table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genenet_spark.llm.common import discard, freeze


def components(links: DataFrame) -> DataFrame:
    """``node, comp`` of every node of ``links(a, b)``: ``comp`` is some node of the same component.

    Each round every node takes its least neighbour (or itself) as parent and the links are rewritten to
    parents; the links between different parents that are left go to the next round. A node that is not the
    least of its neighbours is gone after a round, so the number of rounds grows with the logarithm of the
    nodes. Tables are stored between rounds and deleted after them, but for the result, which the caller may ``discard``; only
    their emptiness is asked by the driver.
    """
    edges = freeze(links.select("a", "b").where("a <> b").distinct(), "links")
    labels = freeze(edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct().withColumn("comp", F.col("node")), "labels")
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = both.groupBy("a").agg(F.min("b").alias("p")).select(F.col("a").alias("u"), F.least("a", "p").alias("p"))
        grand = parent.select(F.col("u").alias("v"), F.col("p").alias("q"))  # one step of pointer jumping
        old = [edges, labels]
        parent = freeze(parent.join(grand, F.col("p") == F.col("v"), "left").select("u", F.coalesce("q", "p").alias("p")), "parents")
        labels = freeze(labels.join(parent, F.col("comp") == F.col("u"), "left").select("node", F.coalesce("p", "comp").alias("comp")), "labels")
        left, right = parent.select(F.col("u").alias("a"), F.col("p").alias("pa")), parent.select(F.col("u").alias("b"), F.col("p").alias("pb"))
        edges = edges.join(left, "a").join(right, "b").select(F.col("pa").alias("a"), F.col("pb").alias("b")).where("a <> b")
        edges = freeze(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
        discard(parent, *old)
    discard(edges)
    return labels
