"""Connected components by alternating star contraction, all in joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.store import stored


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``label`` for every node of the undirected edges ``a``, ``b``: the smallest node reachable.

    Each round links every node's larger neighbours to its smallest (large star) and then its
    smaller ones (small star) and stores the edges. The number of rounds grows with the logarithm
    of the component size. Only whether edges still change comes to the driver. No edges: no rows.
    """
    edges = stored(edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    while True:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: every node points to the smallest of its smaller neighbours, and so do they.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        small = stored(small.select("e.u", "e.v").where("u != v").distinct(), "edges")
        # Stars only: no node that points to another is pointed to.
        done = small.join(small.select(F.col("v").alias("u")).distinct(), "u", "left_semi").isEmpty() and (
            small.groupBy("u").count().where("count > 1").isEmpty()
        )
        edges = small
        if done:
            roots = edges.select(F.col("v").alias("node")).distinct()
            return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).union(roots.select("node", F.col("node").alias("label")))
