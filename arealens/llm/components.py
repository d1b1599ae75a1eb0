"""Connected components of an edge table by alternating large-star and small-star steps.

Every step replaces the edges by at most as many, each pointing to a smaller
node, until they form stars around the smallest node of each component.  The
steps are aggregates and equi-joins, so a node with very many edges is
pre-aggregated and its join partitions can be split.  Each round is written
to the shared folder (that cuts the lineage and survives lost executors) and
the round before it is removed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import discard, materialize


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, component) for every node with an edge to another; component is the smallest node.

    Null ends, loops and repeated edges are ignored; no edge gives no row.
    """
    a, b = F.col(src), F.col(dst)
    now = materialize(edges.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(),
                      "edges")
    while True:
        # large-star: every larger neighbour of u now points to the smallest of u and its neighbours
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small-star: u and its smaller neighbours point to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        joined = large.join(least, "u")
        new = (joined.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
               .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        then = materialize(new, "edges")
        # a star forest: one edge from every node, and no node is both an end and a centre
        check = (then.select(F.col("u").alias("x"), F.lit(1).alias("out"))
                 .unionByName(then.select(F.col("v").alias("x"), F.lit(0).alias("out")).distinct())
                 .groupBy("x").agg(F.sum("out").alias("out"), F.count("*").alias("n"))
                 .agg(F.max(F.when((F.col("out") > 0) & (F.col("n") > 1), 1).otherwise(0)).alias("open")))
        still_open = check.collect()[0]["open"]  # one number
        discard(now)
        now = then
        if not still_open:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
