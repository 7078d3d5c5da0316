"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sieveline.llm.common import discard, stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Rows (node, component) for every node with a link; component is its smallest reachable node.

    Each round points all larger neighbours of a node to its smallest neighbour, then does
    the same for the smaller ones. A hot node costs a map-side combined minimum and a join that adaptive
    execution splits; nothing is gathered per node. Rounds grow with the logarithm of the longest
    path; each is written to the shared folder. They end when no node that points elsewhere does so twice or
    is pointed to.
    """
    u, v = F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    edges = stored(links.where(F.col(a) != F.col(b)).select(u, v).distinct(), "links")
    while True:
        ends = edges.select(F.col("u").alias("w"), F.lit(1).alias("out"), F.lit(0).alias("into"))
        ends = ends.union(edges.select("v", F.lit(0), F.lit(1)))
        state = ends.groupBy("w").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
        if not state.where("out > 1 or (out > 0 and into > 0)").limit(1).count():
            break
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("m", "u").alias("m"))
        large = both.join(least, both.u == least.w).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), "m")
        small = large.join(least, large.u == least.w)
        down = small.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        earlier, edges = edges, stored(down.union(least.select("w", "m")).distinct(), "links")
        discard(earlier)
    labels = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return labels.union(labels.select("component", "component").distinct())
