"""Connected components of an edge table by alternating large and small stars, all in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import release, staged


def _largest_star(e: DataFrame) -> DataFrame:
    both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(e: DataFrame) -> DataFrame:
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    moved = e.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """edges: u, v, in any order. node, root for every node that has an edge; the root is its component's least node.

    Each round is written to the shared folder, so no round is computed again when executors are lost; rounds grow
    with the logarithm of the longest chain. Hubs are met by partial sums and by joins that can be split.
    """
    e = staged(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    while True:
        big = _largest_star(e)
        new = staged(_small_star(big), "edges")
        # Done once the stars are what they were: every node hangs on a root.
        changed = new.join(e, ["u", "v"], "left_anti").limit(1).count() or e.join(new, ["u", "v"], "left_anti").limit(1).count()
        release(e)
        e = new
        if not changed:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
