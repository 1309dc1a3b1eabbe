"""Connected components of a graph given as pairs, all in DataFrame operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldleaf.session import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the node's smallest neighbour."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    rest = down.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.union(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """`node`, `root` (smallest node it is connected with) for every node of pairs `u`, `v`.

    Nodes are longs. Alternates the two star operations until every node hangs on its root;
    each round halves the depth at least, is written to the shared folder, and never brings the
    neighbours of a node together: only their minimum, which is combined before the shuffle.
    """
    now = written(edges.where(F.col("u") != F.col("v")).select("u", "v").distinct(), "links")
    while True:
        after = written(_small_star(_large_star(now).distinct()).distinct(), "links")
        # Done when all pairs are stars: nobody's root hangs on another.
        deep = after.select(F.col("v").alias("u")).distinct().join(after, "u", "left_semi")
        if deep.isEmpty():
            break
        now = after
    return after.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        after.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
