"""Connected components of a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybank.llm.stored import remove, stored


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in `links` (a, b); the component is the smallest node of it.

    Each step writes its links to the shared folder. Hubs are joined, never collected; the number of steps grows with the
    logarithm of the number of nodes.
    """
    spark = links.sparkSession
    pairs = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct()
    current, path = stored(pairs, "links")
    state = None
    while True:
        large, large_path = stored(_large_star(current), "links")
        small, small_path = stored(_small_star(large), "links")
        remove(spark, [path, large_path])
        found = small.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("h")).first()
        current, path = small, small_path
        if tuple(found) == state:
            break
        state = tuple(found)
    nodes = current.select(F.col("b").alias("node"), F.col("a").alias("component"))
    return nodes.union(current.select("a", "a").distinct())


def _least_neighbour(both: DataFrame) -> DataFrame:
    """(u, v) with the least of u and its neighbours."""
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u")


def _large_star(pairs: DataFrame) -> DataFrame:
    """Larger neighbours of each node move to its least neighbour."""
    both = pairs.selectExpr("a u", "b v").union(pairs.selectExpr("b u", "a v"))
    moved = _least_neighbour(both).filter("v > u").selectExpr("m a", "v b")
    return moved.filter("a < b").distinct()


def _small_star(pairs: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours move to the least of them."""
    down = pairs.selectExpr("b u", "a v")
    joined = _least_neighbour(down)
    moved = joined.selectExpr("m a", "v b").union(joined.selectExpr("m a", "u b"))
    return moved.filter("a < b").distinct()
