"""Connected components of an edge table, without collecting any of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardloom.session import as_written


def _signature(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is linked to the smallest node around it."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # Written, here and below, so that the join exchanges both sides and a hot node can be split.
    least = as_written(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b")


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = as_written(down.groupBy("a").agg(F.min("b").alias("m")), "least")
    linked = down.join(least, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return linked.union(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the edges ``(a, b)``: root is the smallest node it is connected to.

    Alternates two star contractions until nothing changes. A round needs two aggregations that combine before
    the shuffle and two joins that adaptive execution can split at a hot node; every round is written to the
    shared folder. Loops and repeated edges are allowed.
    """
    now = as_written(edges.select("a", "b").filter("a != b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before, mark = None, _signature(now)
    while mark["n"] and mark != before:
        now = as_written(_small_star(_large_star(now).distinct()).distinct(), "edges")
        before, mark = mark, _signature(now)
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
