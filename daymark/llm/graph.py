"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.session import materialize


def components(edges: DataFrame) -> DataFrame:
    """Action: (node, root) for every node of ``edges`` (a, b); the root is the least node of its component.

    Rounds link every node to the least neighbour it knows until nothing changes; the number of rounds
    grows with the logarithm of the longest path. Each round is written to the shared folder. Only the
    number of edges and a checksum reach the driver.
    """
    links = materialize(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    before = None
    while True:
        links = materialize(small_star(large_star(links)), "links")
        state = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = links.groupBy("b").agg(F.min("a").alias("root")).select(F.col("b").alias("node"), "root")
    return roots.unionByName(links.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())


def large_star(links: DataFrame) -> DataFrame:
    """Each larger neighbour of a node is linked to the node's least neighbour (or the node itself)."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    met = both.where("b > a").join(least, "a").where("b <> m")
    return met.select(F.col("m").alias("a"), "b").distinct()


def small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of them; links are (smaller, larger)."""
    least = links.groupBy("b").agg(F.min("a").alias("m"))
    met = links.join(least, "b")
    return met.where("a <> m").select("m", F.col("a").alias("x")).unionByName(met.select("m", F.col("b").alias("x"))).select(
        F.col("m").alias("a"), F.col("x").alias("b")).distinct()
