"""Connected components by alternating stars, over edges kept in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusq.session import Scratch


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node joins its larger neighbours to the least node around it."""
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node joins its smaller neighbours and itself to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component): each node of ``edges`` (u, v) and the least node reachable from it.

    The number of rounds grows with the logarithm of the number of nodes; a round works on at
    most as many edges as it was given, and writes them, so no lineage builds up; the tables of
    the rounds before go. Stars are aggregated before they are shuffled. Loops and repeated edges do no harm; an empty input
    gives no rows.
    """
    scratch = Scratch(edges.sparkSession, name)
    edges = scratch.written(
        edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.hash("u", "v").cast("bigint"))).first()
        scratch.keep_last()
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        state = now
        edges = scratch.written(_small_star(_large_star(edges).distinct()).distinct())
