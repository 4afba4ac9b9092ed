"""Connected components of a distributed table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.tables import Tables


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's least neighbour."""
    near = _both_ways(edges)
    least = near.groupBy(F.col("a").alias("k")).agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return (near.where("b > a").join(least, F.col("a") == F.col("k"))
            .select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy(F.col("a").alias("k")).agg(F.min("b").alias("m"))
    linked = down.join(least, F.col("a") == F.col("k")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    nodes = least.select(F.col("k").alias("a"), F.col("m").alias("b"))
    return linked.unionByName(nodes).where("a <> b").distinct()


#: Links that one file of a round's table holds.
FILE_LINKS = 1_000_000


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (a, b): the smallest
    node it can reach.  Nodes without a link to another are left out.

    Alternating star contractions: only (node, neighbour) pairs move, minima
    are pre-aggregated, and each round is written to the shared folder,
    so a lost executor costs one round at most.  Stops when a round changes
    nothing.
    """
    tables = Tables(spark, "components")
    now = tables.write(edges.where("a <> b").select("a", "b").distinct())
    seen = None
    while True:
        state = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == seen or not state[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        # A round never has more links than twice those before it.
        files = -(-2 * state[0] // FILE_LINKS)
        seen, before = state, now
        now = tables.write(_small_star(_large_star(before)).coalesce(files))
        tables.drop(before)
