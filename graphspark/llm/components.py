"""Connected components of a table of links, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphspark.session import materialize


def components(links: DataFrame) -> DataFrame:
    """id, comp for every end of ``links`` (a, b long): comp is the smallest id reachable, itself included.

    Each round every node moves to the neighbour (or itself) with the smallest hash in this round, and links
    are carried over to the nodes moved to; links inside a node vanish. A constant share of the nodes goes each
    round, so the rounds grow with the logarithm of the nodes. A hub's links are reduced to one row a task
    before they are shuffled. Rounds are stored in the checkpoint folder. No links give no rows."""
    edges = materialize(links.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    both = edges.select("a").union(edges.select("b")).distinct()
    at = materialize(both.select(F.col("a").alias("id"), F.col("a").alias("node")))
    turn = 0
    while not edges.isEmpty():
        ends = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = lambda c: F.struct(F.xxhash64(c, F.lit(turn)).alias("h"), F.col(c).alias("v"))  # noqa: E731, B023
        moved = materialize(ends.groupBy("a").agg(F.min(rank("b")).alias("m"))
                            .select(F.col("a").alias("node"), F.least("m", rank("a"))["v"].alias("to")))
        at = materialize(at.join(moved, "node", "left").select("id", F.coalesce("to", "node").alias("node")))
        one = edges.join(moved.withColumnRenamed("node", "a"), "a").select(F.col("to").alias("a"), "b")
        two = one.join(moved.withColumnRenamed("node", "b"), "b").select("a", F.col("to").alias("b"))
        edges = materialize(two.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
        turn += 1
    smallest = at.groupBy("node").agg(F.min("id").alias("comp"))
    return materialize(at.join(smallest, "node").select("id", "comp"))
