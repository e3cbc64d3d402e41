"""A hierarchy index for retrieval: who belongs to which class, at any distance (umbrella questions).

The index is the closure of the hierarchy predicate stored as a table, one row for each (node, class above it) with the
least number of steps. It is built once, like the other offline tables, and read between hub choice and traversal.
Nothing is shared with the evaluation's closure, which judges what is retrieved here.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import bounded_rows, materialize
from . import graph

#: Members (ids) that may be broadcast into an edge scan once a count proves them so few.
MAX_BROADCAST_MEMBERS = 200_000


def ancestor_index(edges: DataFrame, predicate: str) -> DataFrame:
    """(node, ancestor, up): every class above a node and the least steps to it; a node isn't its own ancestor.

    A child is the subject of a ``predicate`` edge whose object is its parent. All nodes climb together, a level a
    round; a pair that was met before goes no further, so the loop ends on cycles."""
    parents = materialize(edges.where(F.col("predicate") == predicate)
                          .where("subject IS NOT NULL AND object IS NOT NULL AND subject <> object")
                          .select(F.col("subject").alias("node"), F.col("object").alias("ancestor")).distinct())
    levels = [materialize(parents.withColumn("up", F.lit(1)))]
    climb = parents.select(F.col("node").alias("ancestor"), F.col("ancestor").alias("_next"))
    while True:
        step = (levels[-1].join(climb, "ancestor").select("node", F.col("_next").alias("ancestor")).distinct()
                .where("node <> ancestor"))
        for level in levels:
            step = step.join(level.select("node", "ancestor"), ["node", "ancestor"], "left_anti")
        level = materialize(step.withColumn("up", F.lit(len(levels) + 1)))
        if level.isEmpty():
            return reduce(DataFrame.unionByName, levels)
        levels.append(level)


def members(index: DataFrame, anchors: DataFrame) -> DataFrame:
    """(anchor, member, down): each distinct anchor itself (0 steps) and all nodes below it."""
    wanted = anchors.select("anchor").where("anchor IS NOT NULL").distinct()
    below = index.join(wanted.withColumnRenamed("anchor", "ancestor"), "ancestor")
    return (wanted.select("anchor", F.col("anchor").alias("member"), F.lit(0).alias("down"))
            .unionByName(below.select(F.col("ancestor").alias("anchor"), F.col("node").alias("member"), F.col("up").alias("down"))))


def rolled_up_degree(edges: DataFrame, member_sets: DataFrame, predicates: DataFrame) -> DataFrame:
    """(anchor, predicate, n_edges, n_direct): edges of the predicate on an anchor's members, and on itself.

    Degrees are counted once a (node, predicate), combined in each edge scan task, then summed up the classes."""
    asked = edges.join(F.broadcast(predicates.select("predicate").distinct()), "predicate", "left_semi")
    nodes = member_sets.select(F.col("member").alias("node")).distinct()
    degree = graph.degree(graph.incidence(asked), nodes, bounded_rows(nodes, MAX_BROADCAST_MEMBERS))
    return (member_sets.withColumnRenamed("member", "node").join(degree, "node").groupBy("anchor", "predicate")
            .agg(F.sum("n").alias("n_edges"), F.sum(F.when(F.col("down") == 0, F.col("n")).otherwise(0)).alias("n_direct")))


def choose_level(candidates: DataFrame, picked: DataFrame, degrees: DataFrame, nearness: float, *,
                 query_key: str = "question_id") -> DataFrame:
    """(q, id, rank, n_edges, n_direct): the anchor and thereby the level that a question widens to.

    Candidates whose similarity is at least ``nearness`` times the best one's are about as near to the question as
    the nearest; of these the one with the most edges on itself and its members wins, so that a class that the
    question names beats its single members, and a member that it names isn't lost to a class that it doesn't. If none
    of these has an edge of the picked predicates, the next nearest candidate that has one is taken. Ties go to the
    better rank; without any edge the question has no row."""
    best = candidates.groupBy(query_key).agg(F.max("sim").alias("_best"))
    counts = (candidates.join(picked.select(query_key, "predicate"), query_key)
              .join(degrees.withColumnRenamed("anchor", "id"), ["id", "predicate"])
              .groupBy(query_key, "id", "rank", "sim").agg(F.sum("n_edges").alias("n_edges"), F.sum("n_direct").alias("n_direct"))
              .where("n_edges > 0").join(best, query_key))
    ring = F.when(F.col("sim") >= F.lit(nearness) * F.col("_best"), F.lit(0)).otherwise(F.col("rank") + 1)
    order = Window.partitionBy(query_key).orderBy(ring, F.desc("n_edges"), "rank")
    return (counts.withColumn("_rn", F.row_number().over(order)).where("_rn = 1")
            .select(query_key, "id", "rank", "n_edges", "n_direct"))


def traverse_members(anchors: DataFrame, member_sets: DataFrame, edges: DataFrame) -> DataFrame:
    """(anchor, predicate, member, other_id, dir): facts one hop from any member of each distinct (anchor, predicate).

    The far end is outside the anchor's own members. Computed once a distinct anchor and predicate, however many
    questions share it."""
    specs = anchors.select("anchor", "predicate").distinct()
    sets = member_sets.select("anchor", "member")
    keys = specs.join(sets, "anchor").withColumnRenamed("member", "node")
    small = bounded_rows(keys, MAX_BROADCAST_MEMBERS)
    keys = keys.withColumn("_member", F.col("node"))
    facts = (graph.incident(edges, keys, small).select("anchor", "predicate", F.col("_member").alias("member"),
                                                       F.col("other").alias("other_id"), "dir"))
    inside = sets.withColumnRenamed("member", "other_id")
    return facts.join(F.broadcast(inside) if small else inside, ["anchor", "other_id"], "left_anti")
