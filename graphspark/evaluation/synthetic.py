"""Synthetic gold: sample anchors stratified by predicate, direction and degree, template a question, and take a sampled
edge's far end as the answer.

Strata are exact quantiles of the degree: a histogram of degrees per (predicate, direction), which is as long as there
are different degrees, says how many anchors have fewer edges. Inside a stratum the anchors with the smallest hash are
taken, by a ranked window that Spark plans with a partial limit in each task, so no stratum meets in one place. All choices
are hashes of the rows themselves: the sample is the same on any partitioning, and a larger ``per_stratum`` keeps all of a
smaller one's cases.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import display_name, node_text
from ..session import bounded_rows, materialize

#: Sampled anchors that may be broadcast into the edge scans that look their targets up.
MAX_BROADCAST_PICKED = 200_000

_STRATUM = ["predicate", "direction", "bucket"]


def _hash(seed: int, *parts) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))


def _asked(edges: DataFrame, predicates: DataFrame) -> DataFrame:
    asked = edges.join(F.broadcast(predicates.select("predicate").distinct()), "predicate", "left_semi")
    return asked.where("subject IS NOT NULL AND object IS NOT NULL AND subject <> object").select("subject", "predicate", "object")


def anchor_degrees(edges: DataFrame, predicates: DataFrame) -> DataFrame:
    """(anchor, predicate, direction, degree): different far ends of each anchor. Edges are made distinct once, then
    counted from both ends with partial aggregations, so a hub is a few rows."""
    ends = _asked(edges, predicates).distinct().select("predicate", F.explode(F.array(
        F.struct(F.lit("out").alias("direction"), F.col("subject").alias("anchor")),
        F.struct(F.lit("in").alias("direction"), F.col("object").alias("anchor")))).alias("e"))
    return ends.select("predicate", "e.*").groupBy("anchor", "predicate", "direction").agg(F.count("*").alias("degree"))


def anchor_targets(edges: DataFrame, predicates: DataFrame, picked: DataFrame, seed: int) -> DataFrame:
    """(anchor, predicate, direction, target): the far end with the smallest hash, of the picked anchors only."""
    found = None
    for direction, near, far in (("out", "subject", "object"), ("in", "object", "subject")):
        keys = picked.where(F.col("direction") == direction).select("anchor", "predicate")
        keys = F.broadcast(keys) if bounded_rows(keys, MAX_BROADCAST_PICKED) else keys
        part = (_asked(edges, predicates).withColumnRenamed(near, "anchor").join(keys, ["anchor", "predicate"])
                .select("anchor", "predicate", F.lit(direction).alias("direction"), F.col(far).alias("target")))
        found = part if found is None else found.unionByName(part)
    least = F.min(F.struct(_hash(seed, "anchor", "predicate", "direction", "target").alias("h"), "target")).alias("_t")
    return found.groupBy("anchor", "predicate", "direction").agg(least).select("anchor", "predicate", "direction", F.col("_t.target").alias("target"))


def degree_buckets(degrees: DataFrame, buckets: int) -> DataFrame:
    """(predicate, direction, degree, bucket): which of ``buckets`` quantiles a degree falls into; equal degrees share one."""
    counts = degrees.groupBy("predicate", "direction", "degree").agg(F.count("*").alias("n"))
    group = Window.partitionBy("predicate", "direction")
    before = F.coalesce(F.sum("n").over(group.orderBy("degree").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return counts.select("predicate", "direction", "degree",
                         F.floor(before * F.lit(buckets) / F.sum("n").over(group)).cast("int").alias("bucket"))


def synthetic_gold(edges: DataFrame, nodes: DataFrame, templates: DataFrame, *, per_stratum: int, buckets: int = 3,
                   seed: int = 0) -> DataFrame:
    """Cases (id, question, anchor, predicate, direction, expand_subclasses, target, degree, bucket).

    templates: (predicate, description); a question is the description and the anchor's display name. Anchors that are no
    known node, or whose display name is empty, are not sampled; self-loops and null endpoints are no answers. ``target``
    is one right answer; the oracle (``oracle_answers``) gives all of them for the same cases."""
    text = F.col("text") if "text" in nodes.columns else node_text()
    named = nodes.select(F.col("id").alias("anchor"), display_name(text).alias("_name")).where("_name <> ''")
    degrees = materialize(anchor_degrees(edges, templates).join(named.select("anchor"), "anchor", "left_semi"))
    rank = Window.partitionBy(*_STRATUM).orderBy(_hash(seed, "anchor", "predicate", "direction"), "anchor")
    picked = materialize(degrees.join(degree_buckets(degrees, buckets), ["predicate", "direction", "degree"])
                         .withColumn("_rn", F.row_number().over(rank)).where(F.col("_rn") <= per_stratum).drop("_rn"))
    picked = picked.join(anchor_targets(edges, templates, picked, seed), ["anchor", "predicate", "direction"])
    return (picked.join(F.broadcast(templates.select("predicate", "description")), "predicate").join(named, "anchor")
            .select(F.concat(F.lit("syn-"), F.substring(_hash(seed, "anchor", "predicate", "direction"), 1, 16)).alias("id"),
                    F.concat_ws(": ", "description", "_name").alias("question"), "anchor", "predicate", "direction",
                    F.lit(False).alias("expand_subclasses"), "target", "degree", "bucket"))
