"""Corpus build (O5-O8): named triples, node-id set, node text, coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import node_text as node_text_expr


def name_triples(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(subject name, predicate, object name).

    Inner on both ends: an edge with an unknown endpoint disappears, a
    duplicated node id multiplies rows (same as two plain joins).
    """
    s = nodes.select(F.col("id").alias("_sid"), F.col("name").alias("_sname"))
    o = nodes.select(F.col("id").alias("_oid"), F.col("name").alias("_oname"))
    e = edges.select("subject", "predicate", "object")
    return (e.join(s, e["subject"] == s["_sid"])
             .join(o, F.col("object") == o["_oid"])
             .select(F.col("_sname").alias("subject"), "predicate", F.col("_oname").alias("object")))


def node_ids(edges: DataFrame) -> DataFrame:
    """Distinct ids over both endpoints (one scan of the edges)."""
    return edges.select(F.explode(F.array("subject", "object")).alias("id")).distinct()


def node_text(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """One text per node that occurs in an edge -> (id, category, text)."""
    ids = node_ids(edges)
    n = nodes.select("id", "category", "name", "synonym", "description")
    return ids.join(n, "id").select("id", "category", node_text_expr().alias("text"))


def text_coverage(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """One row (n_ids, with_desc, total).

    n_ids counts distinct endpoint ids (before the node join); total and
    with_desc count joined node rows, with_desc those with a non-empty
    description. One plan: per-id counts, then a global sum.
    """
    ids = node_ids(edges)
    n = nodes.select(F.col("id").alias("_nid"), "description")
    has_desc = F.col("description").isNotNull() & (F.col("description") != "")
    per_id = (ids.join(n, ids["id"] == n["_nid"], "left")
              .groupBy("id")
              .agg(F.count("_nid").alias("_m"),
                   F.count(F.when(has_desc, F.lit(1))).alias("_d")))
    return per_id.agg(F.count(F.lit(1)).alias("n_ids"),
                      F.coalesce(F.sum("_d"), F.lit(0)).cast("bigint").alias("with_desc"),
                      F.coalesce(F.sum("_m"), F.lit(0)).cast("bigint").alias("total"))
