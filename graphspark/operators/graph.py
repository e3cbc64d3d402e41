"""Graph retrieval (O16-O18) over an incidence table.

"Edges with node n on either side" is an OR join, which Spark can only plan
as a nested-loop or cartesian join. Every either-side question here is
instead asked of the incidence table: each edge appears once per endpoint,
``(node, predicate, other, dir)``, with 'out' when node is the subject and
'in' when it is the object. A self-loop appears once, as 'out'. Then degree,
hub choice and traversal are plain equi-joins and aggregations.

Hub choice and traversal do not even need the exploded table: they ask
about given (node, predicate) pairs, which is two equi-joins against the
raw edges (``incident``). Per-question tables (candidates, picked
predicates, anchors) are small (|questions| x k); when the caller has
checked that bound they are broadcast, so the edge side is never shuffled
to meet them and a hub node with a third of all edges is just a long run of
hash probes spread over every scan task. Otherwise the joins are shuffle
joins and AQE's skew handling splits hubs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import node_text
from ..session import key_filter, materialize, prefiltered


def incidence(edges: DataFrame, exclude_negated: bool = False) -> DataFrame:
    """Edges as (node, predicate, other, dir), one row per endpoint.

    The original counts a negated edge as a positive fact; that stays the
    default. ``exclude_negated=True`` drops rows whose ``negated`` is true.
    """
    e = edges
    if exclude_negated and "negated" in e.columns:
        e = e.where(~F.coalesce(F.lower(F.col("negated")).isin("true", "1"), F.lit(False)))
    out = F.struct(F.col("subject").alias("node"), F.col("object").alias("other"),
                   F.lit("out").alias("dir"))
    back = F.struct(F.col("object").alias("node"), F.col("subject").alias("other"),
                    F.lit("in").alias("dir"))
    both = F.when(F.col("subject") == F.col("object"), F.array(out)).otherwise(F.array(out, back))
    return (e.select("predicate", F.explode(both).alias("_i"))
            .select(F.col("_i.node").alias("node"), "predicate", F.col("_i.other").alias("other"),
                    F.col("_i.dir").alias("dir")))


def degree(inc: DataFrame, nodes_of_interest: DataFrame | None = None,
           small: bool = False) -> DataFrame:
    """O16 over an incidence table: incident edges per (node, predicate) ->
    (node, predicate, n). A self-loop counts once. Aggregation is partial per
    task first, so a hub's count is combined map-side.

    Optionally restricted to ``nodes_of_interest`` (a ``node`` column): by a
    broadcast semi-join before aggregating when ``small``, else by a bit filter
    before and the semi-join on the counts, so that no edge row is shuffled."""
    rows = inc
    keep = None if nodes_of_interest is None else nodes_of_interest.select("node").distinct()
    if keep is not None and small:
        rows = rows.join(F.broadcast(keep), "node", "left_semi")
    elif keep is not None:
        keep = materialize(keep)
        rows = prefiltered(rows, "node", key_filter(keep, "node"))
    counts = rows.groupBy("node", "predicate").agg(F.count(F.lit(1)).alias("n"))
    return counts if keep is None or small else counts.join(keep, "node", "left_semi")


def incident(edges: DataFrame, keys: DataFrame, small: bool = False) -> DataFrame:
    """Edge endpoints seen from ``keys`` (node, predicate, ...): every key
    column plus (other, dir), 'out' where node is the subject and 'in' where
    it is the object; a self-loop once, as 'out'.

    Two equi-joins on (endpoint, predicate) against the raw edges -- no OR
    join, no explode of the whole edge table. With a broadcast key side
    the edges are only scanned (never shuffled), and because predicate is
    the edge partition column, dynamic partition pruning skips predicates no
    key asks for. Otherwise a bit filter keeps edges without a key's node out
    of the shuffle."""
    k = F.broadcast(keys) if small else materialize(keys)
    bits = None if small else key_filter(k.select("node").distinct(), "node")
    e = edges.select("subject", "predicate", "object")
    cols = [c for c in keys.columns if c not in ("node", "predicate")]

    def near(rows):
        return rows if small else prefiltered(rows, "node", bits)

    out = (near(e.withColumnRenamed("subject", "node")).join(k, ["node", "predicate"])
           .select("node", "predicate", *cols, F.col("object").alias("other"),
                   F.lit("out").alias("dir")))
    back = (near(e.where(~F.coalesce(F.col("subject") == F.col("object"), F.lit(False)))
                 .withColumnRenamed("object", "node")).join(k, ["node", "predicate"])
            .select("node", "predicate", *cols, F.col("subject").alias("other"),
                    F.lit("in").alias("dir")))
    return out.unionByName(back)


def degree_of(edges: DataFrame, keys: DataFrame, small: bool = False) -> DataFrame:
    """O16 for given (node, predicate) pairs: -> (node, predicate, n), only
    pairs with at least one edge. Computed per distinct pair first, so a node
    that many questions share is counted once.

    With ``small`` (the pairs are proven small) the pairs are broadcast into
    the edge scan. Without it, the edges are not shuffled to meet the pairs:
    every (node, predicate) of a node that passes the pairs' bit filter is
    counted with a partial aggregation per task -- a hub's edges collapse
    map-side to one row per task, so no shuffle partition is hot -- and the
    asked pairs are kept by a semi-join on the aggregated counts."""
    pairs = keys.select("node", "predicate").distinct()
    if small:
        return (incident(edges, pairs, True).groupBy("node", "predicate")
                .agg(F.count(F.lit(1)).alias("n")))
    nodes = materialize(pairs.select("node").distinct())
    some = prefiltered(incidence(edges), "node", key_filter(nodes, "node"))
    return degree(some).join(pairs, ["node", "predicate"], "left_semi")


def disambiguate(candidates: DataFrame, picked: DataFrame, edges: DataFrame, *,
                 query_key: str = "question_id", small: bool = False) -> DataFrame:
    """Per question, the candidate with the most edges of the picked
    predicates (either side; a self-loop once). Ties go to the better
    (lower) rank; a question whose candidates all have zero such edges gets
    no row.

    candidates: (query_key, rank, id, ...); picked: (query_key, predicate).
    Output: candidate columns + n_edges. The candidate columns ride along
    through the count (they are functions of (question, rank)), so the
    candidate table is read once.
    """
    extra = [c for c in candidates.columns if c not in (query_key, "rank", "id")]
    pairs = (candidates.select(query_key, "rank", F.col("id").alias("node"), *extra)
             .join(picked.select(query_key, "predicate"), query_key))
    if small:
        pairs = F.broadcast(pairs)
    deg = degree_of(edges, pairs, small)
    counts = (pairs.join(deg, ["node", "predicate"])
              .groupBy(query_key, "rank", "node", *extra)
              .agg(F.sum("n").cast("bigint").alias("n_edges"))
              .where(F.col("n_edges") > 0))
    w = Window.partitionBy(query_key).orderBy(F.desc("n_edges"), F.asc("rank"))
    return (counts.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1)
            .select(query_key, "rank", F.col("node").alias("id"), *extra, "n_edges"))


def traverse_keys(anchors: DataFrame, edges: DataFrame, *, query_key: str = "question_id",
                  small: bool = False) -> DataFrame:
    """One hop from each question's anchor along its predicate, ids only.

    anchors: (query_key, anchor, predicate) -> (query_key, other_id, dir).
    Parallel edges give repeated rows (the original keeps duplicates)."""
    a = anchors.select(F.col("anchor").alias("node"), "predicate", query_key)
    return (incident(edges, a, small)
            .select(query_key, F.col("other").alias("other_id"), "dir"))


def traverse(anchors: DataFrame, edges: DataFrame, nodes: DataFrame, *,
             query_key: str = "question_id", small: bool = False) -> DataFrame:
    """Facts one hop away -> (query_key, other_id, category, text, dir).

    The other endpoint must exist in ``nodes`` (a dangling endpoint is
    dropped); a self-loop yields one 'out' row whose other end is the anchor."""
    keys = traverse_keys(anchors, edges, query_key=query_key, small=small)
    return keys.join(texts(nodes, "other_id"), "other_id").select(
        query_key, "other_id", "category", "text", "dir")


def texts(nodes: DataFrame, id_alias: str = "id") -> DataFrame:
    """(id, category, text) of a node table that has either a ``text`` column
    or the raw name / synonym / description columns."""
    text = F.col("text") if "text" in nodes.columns else node_text()
    return nodes.select(F.col("id").alias(id_alias), "category", text.alias("text"))
