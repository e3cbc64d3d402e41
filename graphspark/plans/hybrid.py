"""Hybrid retrieval: text hits and graph facts in one prompt under one length budget.

Both channels rank entities: a text hit is its node, a fact its far end. Reciprocal rank fusion adds 1 / (RRF + rank) over
the channels, so a node that both bring comes first; its text line and its fact lines follow one another in the order of
the fused score. Lines are taken in that order until the next one would pass the budget; what is left out is reported. The
prompt lists the taken lines by channel. A question's lines are at most k hits and the capped facts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import prompts
from ..session import materialize
from .rag import GraphParts

RRF = 60
BUDGET = 2_000


def fused_lines(parts: GraphParts, k: int, rrf: int = RRF) -> DataFrame:
    """(q, id, channel, rn, line, score): every line of both channels with its entity's fused score (12 places)."""
    q = parts.q
    hits = parts.vector_hits(k).select(q, "id", F.col("rank").alias("rn"))
    texts = parts.node_vectors.select("id", F.concat(F.lit("["), F.col("id"), F.lit("] "), F.col("text")).alias("line"))
    text = hits.join(texts, "id").select(q, "id", F.lit("text").alias("channel"), "rn", "line")
    facts = (parts.lines.join(parts.capped.select(q, "rn", F.col("other_id").alias("id")), [q, "rn"])
             .select(q, "id", F.lit("fact").alias("channel"), "rn", "line"))
    lines = materialize(text.unionByName(facts))
    best = lines.groupBy(q, "id", "channel").agg(F.min("rn").alias("_r"))
    score = best.groupBy(q, "id").agg(F.round(F.sum(F.lit(1.0) / (F.lit(rrf + 1) + F.col("_r"))), 12).alias("score"))
    return lines.join(score, [q, "id"])


def hybrid_rag(parts: GraphParts, *, k: int = 5, budget: int = BUDGET, rrf: int = RRF, predict_factory=None,
               system: str | None = None) -> DataFrame:
    """One row per question: n_text, n_facts (lines taken), n_dropped, n_both (taken entities that both channels bring),
    user_prompt, answer. A question without anchor has text lines only; one without any line an empty context."""
    q = parts.q
    order = Window.partitionBy(q).orderBy(F.desc("score"), "id", F.desc("channel"), "rn")
    sums = order.rowsBetween(Window.unboundedPreceding, 0)
    lines = (fused_lines(parts, k, rrf).withColumn("_at", F.row_number().over(order))
             .withColumn("_used", F.sum(F.char_length("line") + 1).over(sums)))
    taken = materialize(lines.withColumn("_in", F.col("_used") <= F.lit(budget)))
    kept = taken.where("_in")
    counts = taken.groupBy(q).agg(
        F.count(F.when(F.col("_in") & (F.col("channel") == "text"), F.lit(1))).alias("n_text"),
        F.count(F.when(F.col("_in") & (F.col("channel") == "fact"), F.lit(1))).alias("n_facts"),
        F.count(F.when(~F.col("_in"), F.lit(1))).alias("n_dropped"))
    both = (kept.groupBy(q, "id").agg(F.count_distinct("channel").alias("_c")).where("_c = 2").groupBy(q)
            .agg(F.count("*").alias("n_both")))

    def joined(channel):
        return prompts.ordered_join(kept.where(F.col("channel") == channel), q, "_at", "line").withColumnRenamed("context", f"_{channel}")

    facts = F.concat(F.lit("\n\nFacts about "), F.col("anchor_name"), F.lit(":\n"), F.coalesce("_fact", F.lit("")))
    user = F.concat(F.lit("Context:\n"), F.coalesce("_text", F.lit("")), F.coalesce(facts, F.lit("")),
                    F.lit("\n\nQuestion: "), F.col("question"))
    rows = (parts.questions.select(q, "question").join(counts, q, "left").join(both, q, "left")
            .join(parts.anchors.select(q, "anchor_name"), q, "left").join(joined("text"), q, "left").join(joined("fact"), q, "left")
            .select(q, *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_text", "n_facts", "n_dropped", "n_both")],
                    user.alias("user_prompt")))
    return prompts.generate(rows, predict_factory, query_key=q, system=system)
