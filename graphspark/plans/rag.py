"""End-to-end retrieval for a whole table of questions.

The driver sees counts only, and the size-checked predicate menu. A count of
the questions is the proof that per-question tables may be broadcast: each
such table has its own bound in rows, and its rows hold ids, no texts.
Per-question tables that several branches read (candidates, picked
predicates, chosen anchors, capped facts) are stored once.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import display_name
from ..operators import classify, graph, knn, prompts
from ..operators.embed import check_same_encoder
from ..session import bounded_rows, materialize

DEFAULT_MAX_BROADCAST_QUESTIONS = 20_000
# Bytes that a broadcast per-question table may have, and what one of its rows
# takes at most: two ids or names of bounded length and a few numbers.
MAX_BROADCAST_BYTES = 512 << 20
ROW_BYTES = 256


def vector_rag(questions: DataFrame, node_vectors: DataFrame, *, k: int = 5,
               predict_factory=None, system: str | None = None,
               query_key: str = "question_id") -> DataFrame:
    """Questions -> top-k node texts -> text prompt -> answer.

    questions: (query_key, question, embedding); node_vectors: (id, text, embedding).
    Output: (query_key, user_prompt, answer)."""
    check_same_encoder(questions, node_vectors)
    hits = knn.top_k(questions, node_vectors, k, query_key=query_key, item_cols=["text"])
    ask = prompts.text_prompt(questions, hits, query_key=query_key)
    return prompts.generate(ask, predict_factory, query_key=query_key, system=system)


class GraphParts:
    """Intermediate tables of graph retrieval, built on first use.

    ranked      every predicate score per question
    picked      predicates at or above the cutoff (stored)
    candidates  anchor recall pool
    hub         chosen anchor per question (stored)
    anchors     (q, anchor, predicate, anchor_name)
    fact_keys   uncapped facts to known nodes (q, other_id, dir) (stored)
    facts       uncapped facts with text (q, other_id, category, text, dir)
    capped      first max_facts facts with rn, n_total, truncated (stored)
    lines       verbalised facts
    prompts     (q, user_prompt) of answered questions
    """

    def __init__(self, questions, node_vectors, nodes, edges, predicates, *, cutoff, recall_k,
                 max_facts, prefix, query_key, exclude_negated, max_broadcast_questions):
        if exclude_negated and "negated" in edges.columns:
            edges = edges.where(~F.coalesce(F.lower(F.col("negated")).isin("true", "1"),
                                            F.lit(False)))
        check_same_encoder(questions, node_vectors, predicates)
        self.questions, self.node_vectors, self.nodes, self.edges = (
            questions, node_vectors, nodes, edges)
        self.predicates, self.cutoff, self.recall_k = predicates, cutoff, recall_k
        self.max_facts, self.prefix, self.q = max_facts, prefix, query_key
        self.max_broadcast_questions = max_broadcast_questions

    @cached_property
    def n_questions(self) -> int:
        """Questions, counted up to the broadcast bound."""
        return self.questions.select(self.q).limit(self.max_broadcast_questions + 1).count()

    def fits(self, rows_each: int) -> bool:
        """Proof that a per-question table of that many rows a question may be broadcast."""
        return (self.n_questions <= self.max_broadcast_questions
                and self.n_questions * rows_each * ROW_BYTES <= MAX_BROADCAST_BYTES)

    @cached_property
    def small(self) -> bool:
        """Candidate x picked predicate pairs, the largest table of the edge scans, may be broadcast. The menu is
        counted with a bounded limit."""
        cap = MAX_BROADCAST_BYTES // (ROW_BYTES * max(1, self.n_questions * self.recall_k))
        return self.n_questions <= self.max_broadcast_questions and bounded_rows(self.predicates, cap)

    @cached_property
    def ranked(self):
        return classify.rank_predicates(self.questions, self.predicates, query_key=self.q)

    @cached_property
    def picked(self):
        return materialize(classify.pick_predicates(self.ranked, self.cutoff))

    @cached_property
    def top(self):
        return self.picked.where(F.col("rank") == 0).select(self.q, "predicate")

    @cached_property
    def candidates(self):
        """Ids, ranks and scores, stored once: the hub, the plain vector system and the report read it."""
        return materialize(knn.top_k(self.questions, self.node_vectors, self.recall_k, query_key=self.q))

    @cached_property
    def hub(self):
        return materialize(graph.disambiguate(self.candidates, self.picked, self.edges,
                                              query_key=self.q, small=self.small))

    def vector_hits(self, k: int):
        """(q, rank, id, sim) of the k nearest: a prefix of the candidates."""
        if k > self.recall_k:
            raise ValueError(f"k={k} is above the recall pool of {self.recall_k}")
        return self.candidates.where(F.col("rank") < k)

    @cached_property
    def anchors(self):
        """The chosen nodes' texts are joined after the choice; one row a question."""
        texts = self.node_vectors.select("id", "text")
        return materialize(self.hub.join(self.top, self.q).join(texts, "id").select(
            self.q, F.col("id").alias("anchor"), "predicate", display_name("text").alias("anchor_name")))

    @cached_property
    def node_txt(self):
        return graph.texts(self.nodes, "other_id")

    @cached_property
    def keys(self):
        return graph.traverse_keys(self.anchors, self.edges, query_key=self.q, small=self.small)

    @cached_property
    def fact_keys(self):
        """(q, other_id, dir) of facts whose far end is a known node, stored
        once: the cap's window, the totals, the retrieved sets and the counts
        all read it."""
        return materialize(self.keys.join(self.node_txt.select("other_id"), "other_id",
                                          "left_semi"))

    @cached_property
    def facts(self):
        return self.fact_keys.join(self.node_txt, "other_id").select(
            self.q, "other_id", "category", "text", "dir")

    @cached_property
    def capped(self):
        capped_keys = prompts.cap_facts(self.fact_keys, self.max_facts, query_key=self.q)
        # At most |Q| x max_facts rows of ids: broadcast if that is proven small,
        # so that the node table is only scanned for their texts.
        if self.fits(self.max_facts):
            capped_keys = F.broadcast(capped_keys)
        return materialize(self.node_txt.join(capped_keys, "other_id"))

    @cached_property
    def lines(self):
        return prompts.fact_lines(self.capped,
                                  self.anchors.select(self.q, "anchor_name", "predicate"),
                                  query_key=self.q, prefix=self.prefix)

    @cached_property
    def prompts(self):
        return prompts.graph_prompt(self.questions, self.anchors.select(self.q, "anchor_name"),
                                    self.lines, query_key=self.q)


def graph_parts(questions: DataFrame, node_vectors: DataFrame, nodes: DataFrame,
                edges: DataFrame, predicates: DataFrame, *, cutoff: float, recall_k: int = 25,
                max_facts: int = 40, prefix: str = "biolink:", query_key: str = "question_id",
                exclude_negated: bool = False,
                max_broadcast_questions: int = DEFAULT_MAX_BROADCAST_QUESTIONS) -> GraphParts:
    return GraphParts(questions, node_vectors, nodes, edges, predicates, cutoff=cutoff,
                      recall_k=recall_k, max_facts=max_facts, prefix=prefix, query_key=query_key,
                      exclude_negated=exclude_negated,
                      max_broadcast_questions=max_broadcast_questions)


def graph_rag(questions: DataFrame, node_vectors: DataFrame, nodes: DataFrame,
              edges: DataFrame, predicates: DataFrame, *, cutoff: float, recall_k: int = 25,
              max_facts: int = 40, prefix: str = "biolink:", predict_factory=None,
              system: str | None = None, query_key: str = "question_id", exclude_negated: bool = False,
              max_broadcast_questions: int = DEFAULT_MAX_BROADCAST_QUESTIONS) -> DataFrame:
    """Graph retrieval for every question.

    Degree (hub choice) uses the whole picked predicate set; traversal uses
    only the top predicate. Every question keeps a row with a status:
    'no_predicate' (nothing at or above the cutoff), 'no_anchor' (no
    candidate has an edge of the picked predicates) or 'ok'.
    Output: question_id, status, anchor, predicate, n_facts, n_total, truncated,
    user_prompt, answer.
    """
    p = graph_parts(questions, node_vectors, nodes, edges, predicates, cutoff=cutoff,
                    recall_k=recall_k, max_facts=max_facts, prefix=prefix, query_key=query_key,
                    exclude_negated=exclude_negated,
                    max_broadcast_questions=max_broadcast_questions)
    top = p.picked.where(F.col("rank") == 0).select(query_key, F.col("predicate").alias("_top"))
    stats = p.capped.groupBy(query_key).agg(F.count(F.lit(1)).alias("_n"),
                                            F.max("n_total").alias("_all"), F.max("truncated").alias("_t"))
    answered = prompts.generate(p.prompts, predict_factory, query_key=query_key, system=system)
    status = (F.when(F.col("_top").isNull(), F.lit("no_predicate"))
              .when(F.col("anchor").isNull(), F.lit("no_anchor")).otherwise(F.lit("ok")))
    ok = F.col("anchor").isNotNull()
    return (questions.select(query_key)
            .join(top, query_key, "left")
            .join(p.anchors.select(query_key, "anchor"), query_key, "left")
            .join(stats, query_key, "left")
            .join(answered, query_key, "left")
            .select(query_key, status.alias("status"), "anchor", F.col("_top").alias("predicate"),
                    F.when(ok, F.coalesce("_n", F.lit(0))).otherwise(F.lit(0)).cast("bigint")
                    .alias("n_facts"),
                    F.when(ok, F.coalesce("_all", F.lit(0))).otherwise(F.lit(0)).cast("bigint").alias("n_total"),
                    F.when(ok, F.coalesce("_t", F.lit(False))).otherwise(F.lit(False))
                    .alias("truncated"),
                    "user_prompt", "answer"))
