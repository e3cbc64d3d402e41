"""Predicate classification.

A question is scored against the description vector of every predicate in
the menu; the menu order breaks score ties (a stable sort of the original).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import phrases
from .knn import score_menu


def rank_predicates(questions: DataFrame, predicates: DataFrame, *,
                    query_key: str = "question_id", vector_col: str = "embedding") -> DataFrame:
    """Every predicate per question -> (question_id, rank, pos, predicate, score).

    ``predicates`` is the menu (pos, predicate, embedding); it is broadcast
    after a size check, the questions are streamed (no shuffle)."""
    return score_menu(questions, predicates, query_key=query_key, menu_cols=("predicate",),
                      vector_col=vector_col).select(query_key, "rank", "pos", "predicate", "score")


def pick_predicates(ranked: DataFrame, cutoff: float) -> DataFrame:
    """Predicates with score >= cutoff (inclusive), rank order kept.

    Scores are descending in rank, so the picked set is a prefix of the
    ranking and ``rank`` 0 is the top predicate. A question with nothing at
    or above the cutoff has no rows here."""
    return ranked.where(F.col("score") >= F.lit(cutoff))


def calibration(ranked: DataFrame, cutoff: float) -> DataFrame:
    """All scores with a '*' mark where score >= cutoff."""
    return ranked.withColumn(
        "mark", F.when(F.col("score") >= F.lit(cutoff), F.lit("*")).otherwise(F.lit(" ")))


def keyword_predicates(questions: DataFrame, triggers: DataFrame, *, query_key: str = "question_id",
                       text_col: str = "question") -> DataFrame:
    """O13 by trigger phrases instead of vectors, with the same output: (question_id, rank, pos, predicate, score).

    triggers: (pos, predicate, phrase); a phrase may trigger several predicates. The phrases are found in the
    question longest first from the left; a predicate's score is the share of its words among all matched words (6
    places), 0 without a match. Every predicate keeps a row; ties go to the smaller ``pos``. Transparent and without a
    model, but only as good as the phrases."""
    index = phrases.phrase_index(triggers, "phrase", "pos")
    found = phrases.longest(phrases.matches(questions, text_col, index, query_key), query_key)
    hits = found.join(F.broadcast(index.select("phrase", F.col("id").alias("pos"))), "phrase")
    words = hits.groupBy(query_key, "pos").agg(F.sum("n_words").alias("_n"))
    total = found.groupBy(query_key).agg(F.sum("n_words").alias("_all"))
    menu = triggers.select("pos", "predicate").distinct()
    scored = (questions.select(query_key).join(F.broadcast(menu)).join(words, [query_key, "pos"], "left").join(total, query_key, "left")
              .withColumn("score", F.round(F.coalesce(F.col("_n") / F.col("_all"), F.lit(0.0)), 6)))
    order = Window.partitionBy(query_key).orderBy(F.desc("score"), "pos")
    return scored.select(query_key, (F.row_number().over(order) - 1).cast("bigint").alias("rank"), "pos", "predicate", "score")


def agreement(first: DataFrame, second: DataFrame, first_cutoff: float, second_cutoff: float, *,
              query_key: str = "question_id") -> DataFrame:
    """How two rankings of the same questions agree: (question_id, top_first, top_second, same_top, n_first, n_second,
    n_both), the tops being NULL where nothing reaches the cutoff."""
    a = pick_predicates(first, first_cutoff).select(query_key, "predicate", F.col("rank").alias("_a"))
    b = pick_predicates(second, second_cutoff).select(query_key, "predicate", F.col("rank").alias("_b"))
    sums = (a.join(b, [query_key, "predicate"], "full_outer").groupBy(query_key)
            .agg(F.max(F.when(F.col("_a") == 0, F.col("predicate"))).alias("top_first"),
                 F.max(F.when(F.col("_b") == 0, F.col("predicate"))).alias("top_second"),
                 F.count("_a").alias("n_first"), F.count("_b").alias("n_second"), F.count(F.col("_a") + F.col("_b")).alias("n_both")))
    zero = {c: F.coalesce(c, F.lit(0)).alias(c) for c in ("n_first", "n_second", "n_both")}
    same = F.coalesce(F.col("top_first") == F.col("top_second"), F.lit(False))
    return (first.select(query_key).distinct().join(sums, query_key, "left")
            .select(query_key, "top_first", "top_second", same.alias("same_top"), *zero.values()))
