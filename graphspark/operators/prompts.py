"""Context and prompt assembly, generation seam.

Fixed values (text formats the generator sees):
  text channel line     "[<id>] <text>"
  text channel prompt   "Context:\\n<lines>\\n\\nQuestion: <question>"
  graph channel line    "<subject> — <predicate> — <object>"
  graph channel prompt  "Facts about <anchor>:\\n<lines>\\n\\nQuestion: <question>"
Lists that are gathered into one string are always bounded first (top-k
hits, at most ``max_facts`` facts), so no unbounded group is collected.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import display_name, strip_prefix

NO_ANSWER = "I do not have enough information."
SEP = " — "


def cap_facts(facts: DataFrame, max_facts: int, *, query_key: str = "question_id") -> DataFrame:
    """Keep the first ``max_facts`` facts per question in a fixed order
    (dir, other_id) and report truncation.

    Adds rn (0-based), n_total, truncated. The row-number filter is planned
    with a partial per-task limit before the shuffle, so a hub with millions
    of facts sends at most max_facts rows per task for the window."""
    w = Window.partitionBy(query_key).orderBy("dir", "other_id")
    capped = (facts.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= max_facts)
              .withColumn("rn", (F.col("_rn") - 1).cast("bigint")).drop("_rn"))
    totals = facts.groupBy(query_key).agg(F.count(F.lit(1)).alias("n_total"))
    return (capped.join(totals, query_key)
            .withColumn("truncated", F.col("n_total") > F.lit(max_facts)))


def fact_lines(capped: DataFrame, anchor_names: DataFrame, *, query_key: str = "question_id",
               prefix: str = "biolink:") -> DataFrame:
    """O21 (per line): 'anchor — pred — other' for 'out', reversed for 'in'.

    capped: (query_key, rn, dir, text); anchor_names: (query_key, anchor_name,
    predicate)."""
    pred = strip_prefix("predicate", prefix)
    other = display_name("text")
    line = F.when(F.col("dir") == "out",
                  F.concat_ws(SEP, F.col("anchor_name"), pred, other)) \
            .otherwise(F.concat_ws(SEP, other, pred, F.col("anchor_name")))
    return capped.join(anchor_names, query_key).select(query_key, "rn", line.alias("line"))


def ordered_join(df: DataFrame, key: str, order_col: str, value_col: str,
                 sep: str = "\n") -> DataFrame:
    """(key, joined): values joined by ``sep`` in ``order_col`` order.

    Only for groups bounded by construction (top-k, capped facts)."""
    return (df.groupBy(key)
            .agg(F.array_sort(F.collect_list(F.struct(order_col, value_col))).alias("_l"))
            .select(key, F.array_join(F.transform("_l", lambda x: x[value_col]), sep)
                    .alias("context")))


def graph_prompt(questions: DataFrame, anchors: DataFrame, lines: DataFrame, *,
                 query_key: str = "question_id") -> DataFrame:
    """O23: 'Facts about {anchor}:' + context + question, per answered question.

    anchors: (query_key, anchor_name). A question whose anchor has no facts
    gets an empty fact list, not an error."""
    ctx = ordered_join(lines, query_key, "rn", "line")
    user = F.concat(F.lit("Facts about "), F.col("anchor_name"), F.lit(":\n"),
                    F.coalesce(F.col("context"), F.lit("")), F.lit("\n\nQuestion: "),
                    F.col("question"))
    return (anchors.join(questions.select(query_key, "question"), query_key)
            .join(ctx, query_key, "left")
            .select(query_key, user.alias("user_prompt")))


def text_prompt(questions: DataFrame, hits: DataFrame, *, query_key: str = "question_id") -> DataFrame:
    """O22: 'Context:' + '[id] text' lines in rank order + question.

    hits: (query_key, rank, id, text). A question without hits gets an empty
    context."""
    lines = hits.select(query_key, "rank",
                        F.concat(F.lit("["), F.col("id"), F.lit("] "), F.col("text")).alias("line"))
    ctx = ordered_join(lines, query_key, "rank", "line")
    user = F.concat(F.lit("Context:\n"), F.coalesce(F.col("context"), F.lit("")),
                    F.lit("\n\nQuestion: "), F.col("question"))
    return (questions.select(query_key, "question").join(ctx, query_key, "left")
            .select(query_key, user.alias("user_prompt")))


def extractive_answer(user_prompt="user_prompt") -> F.Column:
    """Deterministic stand-in generator: the first context line of the prompt
    (the best hit or first fact), or a no-answer sentence."""
    col = F.col(user_prompt) if isinstance(user_prompt, str) else user_prompt
    first = F.split(col, "\n").getItem(1)
    return F.when(col.isNull(), F.lit(None).cast("string")) \
            .when(F.coalesce(first, F.lit("")) == "", F.lit(NO_ANSWER)).otherwise(first)


def generate(prompts: DataFrame, predict_factory: Callable[[], Callable] | None = None, *,
             query_key: str = "question_id", system: str | None = None) -> DataFrame:
    """The generation seam. Text in, text out, per question.

    Without a factory the built-in extractive answer is used (a JVM
    expression). With one, ``predict_factory()`` is called once per task to
    build ``predict(systems: list[str], users: list[str]) -> list[str]`` (a
    local model or a remote client), which is applied per Arrow batch. The
    system text is the caller's and needed with a factory.
    """
    if predict_factory is None:
        return prompts.withColumn("answer", extractive_answer("user_prompt"))
    if system is None:
        raise ValueError("a generator needs a system text")

    def run(batches):
        predict = predict_factory()
        for pdf in batches:
            users = pdf["user_prompt"].tolist()
            answers = [None] * len(users)
            idx = [i for i, u in enumerate(users) if u is not None]
            if idx:
                got = predict([system] * len(idx), [users[i] for i in idx])
                for i, a in zip(idx, got):
                    answers[i] = a
            yield pdf.assign(answer=pd.Series(answers, dtype=object))

    schema = T.StructType(list(prompts.schema.fields) + [T.StructField("answer", T.StringType())])
    return prompts.mapInPandas(run, schema)
