"""Subgraph extraction and edge statistics."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import id_tokens
from ..session import bounded_rows, materialize

# Largest seed-id set broadcast to the edge scan (ids are short strings, so
# this stays in the tens of megabytes).
MAX_BROADCAST_SEEDS = 1_000_000

# An inactive flag counts as "not set" when it is NULL, empty, or numerically
# zero (a field-is-falsy test); the string "False" is set, i.e. inactive.
_NUMERIC_ZERO = r"^\s*[+-]?(0+\.?0*|\.0+)([eE][+-]?[0-9]+)?\s*$"


def is_active(flag) -> F.Column:
    flag = F.col(flag) if isinstance(flag, str) else flag
    return flag.isNull() | (flag == "") | flag.rlike(_NUMERIC_ZERO)


def select_seeds(nodes: DataFrame, id_regex: str, name_regex: str,
                 inactive_col: str | None = "inactive") -> DataFrame:
    """O1: active nodes whose id and name match the given regexes -> (id, name)."""
    cond = F.col("id").rlike(id_regex) & F.col("name").rlike(name_regex)
    if inactive_col and inactive_col in nodes.columns:
        cond = cond & is_active(inactive_col)
    return nodes.where(cond).select("id", "name")


def extract_edges(edges: DataFrame, seeds: DataFrame, mode: str = "endpoint",
                  seed_col: str = "id", max_broadcast_seeds: int = MAX_BROADCAST_SEEDS) -> DataFrame:
    """O2: edges that mention a seed id; every matching edge row kept once.

    mode='endpoint'   subject or object is a seed.
    mode='substring'  a seed occurs anywhere in the row's text (its columns joined by tabs), literally, so
                      'part:1' also matches 'part:10' (:func:`extract_substring`).
    mode='any_column' a seed is a whole column value, or an id between list
                      separators in any column. Ids are matched exactly:
                      unlike a raw substring match, 'part:1' does not match
                      'part:10'. Every endpoint row is among these rows.

    A seed set proven to hold at most ``max_broadcast_seeds`` ids is
    broadcast: one scan of the edges, whose ids probe the seed hash table
    inside the scan task; for 'any_column' only matching rows are shuffled
    (to keep a row matched by several seeds once). Without that proof the
    edges are stored once with a row id, (row id, id) pairs meet the seeds
    in a shuffle, and the matching row ids are joined back to the stored
    rows.
    """
    if mode not in ("endpoint", "any_column", "substring"):
        raise ValueError(f"mode must be 'endpoint', 'any_column' or 'substring', not {mode!r}")
    if mode == "substring":
        return extract_substring(edges, seeds, seed_col, min(max_broadcast_seeds, MAX_AUTOMATON_SEEDS))
    ids = seeds.select(F.col(seed_col).alias("_seed")).where(F.col("_seed").isNotNull()).distinct()
    cols = list(edges.columns)
    out_cols = [F.col(f"`{c}`") for c in cols]
    mentioned = id_tokens([F.col(f"`{c}`") for c in cols])
    if mode == "endpoint":
        mentioned = F.array_distinct(F.array("subject", "object"))
    if bounded_rows(ids, max_broadcast_seeds):
        if mode == "endpoint":
            subject = F.broadcast(ids.select(F.col("_seed").alias("_s")))
            obj = F.broadcast(ids.select(F.col("_seed").alias("_o")))
            hits = (edges.join(subject, edges["subject"] == F.col("_s"), "left")
                    .join(obj, edges["object"] == F.col("_o"), "left"))
            return hits.where(F.col("_s").isNotNull() | F.col("_o").isNotNull()).select(*out_cols)
        keyed = edges.withColumn("_rid", F.monotonically_increasing_id())
        hits = keyed.select("*", F.explode(mentioned).alias("_tok"))
        hits = hits.join(F.broadcast(ids), hits["_tok"] == ids["_seed"], "left_semi")
        return hits.dropDuplicates(["_rid"]).select(*out_cols)
    keyed = materialize(edges.withColumn("_rid", F.monotonically_increasing_id()))
    tokens = keyed.select("_rid", F.explode(mentioned).alias("_tok"))
    hit_rows = tokens.join(ids, tokens["_tok"] == ids["_seed"], "left_semi").select("_rid").distinct()
    return keyed.join(hit_rows, "_rid", "left_semi").select(*out_cols)


# Seeds of one automaton and their characters (a million ids of one kind take some 150 MB in every Python worker, most a
# character less than 60 bytes), and q-gram lengths for more of them.
MAX_AUTOMATON_SEEDS, MAX_AUTOMATON_CHARS = 1_000_000, 16_000_000
GRAM_LENGTHS = (12, 8, 4, 2, 1)


def _row_text(edges: DataFrame) -> Column:
    return F.concat_ws("\t", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in edges.columns])


def extract_substring(edges: DataFrame, seeds: DataFrame, seed_col: str = "id",
                      max_automaton_seeds: int = MAX_AUTOMATON_SEEDS) -> DataFrame:
    """O2 by literal substring: edges whose text (columns joined by tabs, NULL as empty) holds a seed; each row once.

    Seeds proven to be at most ``max_automaton_seeds`` make one Aho-Corasick automaton that every scan task runs
    over its rows, a batch at a time: one pass over the text whatever their number, and no shuffle. More seeds are joined (:func:`_gram_join`).
    An empty seed is in every row; a NULL one in none."""
    ids = seeds.select(F.col(seed_col).cast("string").alias("_seed")).where("_seed IS NOT NULL").distinct()
    if not ids.where("_seed = ''").isEmpty():
        return edges
    few = [r[0] for r in ids.limit(max_automaton_seeds + 1).collect()]
    if len(few) > max_automaton_seeds or sum(map(len, few)) > MAX_AUTOMATON_CHARS:
        return _gram_join(edges, ids)
    if not few:
        return edges.limit(0)
    shared = edges.sparkSession.sparkContext.broadcast(few)
    between = next(c for c in map(chr, range(0x110000)) if not any(c in seed for seed in few))  # no match goes across it
    built = []

    @F.arrow_udf("boolean")
    def holds(texts: pa.Array) -> pa.Array:
        if not built:  # once a Python worker and scan
            import ahocorasick
            automaton = ahocorasick.Automaton()
            for seed in shared.value:
                automaton.add_word(seed, True)
            automaton.make_automaton()
            built.append(automaton)
        # The rows of a batch are one text, so that Python meets matches only, not rows.
        starts = np.r_[0, np.cumsum(pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64) + 1)]
        ends = np.fromiter((end for end, _ in built[0].iter(between.join(texts.to_pylist()))), np.int64)
        out = np.zeros(len(texts), bool)
        out[np.searchsorted(starts, ends, "right") - 1] = True
        return pa.array(out)

    return edges.where(holds(_row_text(edges)))


def _gram_join(edges: DataFrame, ids: DataFrame) -> DataFrame:
    """Substring matches for any number of seeds: each seed stands for its rarest gram among the rows, rows that
    hold that gram meet it in a shuffle on the gram, and the pair is verified.

    A seed's grams have the longest of ``GRAM_LENGTHS`` that it can fill, so ids with a common beginning are told apart by
    their ends. Rows are stored once with an id, for it has to stay the same in all reads."""
    stored = materialize(edges.withColumn("_rid", F.monotonically_increasing_id()))
    text = _row_text(stored.drop("_rid"))
    length = F.lit(None).cast("int")
    for n in sorted(GRAM_LENGTHS):
        length = F.when(F.char_length("_seed") >= n, F.lit(n)).otherwise(length)

    def grams(df: DataFrame, col: str, n: Column, *keys: str) -> DataFrame:
        sized = df.select(*keys, F.col(col).alias("_s"), n.alias("_n")).where(F.char_length("_s") >= F.col("_n"))
        return (sized.select(*keys, "_s", "_n", F.explode(F.sequence(F.lit(1), F.char_length("_s") - F.col("_n") + 1)).alias("_at"))
                .select(*keys, F.substring("_s", F.col("_at"), F.col("_n")).alias("_gram")).distinct())

    known = materialize(grams(ids.withColumn("_seed2", F.col("_seed")), "_seed2", length, "_seed"))
    lengths = [n for n in GRAM_LENGTHS if not known.where(F.char_length("_gram") == n).isEmpty()]
    rows = stored.select("_rid", text.alias("_text"), F.explode(F.array(*[F.lit(n) for n in lengths])).alias("_len"))
    held = materialize(grams(rows, "_text", F.col("_len"), "_rid").join(known.select("_gram").distinct(), "_gram", "left_semi"))
    often = held.groupBy("_gram").agg(F.count("*").alias("_c"))
    # a seed with a gram that no row holds is in no row
    rarest = (known.join(often, "_gram", "left").groupBy("_seed")
              .agg(F.min(F.struct(F.coalesce("_c", F.lit(0)).alias("_c"), "_gram")).alias("_g"))
              .where("_g._c > 0").select("_seed", F.col("_g._gram").alias("_gram")))
    pairs = held.join(rarest, "_gram").select("_rid", "_seed")
    hits = (pairs.join(stored.select("_rid", text.alias("_text")), "_rid")
            .where(F.col("_text").contains(F.col("_seed"))).select("_rid").distinct())
    return stored.join(hits, "_rid", "left_semi").select(*[F.col(f"`{c}`") for c in edges.columns])


def edge_histogram(edges: DataFrame) -> DataFrame:
    """O3: edge count by (predicate, category), most frequent first."""
    return (edges.groupBy("predicate", "category").agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), "predicate", "category"))


def edge_total(edges: DataFrame) -> DataFrame:
    """O4 (first result): total number of edges as a one-row table."""
    return edges.agg(F.count(F.lit(1)).alias("n"))


def predicate_inventory(edges: DataFrame) -> DataFrame:
    """Edge count per predicate, most frequent first."""
    return (edges.groupBy("predicate").agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), "predicate"))


def category_pairs(edges: DataFrame, top: int | None = 15) -> DataFrame:
    """(subject_category, object_category) pairs by edge count; the top
    ``top`` pairs when given (a top-k report; ties broken by the names)."""
    out = (edges.groupBy("subject_category", "object_category")
           .agg(F.count(F.lit(1)).alias("n"))
           .orderBy(F.desc("n"), "subject_category", "object_category"))
    return out.limit(top) if top else out
