"""Exact cosine retrieval (O10-O12) and all-menu scoring (O13 kernel).

Plan shape of ``top_k`` (questions Q, items N, both tables): a grid. Questions
are dealt by a hash into blocks of about ``QUERY_BLOCK`` rows, items into
blocks of at most about ``ITEM_BLOCK`` rows. Each (question block, item block)
cell is one cogrouped Arrow task: a matrix product in bounded chunks and an
exact partial top-k, ordered by (score rounded to 6 places desc, item id asc).
Both sides are scanned and shuffled once (each copied to the blocks of the
other), nothing is collected, and no cell emits more than k rows a question.
The partial lists are shuffled by question and cut with a ranked window (Spark
plans a partial WindowGroupLimit before that shuffle). Item columns other than
the id are joined after the cut.

Equal vectors are compared once. Questions with the same vector share one row of
the grid, and so do items: each vector stands there with its smallest id. The k best
items of a question belong to its k best vectors, ordered by score, then that id: any
vector ahead holds an item that is ahead. So k vectors are chosen first and dealt to
their k smallest ids. The grid so grows with the different vectors; where all differ
it is the all-pairs job.

``score_menu`` is for a small menu (predicate descriptions): the menu is
broadcast (size-checked), the questions are streamed, and every question gets
every menu entry with its rank, without a shuffle. A menu beyond the bound is
scored on the same grid.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import SCORE_DECIMALS
from ..session import bounded_rows, materialize

QUERY_BLOCK = 4_096
ITEM_BLOCK = 50_000
MIN_ITEM_BLOCK = 2_000           # smaller item blocks aren't worth a task
CHUNK_CELLS = 4_000_000          # question x item scores held at once per task
_SCALE = 10 ** SCORE_DECIMALS


def _unit_rows(vectors, dim: int | None = None):
    """Stack a pandas Series of arrays to a float64 matrix; unit-normalise.

    Returns (matrix, ok_mask): rows that are NULL or have zero norm are
    removed (they have no direction and never rank)."""
    ok = vectors.notna().to_numpy()
    if not ok.any():
        return np.zeros((0, dim or 0)), ok
    mat = np.stack([np.asarray(v, dtype=np.float64) for v in vectors[ok]])
    if dim is not None and mat.shape[1] != dim:
        raise ValueError(f"vector length {mat.shape[1]} differs from {dim}")
    nrm = np.sqrt(np.einsum("ij,ij->i", mat, mat))
    nz = nrm > 0
    full_ok = ok.copy()
    full_ok[np.flatnonzero(ok)[~nz]] = False
    return mat[nz] / nrm[nz][:, None], full_ok


def _rounded(scores):
    """Scores rounded half-up to SCORE_DECIMALS places, as exact integers."""
    return np.floor(scores * _SCALE + 0.5).astype(np.int64)


def _unit_matrix(vectors: pa.ChunkedArray):
    """Arrow lists as a float64 matrix of unit rows, and which rows it holds
    (not NULL, not of zero norm). The flat values are reshaped, not copied row by row."""
    column = vectors.combine_chunks()
    ok = np.asarray(column.is_valid())
    kept = column.drop_null()
    if not len(kept):
        return np.zeros((0, 0)), ok
    sizes = np.unique(pc.list_value_length(kept).to_numpy())
    if len(sizes) != 1:
        raise ValueError(f"vector lengths differ: {sizes[:5].tolist()}")
    mat = kept.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, int(sizes[0]))
    nrm = np.sqrt(np.einsum("ij,ij->i", mat, mat))
    ok[np.flatnonzero(ok)[~(nrm > 0)]] = False
    return mat[nrm > 0] / nrm[nrm > 0][:, None], ok


# Groups of more than k equal vectors whose k-th id may be broadcast (two short values each).
MAX_BROADCAST_GROUPS = 1_000_000


def vector_key(vector: str) -> Column:
    """128 bits of hash that stand for a vector's values."""
    return F.concat_ws(":", F.xxhash64(vector), F.xxhash64(F.lit(1), vector))


def without_surplus(items: DataFrame, item_key: str, vector: str, k: int) -> DataFrame:
    """``items`` without those that have k others of the same vector and smaller id before them.

    Ids and vector hashes are ranked (cut to k in every scan task); the vectors themselves aren't shuffled unless more
    than ``MAX_BROADCAST_GROUPS`` groups are cut."""
    place = Window.partitionBy("_vk").orderBy(F.col(item_key).asc())
    last = materialize(items.select(item_key, vector_key(vector).alias("_vk"))
                       .withColumn("_rn", F.row_number().over(place)).where(F.col("_rn") == k)
                       .select("_vk", F.col(item_key).alias("_last")))
    last = F.broadcast(last) if bounded_rows(last, MAX_BROADCAST_GROUPS) else last
    return (items.withColumn("_vk", vector_key(vector)).join(last, "_vk", "left")
            .where(F.col("_last").isNull() | (F.col(item_key) <= F.col("_last"))).drop("_vk", "_last"))


def firsts(items: DataFrame, item_key: str, vector: str, k: int) -> tuple[DataFrame, DataFrame]:
    """One row for each different vector, with the smallest of its ids (item_key, vector, _vk), and the ids that may be
    among the k best: the k smallest of each vector (_vk, item_key).

    Ids and vector hashes are ranked (cut to k in every scan task); the vectors themselves aren't shuffled unless more
    than ``MAX_BROADCAST_GROUPS`` are shared."""
    place = Window.partitionBy("_vk").orderBy(F.col(item_key).asc())
    ids = materialize(items.select(item_key, vector_key(vector).alias("_vk"))
                      .withColumn("_rn", F.row_number().over(place)).where(F.col("_rn") <= max(2, k)))
    shared = (ids.where("_rn <= 2").groupBy("_vk").agg(F.min(item_key).alias("_first"), F.count("*").alias("_n"))
              .where("_n > 1").drop("_n"))
    shared = F.broadcast(shared) if bounded_rows(shared, MAX_BROADCAST_GROUPS) else shared
    rows = materialize(items.withColumn("_vk", vector_key(vector)).join(shared, "_vk", "left")
                       .where(F.col("_first").isNull() | (F.col(item_key) == F.col("_first"))))
    # an id that has several rows still stands for its vector once
    once = rows.where("_first IS NULL").unionByName(rows.where("_first IS NOT NULL").dropDuplicates(["_vk"]))
    return once.select(item_key, vector, "_vk"), ids.where(F.col("_rn") <= k).select("_vk", item_key)


def _cell(query_key: str, item_key: str, k: int | None, schema: pa.Schema, carry: tuple[str, ...] = ()):
    """Scores of one grid cell: the k best items of each question, or all of them, with their ``carry`` columns."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        qmat, qok = _unit_matrix(left["_qv"])
        right = right.take(pc.sort_indices(right[item_key]))  # ties: the smaller id comes first
        xmat, xok = _unit_matrix(right["_iv"])
        parts = []
        if len(qmat) and len(xmat):
            if qmat.shape[1] != xmat.shape[1]:
                raise ValueError(f"vector length {xmat.shape[1]} differs from {qmat.shape[1]}")
            keys, ids, n = left[query_key].filter(pa.array(qok)), right[item_key].filter(pa.array(xok)), len(xmat)
            take = n if k is None else min(k, n)
            for at in range(0, len(qmat), max(1, CHUNK_CELLS // n)):
                s = qmat[at:at + max(1, CHUNK_CELLS // n)] @ xmat.T
                rank = _rounded(s) * n + (n - 1 - np.arange(n))
                idx = np.argpartition(-rank, take - 1, axis=1)[:, :take] if take < n else np.broadcast_to(np.arange(n), s.shape)
                rows = np.repeat(np.arange(at, at + len(s)), take)
                best = pa.array(idx.ravel())
                parts.append(pa.table([keys.take(pa.array(rows)), ids.take(best), pa.array(np.take_along_axis(s, idx, 1).ravel()),
                                       *[right[c].filter(pa.array(xok)).take(best) for c in carry]], schema=schema))
        return pa.concat_tables(parts) if parts else schema.empty_table()
    return run


def _grid(queries: DataFrame, items: DataFrame, query_key: str, qvec: str, item_key: str, ivec: str,
          k: int | None, query_block: int, item_block: int, carry: tuple[str, ...] = ()) -> DataFrame:
    """(query_key, item_key, _score, *carry) of all cells. Two counts size the grid."""
    from pyspark.sql.pandas.types import to_arrow_schema

    q = queries.select(query_key, F.col(qvec).alias("_qv")).where(F.col("_qv").isNotNull())
    x = items.select(item_key, F.col(ivec).alias("_iv"), *carry).where(F.col("_iv").isNotNull() & F.col(item_key).isNotNull())
    n_items = x.count()
    tasks = int(x.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n_q = max(1, math.ceil(q.count() / query_block))
    n_x = max(1, math.ceil(n_items / item_block), min(tasks, math.ceil(n_items / MIN_ITEM_BLOCK)))
    left = (q.withColumn("_qb", F.pmod(F.xxhash64(query_key), F.lit(n_q)))
            .withColumn("_ib", F.explode(F.sequence(F.lit(0), F.lit(n_x - 1)))))
    right = (x.withColumn("_ib", F.pmod(F.xxhash64(item_key), F.lit(n_x)).cast("int"))
             .withColumn("_qb", F.explode(F.expr(f"sequence(0L, {n_q - 1}L)"))))
    schema = T.StructType([T.StructField(query_key, q.schema[query_key].dataType),
                           T.StructField(item_key, x.schema[item_key].dataType),
                           T.StructField("_score", T.DoubleType()), *[x.schema[c] for c in carry]])
    run = _cell(query_key, item_key, k, to_arrow_schema(schema), carry)
    return (left.groupBy("_qb", "_ib").cogroup(right.groupBy("_qb", "_ib")).applyInArrow(run, schema))


def _collect_bounded(df: DataFrame, max_rows: int):
    """Collect ``df`` if it has at most ``max_rows`` rows, else return None.

    The limit makes the size check itself bounded: at most max_rows + 1 rows
    ever reach the driver."""
    pdf = df.limit(max_rows + 1).toPandas()
    return pdf if len(pdf) <= max_rows else None


def top_k(queries: DataFrame, items: DataFrame, k: int, *, query_key: str = "question_id",
          item_key: str = "id", item_cols=(), vector_col: str = "embedding",
          query_vector_col: str | None = None, query_block: int = QUERY_BLOCK,
          item_block: int = ITEM_BLOCK) -> DataFrame:
    """Exact cosine top-k items per query.

    Output: query_key, rank (0-based), item_key, *item_cols, sim (rounded to
    6 places). Ties on the rounded score go to the smaller item id. Items or
    queries with a NULL or zero vector never match. Item ids are unique.
    """
    if k < 1:
        raise ValueError("k must be >= 1")
    asked = (queries.select(query_key, F.col(query_vector_col or vector_col).alias("_qv")).where(F.col("_qv").isNotNull())
             .withColumn("_vk", vector_key("_qv")))
    vectors = materialize(asked.select("_vk", "_qv").dropDuplicates(["_vk"]))
    known = items.select(item_key, vector_col).where(F.col(vector_col).isNotNull() & F.col(item_key).isNotNull())
    once, ids = firsts(known, item_key, vector_col, k)
    once = once.withColumnRenamed("_vk", "_ik")
    partials = _grid(vectors, once, "_vk", "_qv", item_key, vector_col, k, query_block, item_block, ("_ik",))
    score = F.round(F.col("_score"), SCORE_DECIMALS)
    first = Window.partitionBy("_vk").orderBy(score.desc(), F.col(item_key).asc())

    def cut(df):
        return df.withColumn("_rn", F.row_number().over(first)).where(F.col("_rn") <= k).drop("_rn")

    dealt = cut(partials).drop(item_key).join(ids.withColumnRenamed("_vk", "_ik"), "_ik")
    partials = cut(dealt).join(asked.select(query_key, "_vk"), "_vk")
    sim = F.round(F.col("_score"), SCORE_DECIMALS)
    w = Window.partitionBy(query_key).orderBy(sim.desc(), F.col(item_key).asc())
    best = (partials.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k)
            .select(query_key, (F.col("_rn") - 1).cast("bigint").alias("rank"), item_key, sim.alias("sim")))
    if not item_cols:
        return best
    return (best.join(items.select(item_key, *item_cols), item_key)
            .select(query_key, "rank", item_key, *item_cols, "sim"))


def _menu_kernel(bc, query_key, vec_col, cols):
    def run(batches):
        pos, extra, pmat = bc.value
        npos = len(pos)
        pos_rank = np.argsort(np.argsort(pos, kind="stable"), kind="stable")
        for pdf in batches:
            qmat, ok = _unit_rows(pdf[vec_col], pmat.shape[1] if npos else None)
            if qmat.shape[0] == 0 or npos == 0:
                continue
            keys = pdf[query_key].to_numpy()[ok]
            s = qmat @ pmat.T
            key = _rounded(s) * (npos + 1) + (npos - pos_rank)[None, :]
            order = np.argsort(-key, axis=1, kind="stable")
            rank = np.empty_like(order)
            np.put_along_axis(rank, order, np.arange(npos)[None, :].repeat(len(keys), 0), 1)
            out = {query_key: np.repeat(keys, npos), "pos": np.tile(pos, len(keys))}
            for name, vals in zip(cols, extra):
                out[name] = np.tile(vals, len(keys))
            out["_score"] = s.ravel()
            out["rank"] = rank.ravel().astype(np.int64)
            yield pd.DataFrame(out)
    return run


def score_menu(queries: DataFrame, menu: DataFrame, *, query_key: str = "question_id",
               menu_cols=("predicate",), vector_col: str = "embedding",
               max_menu_rows: int = 100_000) -> DataFrame:
    """Score every query against every menu entry (menu broadcast, size-checked).

    Output: query_key, pos, *menu_cols, score (rounded), rank (0-based; ties
    keep menu order ``pos``).
    """
    menu_cols = list(menu_cols)
    pdf = _collect_bounded(menu.select("pos", *menu_cols, vector_col), max_menu_rows)
    if pdf is None:
        cells = _grid(queries, menu, query_key, vector_col, "pos", vector_col, None, QUERY_BLOCK, ITEM_BLOCK)
        score = F.round("_score", SCORE_DECIMALS)
        w = Window.partitionBy(query_key).orderBy(score.desc(), "pos")
        return (cells.withColumn("rank", (F.row_number().over(w) - 1).cast("bigint"))
                .join(menu.select("pos", *menu_cols), "pos")
                .select(query_key, "pos", *menu_cols, score.alias("score"), "rank"))
    pmat, ok = _unit_rows(pdf[vector_col])
    pos = pdf["pos"].to_numpy()[ok].astype(np.int32)
    extra = [pdf[c].to_numpy(dtype=object)[ok] for c in menu_cols]
    bc = queries.sparkSession.sparkContext.broadcast((pos, extra, pmat))
    mfields = {f.name: f.dataType for f in menu.schema.fields}
    schema = T.StructType(
        [T.StructField(query_key, queries.schema[query_key].dataType),
         T.StructField("pos", T.IntegerType())]
        + [T.StructField(c, mfields[c]) for c in menu_cols]
        + [T.StructField("_score", T.DoubleType()), T.StructField("rank", T.LongType())])
    scored = (queries.select(query_key, vector_col)
              .mapInPandas(_menu_kernel(bc, query_key, vector_col, menu_cols), schema))
    return scored.select(query_key, "pos", *menu_cols,
                         F.round("_score", SCORE_DECIMALS).alias("score"), "rank")
