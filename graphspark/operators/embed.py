"""Embedding a text column.

The default encoder is feature hashing, entirely in Spark SQL: lower-case
word tokens (of any script) of the whole text, each hashed to one of ``dim`` buckets by md5,
counted, and L2-normalised. It is deterministic and needs no model file.
``fit_grams`` and ``gram_embed`` are an encoder learned from the corpus: character
grams of any script weighted by how rare they are in it, randomly projected.
A learned encoder plugs in through ``embed``: ``encoder_factory()`` is called
once per task and returns ``encode(list[str]) -> array (n, dim)``; it is
applied per Arrow batch. The encoder name is stored with the vectors, and
vectors of different encoders are never compared.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import md5_bucket, word_tokens
from ..session import bounded_rows, materialize

HASH_ENCODER = "md5-hash"


def hash_encoder(dim: int) -> str:
    """Name of the built-in encoder with so many buckets; stored beside its vectors."""
    return f"{HASH_ENCODER}-{dim}"


def hash_embed(docs: DataFrame, key_col: str, text_col: str, dim: int = 65536, normalise: bool = True) -> DataFrame:
    """Sparse hashed bag of words -> (key, bucket, weight), unit L2 norm per key; plain counts (of the same
    direction, and exact in any float type) if not ``normalise``.

    A text without tokens has no rows. A key with one row is counted in the scan task, each different word of a batch hashed
    once; only keys are shuffled, to find those with several rows (a null key is one of them), which are counted by
    grouped aggregation."""
    single, several = _by_rows(docs, key_col)
    schema = T.StructType([docs.schema[key_col], T.StructField("bucket", T.IntegerType()),
                           T.StructField("weight", T.DoubleType() if normalise else T.LongType())])

    def count(batches):
        for batch in batches:
            lists = batch.column(1)
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            words = lists.flatten().dictionary_encode()
            place = np.array([int(hashlib.md5(w.encode()).hexdigest()[:15], 16) % dim for w in words.dictionary.to_pylist()], np.int64)
            cells = np.repeat(np.arange(batch.num_rows), sizes) * dim + place[words.indices.to_numpy(zero_copy_only=False)]
            cells, n = np.unique(cells, return_counts=True)
            row, bucket = cells // dim, (cells % dim).astype(np.int32)
            if normalise:
                n = n / np.sqrt(np.bincount(row, n.astype(np.float64) ** 2, batch.num_rows))[row]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), pa.array(bucket), pa.array(n)], names=schema.names)

    out = single.select(key_col, word_tokens(text_col).alias("_words")).mapInArrow(count, schema)
    if several is None:
        return out
    tok = several.select(key_col, F.explode(word_tokens(text_col)).alias("_tok"))
    counts = (tok.select(key_col, md5_bucket("_tok", dim).alias("bucket"))
              .groupBy(key_col, "bucket").agg(F.count(F.lit(1)).alias("_c")))
    if not normalise:
        return out.unionByName(counts.withColumnRenamed("_c", "weight"))
    # Per-key norm as a window: one shuffle by key instead of an aggregate
    # plus a join; a key's window holds at most ``dim`` rows.
    norm = F.sqrt(F.sum(F.col("_c") * F.col("_c")).over(Window.partitionBy(key_col)))
    return out.unionByName(counts.select(key_col, "bucket", (F.col("_c") / norm).alias("weight")))


# Keys with several rows that may be broadcast to set them apart.
MAX_BROADCAST_KEYS = 1_000_000


def _several(df: DataFrame, key_col: str, which: Column) -> DataFrame:
    """(_again): the keys with more than one row."""
    keys = df.groupBy(F.col(key_col).alias("_again")).agg(F.count("*").alias("_n"))
    return materialize(keys.where((F.col("_n") > 1) & which).select("_again"))


def with_bags(df: DataFrame, key_col: str, text_col: str, dim: int) -> DataFrame:
    """The rows of ``df`` with ``embedding`` (array<float>[dim]): counts of the hashed words of all texts of the row's key.
    Rows without key, and keys without a word, are left out.

    A key with one row needs only that row, so its vector is laid out in the scan task; only ids are shuffled, to
    find the keys with several rows, which take :func:`hash_embed` and :func:`to_dense`."""
    again = _several(df, key_col, F.col("_again").isNotNull())
    known = df.where(F.col(key_col).isNotNull())
    schema = T.StructType([*df.schema.fields, T.StructField("embedding", T.ArrayType(T.FloatType()))])

    def dense(batches):
        for batch in batches:
            batch = batch.filter(pc.greater(pc.fill_null(pc.list_value_length(batch.column(batch.num_columns - 1)), 0), 0))
            lists, n = batch.column(batch.num_columns - 1), batch.num_rows
            row = np.repeat(np.arange(n), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
            bucket = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            cells = np.bincount(row * dim + bucket, minlength=n * dim).astype(np.float32)
            ends = pa.array(np.arange(n + 1, dtype=np.int32) * np.int32(dim))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.ListArray.from_arrays(ends, pa.array(cells))], names=schema.names)

    def bags(rows: DataFrame) -> DataFrame:
        words = F.transform(word_tokens(text_col), lambda w: md5_bucket(w, dim))
        return rows.withColumn("_words", words).mapInArrow(dense, schema)

    if again.isEmpty():
        return bags(known)
    again = F.broadcast(again) if bounded_rows(again, MAX_BROADCAST_KEYS) else again
    several = known.join(again, F.col(key_col) == F.col("_again"), "left_semi")
    dense_rows = to_dense(hash_embed(several, key_col, text_col, dim, normalise=False), key_col, dim, "float")
    return (bags(known.join(again, F.col(key_col) == F.col("_again"), "left_anti"))
            .unionByName(several.join(dense_rows, key_col).select(*schema.names)))


def gram_counts(docs: DataFrame, key_col: str, text_col: str, gram: int, buckets: int) -> DataFrame:
    """(key, gram bucket, n): hashed character grams of every word, the word's ends marked; a short word is one gram."""
    words = docs.select(key_col, F.explode(word_tokens(text_col)).alias("_w"))
    marked = words.select(key_col, F.concat(F.lit("^"), F.col("_w"), F.lit("$")).alias("_w"))
    last = F.greatest(F.lit(1), F.char_length("_w") - F.lit(gram - 1))
    pieces = marked.select(key_col, "_w", F.explode(F.sequence(F.lit(1), last)).alias("_at"))
    pieces = pieces.select(key_col, F.substring("_w", F.col("_at"), F.lit(gram)).alias("_g"))
    return (pieces.groupBy(key_col, "_g").agg(F.count("*").alias("_n"))
            .select(key_col, md5_bucket("_g", buckets).alias("gram"), "_n")
            .groupBy(key_col, "gram").agg(F.sum("_n").alias("n")))


GRAM, GRAM_BUCKETS = 3, 1 << 18
# Buckets whose weights every task may hold; with more, grams are counted and joined by shuffles.
MAX_TASK_BUCKETS = 1 << 20
# Words whose grams are laid out at once in a task.
SLICE_WORDS = 100_000
# Different grams whose bucket a task remembers.
KNOWN_GRAMS = 1_000_000


def _by_rows(docs: DataFrame, key_col: str) -> tuple[DataFrame, DataFrame | None]:
    """The rows of keys with one row, and those of keys with several (None if there are none; a null key is a key).
    Only keys are shuffled."""
    again = _several(docs, key_col, F.lit(True))
    if again.isEmpty():
        return docs, None
    same = F.col(key_col).eqNullSafe(F.col("_again"))
    again = F.broadcast(again) if bounded_rows(again, MAX_BROADCAST_KEYS) else again
    return docs.join(again, same, "left_anti"), docs.join(again, same, "left_semi")


def _row_grams(keys: pa.Array, lists: pa.Array, gram: int, buckets: int, known: dict):
    """(keys, row, bucket, n) of the hashed grams of each row's words, in slices of rows; each different word of a slice is
    cut once, each different gram hashed once (``known``)."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends, start = np.cumsum(sizes), 0
    while start < len(sizes):
        before = int(ends[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + SLICE_WORDS, "right")))
        words = lists.slice(start, stop - start).flatten().dictionary_encode()
        if len(known) > KNOWN_GRAMS:
            known.clear()
        cut, edge = [], [0]
        for w in words.dictionary.to_pylist():
            w = f"^{w}$"
            for at in range(max(1, len(w) - gram + 1)):
                g = w[at:at + gram]
                bucket = known.get(g)
                if bucket is None:
                    bucket = known[g] = int(hashlib.md5(g.encode()).hexdigest()[:15], 16) % buckets
                cut.append(bucket)
            edge.append(len(cut))
        different, code = np.unique(np.array(cut, np.int64), return_inverse=True)
        edge, word = np.array(edge, np.int64), words.indices.to_numpy(zero_copy_only=False)
        n = (edge[1:] - edge[:-1])[word]
        place = np.arange(n.sum()) + np.repeat(edge[word] - np.cumsum(n) + n, n)
        row = np.repeat(np.repeat(np.arange(stop - start), sizes[start:stop]), n)
        cells, count = np.unique(row * len(different) + code[place], return_counts=True)
        width = max(1, len(different))
        yield keys.slice(start, stop - start), cells // width, different[cells % width], count
        start = stop


def fit_grams(corpus: DataFrame, key_col: str, text_col: str, gram: int = GRAM, buckets: int = GRAM_BUCKETS) -> DataFrame:
    """The learned part of the gram encoder: (gram, weight), log((1 + texts) / (1 + texts with the gram)) + 1 over all texts
    of the corpus with a word. At most ``buckets`` rows, counted in Spark; grams that no text has aren't listed.

    A key with one row is counted in the scan task, so that only one number for each gram of a batch is shuffled."""
    single, several = _by_rows(corpus, key_col)

    def count(batches):
        known = {}
        for batch in batches:
            for keys, row, bucket, _ in _row_grams(batch.column(0), batch.column(1), gram, buckets, known):
                grams, n = np.unique(bucket, return_counts=True)
                texts = pc.sum(keys.take(pa.array(np.unique(row))).is_valid()).as_py() or 0
                yield pa.RecordBatch.from_arrays([pa.array([*grams.tolist(), None], pa.int64()), pa.array([*n.tolist(), texts], pa.int64())],
                                                 names=["gram", "_n"])

    # a null gram stands for the texts with a word and a key
    parts = single.select(key_col, word_tokens(text_col).alias("_words")).mapInArrow(count, "gram bigint, _n bigint")
    if several is not None:
        counts = gram_counts(several, key_col, text_col, gram, buckets)
        parts = (parts.unionByName(counts.groupBy(F.col("gram").cast("bigint").alias("gram")).agg(F.count("*").alias("_n")))
                 .unionByName(counts.agg(F.count_distinct(key_col).alias("_n")).select(F.lit(None).cast("bigint").alias("gram"), "_n")))
    totals = materialize(parts.groupBy("gram").agg(F.sum("_n").alias("_df")))
    texts = totals.where("gram IS NULL").select(F.col("_df").alias("_all"))
    return (totals.where("gram IS NOT NULL").join(F.broadcast(texts))  # one row
            .select(F.col("gram").cast("int").alias("gram"), (F.log((F.lit(1.0) + F.col("_all")) / (F.lit(1.0) + F.col("_df"))) + 1).alias("weight")))


def gram_embed(docs: DataFrame, key_col: str, text_col: str, weights: DataFrame, dim: int, gram: int = GRAM,
               buckets: int = GRAM_BUCKETS) -> DataFrame:
    """Sparse (key, bucket, weight) of unit length: the fitted weights times 1 + log(count), projected by signed hashing.

    A gram's sign and place among ``dim`` come from its bucket, the same for every text, so no projection matrix is kept.
    Grams that the corpus doesn't have are left out; a text without any other has no row, nor has one whose projected
    weights cancel out. Works on any script, and misspelt or inflected words still share most of their grams.

    A key with one row is encoded in the scan task, which holds the weights; the grams of a key with several are joined."""
    single, several = _by_rows(docs, key_col) if buckets <= MAX_TASK_BUCKETS else (None, docs)
    parts = []
    if single is not None:
        held = weights.select(F.col("gram").cast("bigint").alias("gram"), F.col("weight").cast("double").alias("weight")).orderBy("gram").toArrow()
        held = docs.sparkSession.sparkContext.broadcast(tuple(held[c].to_numpy() for c in ("gram", "weight")))  # at most ``buckets`` rows of two numbers
        schema = T.StructType([docs.schema[key_col], T.StructField("bucket", T.IntegerType()), T.StructField("weight", T.DoubleType())])

        def encode(batches):
            (grams, weight), known = held.value, {}
            for batch in batches:
                for keys, row, bucket, n in _row_grams(batch.column(0), batch.column(1), gram, buckets, known):
                    at = np.minimum(np.searchsorted(grams, bucket), max(0, len(grams) - 1))
                    found = grams[at] == bucket if len(grams) else np.zeros(len(bucket), bool)
                    row, bucket, at, n = row[found], bucket[found], at[found], n[found]
                    cells, code = np.unique(row * dim + bucket // 2 % dim, return_inverse=True)
                    w = np.bincount(code, (1.0 - 2 * (bucket % 2)) * weight[at] * (np.log(n) + 1), len(cells))
                    row = cells // dim
                    norm = np.sqrt(np.bincount(row, w * w, len(keys)))[row]
                    kept = norm > 0
                    yield pa.RecordBatch.from_arrays([keys.take(pa.array(row[kept])), pa.array((cells % dim)[kept].astype(np.int32)),
                                                      pa.array(w[kept] / norm[kept])], names=schema.names)

        parts.append(single.select(key_col, word_tokens(text_col).alias("_words")).mapInArrow(encode, schema))
    if several is not None:
        counts = gram_counts(several, key_col, text_col, gram, buckets)
        place = F.floor(F.col("gram") / 2) % dim
        sign = F.lit(1.0) - 2 * (F.col("gram") % 2)
        weights = F.broadcast(weights) if buckets <= MAX_TASK_BUCKETS else weights
        rows = (counts.join(weights, "gram").select(key_col, place.cast("int").alias("bucket"),
                                                    (sign * F.col("weight") * (F.log(F.col("n").cast("double")) + 1)).alias("_w"))
                .groupBy(key_col, "bucket").agg(F.sum("_w").alias("_w")))
        norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(key_col)))
        parts.append(rows.withColumn("_norm", norm).where("_norm > 0").select(key_col, "bucket", (F.col("_w") / F.col("_norm")).alias("weight")))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def gram_encoder(dim: int, gram: int = GRAM) -> str:
    return f"idf-grams-{gram}-{dim}"


def to_dense(sparse: DataFrame, key_col: str, dim: int, element: str = "double") -> DataFrame:
    """Sparse (key, bucket, weight) -> (key, embedding array<element>[dim]).

    The per-key list is bounded by ``dim`` entries; it is laid out as a dense row per Arrow batch, because an expression
    over the list would be evaluated anew for each of the ``dim`` places."""
    weight = F.col("weight").cast(element)
    packed = sparse.groupBy(key_col).agg(F.collect_list(F.struct(F.col("bucket").cast("int").alias("b"), weight.alias("w"))).alias("_m"))
    kind = np.float32 if element == "float" else np.float64

    def dense(batches):
        for batch in batches:
            lists = batch.column(1)
            cells = lists.flatten()
            bucket, value = cells.field("b").to_numpy(zero_copy_only=False), cells.field("w").to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
            inside = (bucket >= 0) & (bucket < dim)
            out = np.zeros((len(lists), dim), kind)
            out[row[inside], bucket[inside]] = value[inside]
            ends = pa.array(np.arange(len(lists) + 1, dtype=np.int32) * np.int32(dim))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(ends, pa.array(out.ravel()))],
                                             names=[key_col, "embedding"])

    schema = T.StructType([sparse.schema[key_col], T.StructField("embedding", T.ArrayType(
        T.FloatType() if element == "float" else T.DoubleType()))])
    return packed.mapInArrow(dense, schema)


def embed(df: DataFrame, text_col: str, encoder_factory, *, out_col: str = "embedding",
          encoder_name: str | None = None) -> DataFrame:
    """Add ``out_col`` (array<float>) computed by a pluggable encoder, and
    ``encoder`` (its name)."""
    schema = T.StructType(list(df.schema.fields)
                          + [T.StructField(out_col, T.ArrayType(T.FloatType(), False))])

    def run(batches):
        encode = encoder_factory()
        for pdf in batches:
            texts = pdf[text_col].fillna("").tolist()
            vecs = np.asarray(encode(texts), dtype=np.float32) if texts else np.zeros((0, 0))
            yield pdf.assign(**{out_col: pd.Series(list(vecs), dtype=object)})

    out = df.mapInPandas(run, schema)
    return out.withColumn("encoder", F.lit(encoder_name or getattr(encoder_factory, "__name__",
                                                                      "custom")))


def check_same_encoder(*tables: DataFrame, col: str = "encoder") -> None:
    """Refuse to compare vectors of different encoders.

    Every table has to name its vectors' encoder if any does: one without a name can't be shown to match. Two rows at
    most of each table's names come to the driver; empty tables agree with any."""
    named = [df for df in tables if col in df.columns]
    if not named:
        return
    if len(named) < len(tables):
        raise ValueError(f"some tables name the encoder of their vectors in '{col}', others don't")
    names = set()
    for df in named:
        row = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi"), F.count("*").alias("n"), F.count(col).alias("m")).first()
        if row["n"] != row["m"]:
            raise ValueError(f"'{col}' is NULL in some rows")
        names |= {row["lo"], row["hi"]} - {None}
    if len(names) > 1:
        raise ValueError(f"vectors come from different encoders: {sorted(names)}")
