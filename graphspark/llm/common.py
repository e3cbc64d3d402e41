"""Helpers shared by the operators: word rule, tables, sized broadcasts, distributed ranks."""

from __future__ import annotations

import re
import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from graphspark.session import bounded_rows, materialize

#: A word is a maximal run of anything but blank and the ASCII controls tab to carriage return.
WORD = re.compile("[^\\x20\\x09-\\x0D]+")
#: What else ``str.split`` takes for white space; a text without it can be split the fast way.
_OTHER_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
WORD_JAVA = "[^\\x20\\x09-\\x0D]+"

#: Rows a side may have to be broadcast; every caller passes narrow rows (well under 100 bytes).
BROADCAST_ROWS = 200_000

#: Rows of one Arrow batch for tasks that read whole texts: bounds a Python worker's memory.
TEXT_BATCH_ROWS = 1_000


def words_of(text: str) -> list[str]:
    """The words of a text, in order."""
    return WORD.findall(text) if _OTHER_SPACE.search(text) else text.split()


def coded_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words of a batch of texts: the different words, the code of each word in order, and where each text's
    words start (one more entry than texts; null texts have none)."""
    if pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.string())
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))  # splits at blank and tab to carriage return
    starts = lists.offsets.to_numpy().astype(np.int64)
    coded = lists.values.slice(starts[0], starts[-1] - starts[0]).dictionary_encode()
    starts = starts - starts[0]
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    empty = pc.index(coded.dictionary, "").as_py()
    if empty >= 0:  # left at the ends of a text and before the first word
        full = codes != empty
        starts = np.r_[0, np.cumsum(full)][starts]
        codes = codes[full]
    return coded.dictionary, codes, starts


def byte_slices(batch: pa.RecordBatch, column: str, most: int) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices of consecutive rows with at most ``most`` bytes of text each, or one row.

    What a task makes of a slice (codes, ids, places) grows with its text, so this bounds its working memory."""
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends, start = np.cumsum(size), 0
    while start < len(size):
        before = int(ends[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each (start, length), one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)


def worker_state() -> types.ModuleType:
    """Where a Python worker keeps what later tasks may use again (a cache, never results)."""
    return sys.modules.setdefault("graphspark_worker_state", types.ModuleType("graphspark_worker_state"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_batches(spark: SparkSession) -> None:
    """Small Arrow batches: a batch holds at most ``TEXT_BATCH_ROWS`` whole texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXT_BATCH_ROWS))


def sized_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if a count proves it small; unmarked (a shuffle join) otherwise."""
    return F.broadcast(df) if bounded_rows(df, max_rows) else df


def in_fold(doc_id: Column) -> Column:
    """Held-out rows: the crc32 of the id as text leaves 2 when divided by 4. A null id is in no fold."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ordered_table(df: DataFrame, *order) -> DataFrame:
    """``df`` sorted over all rows and stored, with ``_part`` and ``_at`` (place inside the part).

    Range partitioning on the whole order splits a hot leading value over several parts. The table
    lies in the shared checkpoint folder, so places don't change when a task is run again."""
    spark = df.sparkSession
    out = (df.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
           .withColumn("_id", F.monotonically_increasing_id()))
    out = out.select(*df.columns, F.shiftright("_id", 33).cast("int").alias("_part"),
                     F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)).alias("_at"))
    return materialize(out)


def part_offsets(stored: DataFrame) -> dict[int, int]:
    """First global rank of each part of an :func:`ordered_table`: one number a part on the driver."""
    offsets, total = {}, 0
    for row in sorted(stored.groupBy("_part").count().collect()):
        offsets[row["_part"]] = total
        total += row["count"]
    return offsets


def global_rank(df: DataFrame, name: str, *order) -> DataFrame:
    """``df`` with ``name`` = 0-based rank over all rows, without one task seeing all rows."""
    stored = ordered_table(df, *order)
    offsets = part_offsets(stored)
    if not offsets:
        return df.withColumn(name, F.lit(None).cast("long"))
    starts = df.sparkSession.createDataFrame(sorted(offsets.items()), "_part int, _start long")
    return (stored.join(F.broadcast(starts), "_part")
            .select(*df.columns, (F.col("_start") + F.col("_at")).alias(name)))
