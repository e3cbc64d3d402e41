"""Operator 2: document fingerprints by winnowing.

Rolling hashes of all grams of ``GRAM`` code points; in every window of ``WINDOW`` hashes the smallest is
chosen, the rightmost of equal ones; its place is kept. Two texts that share ``GRAM + WINDOW - 1`` code points
in a row therefore share a fingerprint, and its places say where.

A text shorter than a gram is one gram; one with fewer hashes than a window is one window. Null counts as
empty; an empty text has the empty fingerprint, which is like itself (1) and unlike all others (0). Equal texts
have equal fingerprints. Extra columns don't matter.
"""

from __future__ import annotations

import base64
import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphspark.llm.common import partitions, text_batches

GRAM = 12
WINDOW = 24
#: Multiplier of the rolling hash; odd, so that its powers can be undone modulo 2 ** 64.
BASE = 0x9E3779B97F4A7C15
#: Document buckets for each shuffle partition, so that parts are even.
BUCKETS_PER_PARTITION = 4

_powers: dict[str, np.ndarray] = {}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** i and BASE ** -i modulo 2 ** 64 for i < n at least."""
    if "up" not in _powers or len(_powers["up"]) < n:
        size = max(1 << 14, 1 << int(np.ceil(np.log2(n))))
        for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            step = np.full(size, base, np.uint64)
            step[0] = 1
            _powers[name] = np.multiply.accumulate(step)
    return _powers["up"][:n], _powers["down"][:n]


def gram_hashes(text: str) -> np.ndarray:
    """32-bit hash of every gram, by a rolling polynomial modulo 2 ** 64 that is mixed at the end."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    gram = min(GRAM, len(code))
    up, down = _tables(len(code))
    total = np.zeros(len(code) + 1, np.uint64)
    np.cumsum((code + np.uint64(1)) * up, out=total[1:])
    last = len(code) - gram + 1
    h = (total[gram:] - total[:last]) * down[:last] + np.uint64(gram)
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x94D049BB133111EB)
    return h >> np.uint64(32)


def winnow(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Chosen hashes and their places (code points from the start), in order of place."""
    if not text:
        return np.zeros(0, np.uint32), np.zeros(0, np.uint32)
    h = gram_hashes(text)
    n = len(h)
    # the place, counted down, stands below the hash: of equal hashes the rightmost is the smallest
    low = (h << np.uint64(32)) | (np.uint64(0xFFFFFFFF) - np.arange(n, dtype=np.uint64))
    window, width = min(WINDOW, n), 1
    while width < window:
        step = min(width, window - width)
        low = np.minimum(low[:-step], low[step:])
        width += step
    chosen = low[np.flatnonzero(np.r_[True, low[1:] != low[:-1]])]
    return ((chosen >> np.uint64(32)).astype(np.uint32),
            (np.uint64(0xFFFFFFFF) - (chosen & np.uint64(0xFFFFFFFF))).astype(np.uint32))


def to_string(hashes: np.ndarray, places: np.ndarray) -> str:
    """base64 of (hash: 4 bytes, distance from the place before: 1 byte at most WINDOW) for each choice.

    A choice is at most one window after the one before, so one byte holds the distance."""
    if not len(hashes):
        return ""
    rows = np.empty((len(hashes), 5), np.uint8)
    rows[:, :4] = hashes.astype("<u4").view(np.uint8).reshape(-1, 4)
    rows[:, 4] = np.diff(places, prepend=np.uint32(0)).astype(np.uint8)
    return base64.b64encode(rows.tobytes()).decode()


def from_string(fingerprint: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and places of a fingerprint string."""
    rows = np.frombuffer(base64.b64decode(fingerprint), np.uint8).reshape(-1, 5)
    return rows[:, :4].copy().view("<u4").ravel(), np.cumsum(rows[:, 4].astype(np.uint32))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sets of hashes, each sorted and without repeats."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.concatenate([a, b])
    both.sort()
    shared = int((both[1:] == both[:-1]).sum())
    return shared / (len(both) - shared)


def edited(text: str, following: str) -> str:
    """The last half replaced by as many code points (or all) from the start of the next text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, n_prints and fingerprint of every row; no shuffle."""
    text_batches(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = [t or "" for t in pdf["text"]]
            chosen = [winnow(t) for t in texts]
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "n_chars": [len(t) for t in texts],
                                "n_prints": [len(h) for h, _ in chosen],
                                "fingerprint": [to_string(*c) for c in chosen]})

    return docs.select("doc_id", "text").mapInPandas(
        run, "doc_id long, n_chars long, n_prints long, fingerprint string")


def _buckets(docs: DataFrame) -> DataFrame:
    """doc_id, text, _bucket, _tail: buckets of doc_id from high to low, each closed by a copy of the row
    that comes next (``_tail``), so that every bucket finds its neighbours in itself.

    Bucket bounds are quantiles of the ids: one number a bucket on the driver."""
    spark = docs.sparkSession
    n = BUCKETS_PER_PARTITION * partitions(spark)
    cuts = Counter(float(int(b)) for b in docs.approxQuantile("doc_id", [i / n for i in range(1, n)], 0.1 / n))
    bounds = sorted(cuts)
    total = docs.agg(F.count(F.lit(1)), F.count("doc_id")).first()
    nulls = -(-n * (total[0] - total[1]) // total[0]) if total[0] else 0
    row = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # high ids first, null last; ids beyond 2 ** 53 are compared as doubles by all rows alike
    edges = F.array(*[F.lit(b) for b in bounds]) if bounds else F.array().cast("array<double>")
    row = row.withColumn("_bucket", F.when(F.col("doc_id").isNull(), F.lit(len(bounds) + 1)).otherwise(
        F.lit(len(bounds)) - _at_most(edges, F.col("doc_id"))))
    # an id that is a bound k times, and null, hold many buckets' rows: they go on by the hash of the text, the order of
    # equal ids; a bound is the lowest id of its bucket, so its rows come after the others there
    hot = [(F.col("doc_id").cast("double") == b, k) for b, k in cuts.items() if k > 1 and abs(b) < 1 << 53] + [(F.col("doc_id").isNull(), nulls)]
    sub = F.lit(0)
    for holds, k in hot:
        place = F.floor((F.xxhash64("text").cast("double") / float(1 << 64) + 0.5) * float(k))
        sub = F.when(holds, F.least(place, F.lit(k - 1)) + 1).otherwise(sub)
    row = row.withColumn("_bucket", F.col("_bucket").cast("long") * (n + 2) + sub)
    firsts = {r["_bucket"]: r["_first"] for r in
              row.groupBy("_bucket").agg(F.max("doc_id").alias("_first")).collect()}
    used = sorted(firsts)
    tails = [(used[(i + 1) % len(used)], b) for i, b in enumerate(used)]  # (bucket that follows, bucket)
    if not tails:
        return row.withColumn("_tail", F.lit(False)).limit(0)
    heads = spark.createDataFrame([(f, firsts[f], b) for f, b in tails], "_bucket long, _first long, _for long")
    first = (row.join(F.broadcast(heads), "_bucket").where(F.col("doc_id").eqNullSafe(F.col("_first")))
             .groupBy("_for").agg(F.min_by(F.struct("doc_id", "text"), F.struct(F.xxhash64("text"), "text")).alias("r"))
             .select("r.doc_id", "r.text", F.col("_for").alias("_bucket"), F.lit(True).alias("_tail")))
    return row.withColumn("_tail", F.lit(False)).unionByName(first)


def _at_most(edges, value):
    """How many of the sorted array ``edges`` are at most ``value``."""
    return F.size(F.filter(edges, lambda e: e <= value.cast("double")))


def compare_edited(docs: DataFrame) -> DataFrame:
    """Fingerprint of every text and of its edited text, with likenesses (see the module's docstring).

    The next document is the one with the next lower id, after the lowest the highest; equal ids are ordered by
    a hash of their text, null ids come last. One shuffle of the texts, none of fingerprints; each task holds
    two documents at a time."""
    spark = docs.sparkSession
    text_batches(spark)
    cols = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def pair(row: tuple, after: tuple) -> tuple:
        doc_id, text, hashes, places, known = row
        changed = edited(text, after[1])
        h, p = winnow(changed)
        return (doc_id, len(text), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(),
                to_string(hashes, places), to_string(h, p), likeness(known, np.unique(h)), likeness(known, after[4]))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        before = None
        for pdf in batches:
            out = []
            for doc_id, text, tail in zip(pdf["doc_id"], pdf["text"], pdf["_tail"]):
                hashes, places = winnow(text)
                row = (doc_id, text, hashes, places, np.unique(hashes))
                if before is not None:
                    out.append(pair(before, row))
                before = None if tail else row
            frame = pd.DataFrame(out, columns=cols)
            frame["doc_id"] = frame["doc_id"].astype("Int64")
            yield frame

    dealt = (_buckets(docs).repartition(partitions(spark), "_bucket")
             .sortWithinPartitions("_bucket", "_tail", F.col("doc_id").desc_nulls_last(), F.xxhash64("text"), "text"))
    return dealt.select("doc_id", "text", "_tail").mapInPandas(
        run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
             "near_edited double, near_next double")
