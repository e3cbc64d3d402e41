"""Operator 10: quality classifier by compression.

Two zstandard dictionaries are built from good and from bad labelled text. A text is compressed with each, block
by block; the difference of the two sizes per byte says whose text it is like. A logistic curve fitted on
labelled rows turns it into a score.

Dictionaries and curve use a bounded sample of labelled documents outside the held-out fold (``FIT_ROWS`` a class), each
read whole. Tasks train a dictionary on all blocks of their share of the sample and the driver trains the final one on
these; tasks compress the other half of the sample for the curve. The driver gets dictionaries and numbers, no texts. Of
several rows of a labelled document the smallest text is learnt from. Every text is scored whole. Null and empty texts have a difference of 0 and the score that the curve gives it. Equal texts have
equal scores. Several labels of a document count as bad if one says so. With only one class of labels, or
none, the score is the share of good labels (1 without any). A null id is in no fold and teaches nothing. Extra
columns don't matter.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphspark.llm.common import in_fold, text_batches
from graphspark.session import materialize

#: Labelled rows of each class that are fitted on (smallest hash of the id first), half for the dictionaries.
FIT_ROWS = 4_000
#: Bytes of a dictionary, of a training sample, and of a block that is compressed by itself.
DICTIONARY_BYTES = 32_768
SAMPLE_BYTES = 512
#: Shares of the sample that are trained on by themselves, for each class.
SHARES = 8
BLOCK_BYTES = 4_096
LEVEL = 3
CUT = 0.7


def _blocks(raw: bytes, size: int) -> list[bytes]:
    return [raw[i:i + size] for i in range(0, len(raw), size)]


def dictionary(raws: list[bytes]) -> bytes:
    """A dictionary trained on all blocks; plain content where there is too little to train."""
    samples = [block for raw in raws for block in _blocks(raw, SAMPLE_BYTES)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:]


class Pair:
    """Compressors primed with the good and the bad dictionary."""

    def __init__(self, good: bytes, bad: bytes):
        self.good, self.bad = (self._compressor(raw) for raw in (good, bad))

    @staticmethod
    def _compressor(raw: bytes):
        primed = zstandard.ZstdCompressionDict(raw)
        primed.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(level=LEVEL, dict_data=primed, write_content_size=False, write_dict_id=False)

    def difference(self, text: str | None) -> float:
        """(size with the bad dictionary - size with the good one) per byte; 0 for an empty text."""
        raw = (text or "").encode("utf-8", "surrogatepass")
        if not raw:
            return 0.0
        blocks = _blocks(raw, BLOCK_BYTES)
        return sum(len(self.bad.compress(b)) - len(self.good.compress(b)) for b in blocks) / len(raw)


def logistic(x: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Intercept and slope of the chance of ``good``; a small ridge keeps a perfect split finite."""
    scale = float(x.std()) or 1.0
    design = np.c_[np.ones(len(x)), x / scale]
    w, ridge = np.zeros(2), np.diag([1e-6, 1e-2])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        step = np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + ridge, design.T @ (good - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1]) / scale


def fit(docs: DataFrame, labels: DataFrame):
    """(good dictionary, bad dictionary, intercept, slope), or the share of good labels where there is one class."""
    known = (labels.where("doc_id is not null and quality is not null")
             .groupBy("doc_id").agg((F.min("quality") > 0).alias("_good"))
             .where(~in_fold(F.col("doc_id"))))
    order = [F.xxhash64("doc_id"), "doc_id"]
    ids = known.where("_good").orderBy(*order).limit(FIT_ROWS).unionByName(
        known.where("not _good").orderBy(*order).limit(FIT_ROWS))
    sample = materialize(docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").where("text is not null and text != ''")
                         .groupBy("doc_id", "_good").agg(F.min("text").alias("text"))
                         .withColumn("_first", F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)) == 0))
    seen = {(r["_good"], r["_first"]): r["count"] for r in sample.groupBy("_good", "_first").count().collect()}
    n_good, n = sum(v for k, v in seen.items() if k[0]), sum(seen.values())
    if n_good in (0, n):
        return n_good / n if n else 1.0
    # the curve is fitted on texts that the dictionaries have not seen, unless there are too few
    halves = len(seen) == 4
    pair = dictionaries(sample.where("_first") if halves else sample)
    rest = differences(sample.where("not _first") if halves else sample, pair, "_good").orderBy("_x", "_good").toPandas()
    return (*pair, *logistic(rest["_x"].to_numpy(), rest["_good"].to_numpy(float)))


def dictionaries(sample: DataFrame) -> tuple[bytes, bytes]:
    """Good and bad dictionary: of each class ``SHARES`` are trained in tasks, and one on the content of these."""

    def train(pdf: pd.DataFrame) -> pd.DataFrame:
        raws = [t.encode("utf-8", "surrogatepass") for t in pdf.sort_values("doc_id")["text"]]
        return pd.DataFrame({"_good": pdf["_good"][:1], "_share": pdf["_share"][:1], "raw": [dictionary(raws)]})

    rows = (sample.select("doc_id", "_good", "text", F.pmod(F.xxhash64("doc_id", F.lit("share")), F.lit(SHARES)).alias("_share"))
            .groupBy("_good", "_share").applyInPandas(train, "_good boolean, _share long, raw binary")
            .orderBy("_good", "_share").collect())
    good, bad = ([bytes(r["raw"]) for r in rows if r["_good"] == side] for side in (True, False))
    return tuple(raws[0] if len(raws) == 1 else dictionary(raws) for raws in (good, bad))


def differences(docs: DataFrame, pair: tuple[bytes, bytes], *keep: str) -> DataFrame:
    """``keep`` columns and ``_x``, the size difference of each text."""
    state: dict[str, Pair] = {}

    @F.pandas_udf("double")
    def difference(texts: pd.Series) -> pd.Series:
        if "pair" not in state:
            state["pair"] = Pair(*pair)
        return pd.Series([state["pair"].difference(t) for t in texts], dtype="float64")

    return docs.select(*keep, difference("text").alias("_x"))


def score(docs: DataFrame, labels: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns, size_difference, score and predicted for every row; the model is bounded by
    ``DICTIONARY_BYTES``, so it travels with the task."""
    text_batches(docs.sparkSession)
    model = fit(docs, labels)
    state: dict[str, Pair] = {}  # compressors are made once for each task

    @F.pandas_udf("size_difference double, score double, predicted int")
    def scored(texts: pd.Series) -> pd.DataFrame:
        if isinstance(model, float):
            x, p = np.zeros(len(texts)), np.full(len(texts), model)
        else:
            if "pair" not in state:
                state["pair"] = Pair(*model[:2])
            x = np.array([state["pair"].difference(t) for t in texts])
            p = 1 / (1 + np.exp(-np.clip(model[2] + model[3] * x, -30, 30)))
        return pd.DataFrame({"size_difference": x, "score": p, "predicted": (p >= CUT).astype("int32")})

    return docs.select(*keep, scored("text").alias("_score")).select(*keep, "_score.*")
