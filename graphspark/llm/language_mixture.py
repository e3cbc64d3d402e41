"""Operator 7: language identification as inference of a mixture.

Each language has a distribution over hashed character trigrams, learnt from labelled texts outside the held-out
fold. A document is a mixture of languages: expectation-maximisation finds its proportions, and the set of
languages is the one with the best penalised likelihood. The predicted language has the largest proportion.

Texts are read whole. A null text, one without a letter (numerals and signs are none), and any text when nothing could be learnt give ``und``
with score 0. Languages of equal proportion are taken in code point order. Equal texts get equal answers. A
null id is in no fold and teaches nothing. Extra columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphspark.llm.common import in_fold, text_batches

#: Texts learnt from for each language, about (those with the smallest hash of their id).
FIT_TEXTS = 2_000
#: Hash buckets of trigrams; the model has one number for each language and bucket.
BUCKETS = 1 << 15
SMOOTHING = 0.5
STEPS = 12
#: Trigrams overlap by two code points, so a text's evidence counts for a third.
OVERLAP = 3.0
UNKNOWN = "und"


def trigram_buckets(text: str) -> np.ndarray:
    """Bucket of every trigram of the lower-cased text, with a blank before and after."""
    code = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    if len(code) < 3:
        return np.zeros(0, np.int64)
    h = code[:-2] * np.uint32(0x9E3779B1) + code[1:-1] * np.uint32(0x85EBCA77) + code[2:] * np.uint32(0xC2B2AE3D)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    return (h >> np.uint32(17)).astype(np.int64)


def fit(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages and log-probabilities (bucket, language).

    Trigrams are counted by task and summed by (language, bucket); the driver gets those sums."""
    text_batches(docs.sparkSession)
    known = docs.where("lang is not null and doc_id is not null and text is not null").where(~in_fold(F.col("doc_id")))
    space = 1 << 40
    place = F.pmod(F.xxhash64("doc_id"), F.lit(space))
    per = known.groupBy("lang").count().withColumn(
        "_below", F.ceil(F.lit(float(space)) * F.least(F.lit(1.0), F.lit(float(FIT_TEXTS)) / F.col("count"))))
    some = known.join(F.broadcast(per.select("lang", "_below")), "lang").where(place < F.col("_below"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for pdf in batches:
            for lang, text in zip(pdf["lang"], pdf["text"]):
                into = sums.setdefault(lang, np.zeros(BUCKETS, np.int64))
                into += np.bincount(trigram_buckets(text), minlength=BUCKETS)
        for lang, into in sums.items():
            used = np.flatnonzero(into)
            yield pd.DataFrame({"lang": lang, "bucket": used.astype("int32"), "n": into[used]})

    rows = (some.select("lang", "text").mapInPandas(count, "lang string, bucket int, n long")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas())
    langs = sorted(rows["lang"].unique())
    table = np.full((BUCKETS, len(langs)), SMOOTHING)
    if langs:
        table[rows["bucket"].to_numpy(), np.searchsorted(langs, rows["lang"].to_numpy(str))] += rows["n"].to_numpy()
    return langs, np.log(table / table.sum(0, keepdims=True)) if langs else table


def proportions(likely: np.ndarray, n: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, float]:
    """Expectation-maximisation of the mixture; ``likely`` (grams, languages), ``n`` counts. Proportions and
    log-likelihood."""
    share, total = start / start.sum(), n.sum()
    for _ in range(STEPS):
        share = share * (likely.T @ (n / (likely @ share))) / total
    return share, float(n @ np.log(likely @ share))


def infer(text: str | None, langs: list[str], table: np.ndarray) -> tuple[str, float, list[str]]:
    """Predicted language, score, and the set of languages of one text."""
    if not text or not langs or not any(map(str.isalpha, text)):
        return UNKNOWN, 0.0, []
    counts = np.bincount(trigram_buckets(text), minlength=BUCKETS)
    used = np.flatnonzero(counts)
    n, logp = counts[used].astype(float), table[used].astype(float)
    likely = np.exp(logp - logp.max(1, keepdims=True))  # a constant for each gram, the same for all sets
    alone = n @ np.log(likely)
    share, _ = proportions(likely, n, np.full(len(langs), 1.0 / len(langs)))
    # sets grow by proportion; each language costs a parameter
    cost = 0.5 * OVERLAP * np.log(max(n.sum(), 2.0))
    single = int(alone.argmax())
    chosen, value, kept = [single], float(alone[single]), np.ones(1)
    order = [single] + [k for k in np.argsort(-share, kind="stable") if k != single]
    for size in range(2, len(langs) + 1):
        some = order[:size]
        part, fit_ = proportions(likely[:, some], n, np.maximum(share[some], 1e-3))
        if fit_ - cost * (size - 1) <= value - cost * (len(chosen) - 1):
            break
        chosen, value, kept = some, fit_, part
    top = min(range(len(chosen)), key=lambda i: (-kept[i], chosen[i]))
    odds = np.exp(np.clip((alone - alone[chosen[top]]) / OVERLAP, -700, 50))  # against the others, each alone
    sure = 1.0 / odds.sum() if len(chosen) == 1 else 1.0
    return langs[chosen[top]], float(kept[top] * sure), [langs[k] for k in chosen]


def identify(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns, lang_pred, score and langs (the chosen set) for every row."""
    text_batches(docs.sparkSession)
    langs, table = fit(docs)
    small = table.astype(np.float32)

    @F.pandas_udf("lang_pred string, score double, langs array<string>")
    def mixture(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([infer(t, langs, small) for t in texts], columns=["lang_pred", "score", "langs"])

    return docs.select(*keep, mixture("text").alias("_lang")).select(*keep, "_lang.*")
