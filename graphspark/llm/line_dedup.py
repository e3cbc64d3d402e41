"""Operator 9: line dedup by winnowing over line hashes.

The lines with a word of a text are its sequence. Its windows are the shortest run of lines from each line on, and the
shortest run up to each line, that have ``RUN_WORDS`` words or more. Each window selects its smallest line hash, the
rightmost of equal ones; the selected lines are the fingerprints of the text, one row each with its place. Equal windows
select the same line of themselves, so two places that share a run of ``RUN_WORDS`` words share a fingerprint inside it.

Places are joined by the hash of their fingerprint; what stands in one place only goes no further. A match is then
extended to both sides. A fingerprint is extended in steps, one for each window that selected it: left to the first and
right to the last line of the window, so that every step has its ``RUN_WORDS`` words. A step is known by a 128-bit hash
of its lines and looks for its own earliest place, by partial aggregation. So every different continuation is compared,
a line that stands in a third of all texts makes no pairs, and a step goes where an equal one stands in an earlier
place. Steps that overlap or touch merge to the whole run.

This is every run of that many words that stands in an earlier place, whole: a line of such a run either begins a
window inside the run, or fewer than ``RUN_WORDS`` words of the run are left from it on, and then it lies in the window
up to the run's end. Each step has an earliest place of its own, so no run hangs on what follows it elsewhere.

Places are ordered by (doc_id, text hash, line), null ids last. A line is deleted only if an equal line stands
earlier, so every different line survives somewhere. Runs repeated inside one text count too; a text shorter than
``RUN_WORDS`` words has no window and stays as it is. Rows equal in id and text are one document and stay alike.
Null and empty texts stay as they are; a text whose lines all go becomes empty. Rows are never dropped, and extra
columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphspark.llm.common import WORD, text_batches, words_of
from graphspark.session import materialize

RUN_WORDS = 50
#: Bytes of all runs that may be broadcast.
BROADCAST_BYTES = 16 << 20
_FINGERPRINT = ("_fp long, _id long, _sha long, _at int, "
                "_steps array<struct<x: long, y: long, a: int, b: int>>")


def line_sequence(text: str) -> tuple[list[int], list[int], list[int]]:
    """Hash, words and line number (from 0) of each line with a word."""
    hashes, words, numbers = [], [], []
    for number, line in enumerate(text.split("\n")):
        if line and WORD.search(line):
            raw = xxhash.xxh64_intdigest(line.encode("utf-8", "surrogatepass"))
            hashes.append(raw - (1 << 64) if raw >> 63 else raw)
            words.append(len(words_of(line)))
            numbers.append(number)
    return hashes, words, numbers


def windows(words: list[int], run_words: int = RUN_WORDS) -> list[tuple[int, int]]:
    """(first, one past the last) of each window, once, in order."""
    edge, n = np.r_[0, np.cumsum(words, dtype=np.int64)], len(words)
    stops = np.searchsorted(edge, edge[:-1] + run_words)  # n + 1: too few words from here on
    starts = np.searchsorted(edge, edge[1:] - run_words, "right") - 1  # -1: too few words up to here
    places = {(a, b) for a, b in enumerate(stops.tolist()) if b <= n}
    return sorted(places | {(a, b) for b, a in enumerate(starts.tolist(), 1) if a >= 0})


def winnow(hashes: list[int], words: list[int], run_words: int = RUN_WORDS) -> dict[int, list[tuple[int, int]]]:
    """Place of each selected line, with the windows that selected it."""
    chosen: dict[int, list[tuple[int, int]]] = {}
    for a, b in windows(words, run_words):
        back = hashes[a:b][::-1]
        chosen.setdefault(b - 1 - back.index(min(back)), []).append((a, b))
    return chosen


def _text_key() -> list[Column]:
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("_id"), F.xxhash64("text").alias("_sha")]


def fingerprints(docs: DataFrame, run_words: int = RUN_WORDS) -> DataFrame:
    """One row for each selected line: its hash, text, place and steps. One pass, texts read whole."""
    text_batches(docs.sparkSession)
    step = pa.struct([("x", pa.int64()), ("y", pa.int64()), ("a", pa.int32()), ("b", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, steps, edge = [], [], [0]
            for doc, sha, text in zip(*(batch[c].to_pylist() for c in ("_id", "_sha", "text"))):
                hashes, words, _ = line_sequence(text)
                lines = np.array(hashes, np.int64)
                for at, chosen in winnow(hashes, words, run_words).items():
                    places.append((hashes[at], doc, sha, at))
                    steps += [(xxhash.xxh3_128_digest(lines[a:b].tobytes()), a, b) for a, b in chosen]
                    edge.append(len(steps))
            fp, doc, sha, at = zip(*places) if places else ((),) * 4
            codes, a, b = zip(*steps) if steps else ((),) * 3
            code = np.frombuffer(b"".join(codes), "<i8").reshape(-1, 2)
            ladder = pa.StructArray.from_arrays(
                [pa.array(np.ascontiguousarray(code[:, 0])), pa.array(np.ascontiguousarray(code[:, 1])),
                 pa.array(a, pa.int32()), pa.array(b, pa.int32())], fields=list(step))
            yield pa.RecordBatch.from_arrays(
                [pa.array(fp, pa.int64()), pa.array(doc, pa.int64()), pa.array(sha, pa.int64()), pa.array(at, pa.int32()),
                 pa.ListArray.from_arrays(pa.array(edge, pa.int32()), ladder)], ["_fp", "_id", "_sha", "_at", "_steps"])

    return docs.where("text is not null").select(*_text_key(), "text").mapInArrow(run, _FINGERPRINT)


def shared_places(places: DataFrame) -> DataFrame:
    """The fingerprints whose hash stands in two places or more; a hot hash sends one count a task."""
    shared = places.groupBy("_fp").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_fp")
    return places.join(shared, "_fp", "left_semi")


def extended(places: DataFrame) -> DataFrame:
    """_id, _sha, a, b: the steps of matched fingerprints that have an equal one in an earlier place."""
    steps = places.select("_id", "_sha", F.explode("_steps").alias("_step")).select("_id", "_sha", "_step.*")
    here = F.struct("_id", "_sha", "a")
    firsts = (steps.groupBy("x", "y").agg(F.min(here).alias("_first"), F.count(F.lit(1)).alias("_n"))
              .where("_n > 1").drop("_n"))
    return steps.join(firsts, ["x", "y"]).where(here > F.col("_first")).select("_id", "_sha", "a", "b").distinct()


def merged(steps: DataFrame) -> DataFrame:
    """_id, _sha, _runs: the steps of each text, those that overlap or touch made one. Bounded by the text's lines."""
    order = Window.partitionBy("_id", "_sha").orderBy("a", "b")
    reach = F.max("b").over(order.rowsBetween(Window.unboundedPreceding, -1))
    runs = (steps.withColumn("_new", F.coalesce(F.col("a") > reach, F.lit(True)).cast("int"))
            .withColumn("_run", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
            .groupBy("_id", "_sha", "_run").agg(F.min("a").alias("a"), F.max("b").alias("b")))
    return runs.groupBy("_id", "_sha").agg(F.collect_list(F.struct("a", "b")).alias("_runs"))


def repeated_runs(docs: DataFrame, run_words: int = RUN_WORDS) -> DataFrame:
    """_id, _sha, _runs: runs (first, one past the last line of the sequence) to delete from each text."""
    return merged(extended(shared_places(materialize(fingerprints(docs, run_words)))))


def without_runs(text: str, runs) -> tuple[str, list[int]]:
    """The text without the lines of the runs, and their line numbers."""
    numbers = line_sequence(text)[2]
    edge = np.zeros(len(numbers) + 1, np.int64)
    for run in runs:
        edge[run["a"]] += 1
        edge[run["b"]] -= 1
    gone = [numbers[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) > 0)]
    drop = set(gone)
    return "\n".join(line for i, line in enumerate(text.split("\n")) if i not in drop), gone


def cleaned(docs: DataFrame, run_words: int = RUN_WORDS) -> DataFrame:
    """All rows: ``_row`` (the columns of ``docs``), ``_text`` (without repeated runs), ``_gone`` (line numbers).

    Texts are shuffled only if the runs have more bytes than ``BROADCAST_BYTES``."""
    runs = materialize(repeated_runs(docs, run_words))
    bytes_of_runs = runs.agg(F.sum(32 + 8 * F.size("_runs"))).first()[0] or 0
    if bytes_of_runs <= BROADCAST_BYTES:
        runs = F.broadcast(runs)
    rows = docs.select(F.struct(*docs.columns).alias("_row"), *_text_key())
    joined = rows.join(runs, ["_id", "_sha"], "left")

    @F.pandas_udf("text string, gone array<int>")
    def cut(texts: pd.Series, runs: pd.Series) -> pd.DataFrame:
        done = [(t, []) if r is None or t is None else without_runs(t, r) for t, r in zip(texts, runs)]
        return pd.DataFrame(done, columns=["text", "gone"])

    return (joined.withColumn("_cut", F.when(F.col("_runs").isNotNull(), cut(F.col("_row.text"), F.col("_runs"))))
            .select("_row", F.coalesce(F.col("_cut.text"), F.col("_row.text")).alias("_text"),
                    F.coalesce(F.col("_cut.gone"), F.array().cast("array<int>")).alias("_gone")))


def dedup(docs: DataFrame, run_words: int = RUN_WORDS) -> DataFrame:
    """The rows of ``docs`` with repeated runs deleted from ``text``; ``n_chars``, if there, is counted anew."""
    rows = cleaned(docs, run_words)
    new = {"text": F.col("_text"), "n_chars": F.char_length("_text").cast(dict(docs.dtypes).get("n_chars", "long"))}
    return rows.select(*[new.get(c, F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])
