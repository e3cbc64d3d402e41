"""Operator 6: best-fit packing by exact complements.

Documents become token ids with a closing id 0; only longer ones than a sequence are cut. The plan needs just
the number of pieces of each length: for the longest piece left, the single, the pair or the triple of lengths
that fills its gap exactly is looked up among the lengths still available, and used as often as the counts
allow; without one, the best-fitting single length shortens the gap and the lookup starts again. The plan is a
list of patterns (lengths and how often), so its size follows the sequence length, not the corpus.
Pieces then take the places of their length by their rank in a sorted, stored table.

Null and empty texts are one piece of one token. Repeated rows are packed each. Texts of any length are cut
without loss. An empty table gives no rows. Extra columns don't matter.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphspark.llm.common import byte_slices, coded_words, ordered_table, ranges, text_batches, worker_state
from graphspark.session import materialize

LENGTH = 2_048
END = 0
#: Words, and pieces of words, whose ids a worker keeps at most.
KNOWN_WORDS = 100_000
#: Bytes of text that a task encodes at a time; a longer text is encoded by itself.
SLICE_BYTES = 2_000_000

#: Latin letters in lower case that stand for themselves in the vocabulary's normal form.
_LETTERS = "a-z\xdf-\xf6\xf8-\xff"
#: Words of these code points only are cut into the vocabulary's pieces here, others by the tokenizer.
_PLAIN = re.compile("[!-~\xc0-\xd6\xd8-\xf6\xf8-\xff]*")
_PIECE = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^0-9{_LETTERS}]+")


def _byte_letters() -> dict[int, str]:
    """The printable letter that byte-level vocabularies use for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {**{b: chr(b) for b in shown}, **{b: chr(256 + i) for i, b in enumerate(hidden)}}


class Encoder:
    """Ids of words for the word-BPE vocabulary, remembering the pieces it met.

    The vocabulary drops white space and never joins over it, so the ids of a text are those of its words one
    after the other. Plain Latin words are cut into pieces here, with the vocabulary's own rule, and only new
    pieces go through its merges; all other words go through the tokenizer as they are."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.known: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def words(self, words: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each word."""
        known = self.known
        out = [known.get(w) for w in words]
        new = [i for i, ids in enumerate(out) if ids is None]
        if len(known) >= KNOWN_WORDS and 4 * len(new) > 3 * len(words):  # the texts are of another kind now
            known.clear()
        if len(self.pieces) >= KNOWN_WORDS:
            self.pieces.clear()
        room, other = KNOWN_WORDS - len(known), []
        for i in new:
            word = words[i]
            if _PLAIN.fullmatch(word) and "<|" not in word:
                out[i] = b"".join([self.pieces.get(p) or self.piece(p) for p in _PIECE.findall(word.lower())])
                if room > 0:
                    known[word] = out[i]
                    room -= 1
            else:
                other.append(i)
        if other:
            batch = self.tokenizer.encode_batch([words[i] for i in other], add_special_tokens=False)
            for i, e in zip(other, batch):
                out[i] = np.asarray(e.ids, "<u4").tobytes()
                if room > 0:
                    known[words[i]] = out[i]
                    room -= 1
        return out

    def piece(self, piece: str) -> bytes:
        shown = piece if piece.isascii() else "".join(self.letters[b] for b in piece.encode())
        ids = [t.id for t in self.model.tokenize(shown)]
        self.pieces[piece] = struct.pack(f"<{len(ids)}I", *ids)
        return self.pieces[piece]


def _encoder(path: str) -> Encoder:
    """One for each worker process; tasks after the first find its pieces already known."""
    state = worker_state()
    if path not in vars(state).setdefault("encoders", {}):
        state.encoders[path] = Encoder(path)
    return state.encoders[path]


def encode(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, each closed by ``END``, and where each text starts (one more entry than texts).

    Each different word of the batch is encoded once and its ids are copied to its places."""
    different, codes, starts = coded_words(texts)
    ids = _encoder(path).words(different.to_pylist())
    count = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
    flat = np.frombuffer(b"".join(ids), "<u4")
    first = np.cumsum(count) - count
    tokens = count[codes]
    stream = flat[ranges(first[codes], tokens)]
    edges = np.r_[0, np.cumsum(tokens)][starts]  # without the closing ids
    n = len(starts) - 1
    out = np.full(len(stream) + n, END, np.uint32)
    out[np.arange(len(stream)) + np.repeat(np.arange(n), np.diff(edges))] = stream
    return out, edges + np.arange(n + 1)


def pieces(docs: DataFrame, tokenizer_path: str, *keep: str) -> DataFrame:
    """``keep`` columns, piece, start, length, ids_crc32 of every piece; no shuffle, texts read once."""
    text_batches(docs.sparkSession)
    source = docs.select(*keep, "text")
    types = dict(source.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in byte_slices(whole, "text", SLICE_BYTES)):
            ids, edges = encode(batch.column("text"), tokenizer_path)
            size = np.diff(edges)
            cuts = -(-size // LENGTH)
            row = np.repeat(np.arange(len(size)), cuts)
            piece = ranges(np.zeros(len(size), np.int64), cuts)
            start = piece * LENGTH
            length = np.minimum(size[row] - start, LENGTH)
            raw = memoryview(ids.astype("<u4", copy=False)).cast("B")
            at = 4 * (edges[row] + start)
            crc = [zlib.crc32(raw[a:b]) for a, b in zip(at.tolist(), (at + 4 * length).tolist())]
            taken = batch.select(list(keep)).take(pa.array(row))
            yield pa.RecordBatch.from_arrays(
                [*taken.columns, pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(crc, pa.int64())],
                [*keep, "piece", "start", "length", "ids_crc32"])

    return source.mapInArrow(run, ", ".join(f"`{c}` {types[c]}" for c in keep)
                             + ", piece int, start long, length long, ids_crc32 long")


def _pair(have: np.ndarray, total: int, most: int) -> tuple[int, int] | None:
    """Two available lengths with this sum, none above ``most``; the longest first. One length twice needs two."""
    a = np.arange(min(total - 1, most), (total - 1) // 2, -1)  # a >= total - a
    fits = (have[a] > 0) & (have[total - a] > 0) & ((2 * a != total) | (have[a] > 1))
    found = np.flatnonzero(fits)
    return (int(a[found[0]]), int(total - a[found[0]])) if len(found) else None


def _fill(have: np.ndarray, gap: int) -> tuple[int, ...] | None:
    """One, two or three available lengths that fill ``gap`` exactly, as few and as long as can be."""
    if have[gap] > 0:
        return (gap,)
    two = _pair(have, gap, gap)
    if two:
        return two
    for a in np.flatnonzero(have[:gap - 1] > 0)[::-1]:  # the longest of three
        if 3 * a < gap:
            break
        have[a] -= 1
        two = _pair(have, gap - int(a), int(a))
        have[a] += 1
        if two:
            return (int(a), *two)
    return None


def plan(counts: dict[int, int], length: int = LENGTH) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths in order) and how many sequences use each, for so many pieces of each length."""
    have = np.zeros(length + 1, np.int64)
    for k, n in counts.items():
        have[k] = n
    patterns = []
    for longest in range(length, 0, -1):
        while have[longest] > 0:
            pattern, gap = [longest], length - longest
            have[longest] -= 1
            while gap > 0:
                exact = _fill(have, gap)
                if exact:
                    pattern += exact
                    for k in exact:
                        have[k] -= 1
                    gap = 0
                    break
                fits = np.flatnonzero(have[:gap + 1] > 0)
                if not len(fits):
                    break
                best = int(fits[-1])
                pattern.append(best)
                have[best] -= 1
                gap -= best
            # the same pattern is used as often as the counts allow
            lengths, need = np.unique(pattern, return_counts=True)
            more = int((have[lengths] // need).min())
            have[lengths] -= more * need
            patterns.append((tuple(pattern), 1 + more))
    return patterns


def _slots(patterns) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each length: first rank of each slot, its offset, and the sequence id of the slot's first use.

    A slot is one place in a pattern; its uses have consecutive ranks and consecutive sequences."""
    slots: dict[int, list[tuple[int, int, int]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for pattern, times in patterns:
        offset = 0
        for k in pattern:
            slots.setdefault(k, []).append((used.get(k, 0), offset, sequence))
            used[k] = used.get(k, 0) + times
            offset += k
        sequence += times
    return {k: tuple(np.array(c, np.int64) for c in zip(*rows)) for k, rows in slots.items()}


def pack(docs: DataFrame, tokenizer_path: str, *keep: str) -> DataFrame:
    """``keep`` columns, piece, start, length, ids_crc32, sequence_id, offset: one row a piece.

    The driver sees the counts of at most ``LENGTH`` lengths, and for each part of the sorted table how many
    pieces of each of its lengths it holds (parts + lengths rows, as a part starts where another ends)."""
    cut = materialize(pieces(docs, tokenizer_path, *keep))  # narrow rows; sorting reads them twice
    names = cut.columns
    stored = ordered_table(cut, "length", F.xxhash64(*keep, "piece", "ids_crc32"))
    by_part = sorted((r["length"], r["_part"], r["n"], r["first"]) for r in stored.groupBy("length", "_part").agg(
        F.count(F.lit(1)).alias("n"), F.min("_at").alias("first")).collect())
    counts: dict[int, int] = {}
    starts: dict[tuple[int, int], int] = {}
    for length, part, n, first in by_part:
        starts[length, part] = counts.get(length, 0) - first
        counts[length] = counts.get(length, 0) + n
    slots = _slots(plan(counts))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            sequence = np.zeros(len(pdf), np.int64)
            offset = np.zeros(len(pdf), np.int64)
            at = pdf["_at"].to_numpy(np.int64)
            for (length, part), rows in pdf.groupby(["length", "_part"]).indices.items():
                rank = at[rows] + starts[length, part]
                first, place, base = slots[length]
                slot = np.searchsorted(first, rank, "right") - 1
                sequence[rows] = base[slot] + rank - first[slot]
                offset[rows] = place[slot]
            yield pdf[names].assign(sequence_id=sequence, offset=offset)

    types = dict(cut.dtypes)
    return stored.mapInPandas(run, ", ".join(f"`{c}` {types[c]}" for c in names) + ", sequence_id long, offset long")
