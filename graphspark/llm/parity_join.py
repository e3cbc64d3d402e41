"""Operator 3: n-gram Jaccard join by parity sketches.

A document is the set of its shingles of ``SHINGLE`` words, or as many as the caller names. Hashing each shingle to one bit and taking the parity of each bit
gives a sketch; the Hamming distance of two sketches is at most the symmetric difference of the sets. Sets of a
size band that are similar enough differ in at most d shingles, so of p = d + 1 + e blocks of bits at least 1 + e
are equal (pigeonhole). Documents are joined on (band, block, bits of the block); candidates pass a bound on the
sizes, then the Hamming distance of a short sketch, and are then verified on the shingles themselves.

Nothing is lost: every link shares a non-empty block (texts with more than e empty blocks are joined on these too),
each filter bounds the similarity from above, and each pair that shares a block is either tested or already in one
component. Large groups of near copies are joined in rounds: a star around each block's smallest document, then for
components that still meet in a block a spanning forest of the pairs that pass the Hamming bound, then all such
pairs. Equal sets are one class, represented by its smallest document.

Null and empty texts have no shingles and link with nothing. Texts shorter than a shingle have one, the whole
sequence. Rows with the same id are one document: their links are joined. A null id has no component (null).
Extra columns don't matter. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from graphspark.llm.common import coded_words, sized_broadcast, text_batches
from graphspark.llm.components import components
from graphspark.session import materialize

SHINGLE = 4
#: Two documents link from this similarity, in percent.
PERCENT = 85
#: Ratio of a size band's bounds. Narrower bands have fewer, larger blocks, which are seldom equal by chance, but a set
#: lies in more of them: worth it where a low similarity makes blocks small.
BAND_RATIO = 1.5
#: One spare block for so many that may differ: a link shares more than the spare blocks, chance seldom does.
SPARE_SHARE = 3
#: Bits of a block; a key holds the digest of the odd ones.
BLOCK_BITS = 1_024
#: Groups of up to so many members are joined as they are; at most so many pairs a member.
SMALL_GROUP = 8
#: Members of one group that are compared in one task; larger groups are compared in blocks.
GROUP_ROWS = 4_096
#: Block keys after which a task hands on what it has; bounds its memory where texts are long.
KEY_ROWS = 500_000
#: Ids whose texts are picked by a broadcast; beyond, by a shuffle.
ID_ROWS = 1_000_000

_B = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix64(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


def most_different(both: int, percent: int = PERCENT) -> int:
    """Largest symmetric difference of two linked sets whose sizes sum to ``both``."""
    return both * (100 - percent) // (100 + percent)


class Bands:
    """Size bands with their number of blocks; a pair belongs to the band of its larger set."""

    def __init__(self, percent: int = PERCENT, ratio: float = BAND_RATIO):
        self.percent = percent
        self.low, self.high, self.blocks, self.spare, self.words = [], [], [], [], []
        low = 1
        while low < 1 << 40 and len(self.low) < 250:
            high = max(low, int(low * ratio))
            while low == 1 and most_different(2 * (high + 1), percent) == 0:
                high += 1  # in the first band only equal sets link
            d = most_different(2 * high, percent)
            spare = 0 if d == 0 else 1 + (d + 1) // SPARE_SHARE
            self.low.append(low)
            self.high.append(high)
            self.spare.append(spare)
            self.blocks.append(0 if d == 0 else d + 1 + spare)
            self.words.append(max(8, 1 << max(0, (high - 1).bit_length() - 6)))  # of the short sketch, 64 bits each
            low = high + 1

    def of(self, size: int) -> list[int]:
        """Its own band, and those above in which larger sets can link with this size."""
        out = [int(np.searchsorted(self.high, size))]
        while 100 * size // self.percent > self.high[out[-1]]:
            out.append(out[-1] + 1)
        return out


def shingle_sets(texts: pa.Array, shingle: int = SHINGLE) -> Iterator[np.ndarray]:
    """For each text the sorted different 64-bit hashes of its shingles (A-Z lower-cased)."""
    different, codes, starts = coded_words(pc.ascii_lower(texts))
    hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in different.to_pylist()), np.uint64, len(different))
    word = hashes[codes] if len(codes) else np.zeros(0, np.uint64)
    rolled = word[:max(len(word) - shingle + 1, 0)].copy()
    for k in range(1, shingle):
        rolled = rolled * _B + word[k:k + len(rolled)]
    rolled = mix64(rolled)
    for a, b in zip(starts[:-1], starts[1:]):
        if b == a:
            yield np.zeros(0, np.uint64)
        elif b - a < shingle:
            yield np.array([xxhash.xxh64_intdigest(word[a:b].tobytes(), seed=int(b - a))], np.uint64)
        else:
            yield np.unique(rolled[a:b - shingle + 1])


def block_keys(hashes: np.ndarray, band: int, bands: Bands) -> tuple[np.ndarray, int]:
    """Keys of the blocks to join on, the band in the lowest eight bits; how many of them any link must share.

    The high bits of a hash choose the block and the low ones its bit. XOR over a block's bits cancels those that
    occur an even number of times, so equal digests mean equal parities. At least 1 + spare blocks of linked sets
    are equal; empty ones may be among them, and are joined on only where there are too many."""
    p, spare = bands.blocks[band], bands.spare[band]
    if not p:
        return np.zeros(0, np.int64), 1
    block = ((hashes >> np.uint64(32)) * np.uint64(p)) >> np.uint64(32)  # rises with the sorted hashes
    bit = mix64((hashes & np.uint64(BLOCK_BITS - 1)) + block * np.uint64(BLOCK_BITS) + np.uint64(band << 48))
    first = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
    digest = np.bitwise_xor.reduceat(bit, first)
    odd = digest != 0
    key = mix64(digest[odd] + (block[first][odd] + np.uint64(1)) * _B)
    empty = p - int(odd.sum())
    need = 1 + spare - empty
    if need < 1:
        gaps = np.setdiff1d(np.arange(p, dtype=np.uint64), block[first][odd])
        key, need = np.r_[key, mix64((gaps + np.uint64(1)) * _M2 + np.uint64(band))], 1
    return ((key & ~np.uint64(255)) | np.uint64(band)).view(np.int64), need


def short_sketch(hashes: np.ndarray, band: int, bands: Bands) -> np.ndarray:
    """Parity of each bit of a sketch of ``words`` x 64 bits."""
    n = bands.words[band]
    odd = np.bincount((mix64(hashes) & np.uint64(64 * n - 1)).astype(np.int64), minlength=64 * n) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def signatures(docs: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE, ratio: float = BAND_RATIO) -> DataFrame:
    """doc_id, hi, lo (digest of the set), n, own, band, need, sketch: a row for each document and band, ``own``
    for the first of a document.

    Band and sketch are left out (null) for texts whose set the task has met before."""
    text_batches(docs.sparkSession)
    schema = "doc_id long, hi long, lo long, n long, own boolean, band int, need int, sketch array<long>"
    kinds = [pa.int64()] * 4 + [pa.bool_(), pa.int32(), pa.int32(), pa.list_(pa.int64())]
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, seen = Bands(percent, ratio), set()
        for batch in batches:
            rows = []
            for doc, hashes in zip(batch.column("doc_id").to_pylist(), shingle_sets(batch.column("text"), shingle)):
                raw = xxhash.xxh128_digest(hashes.tobytes())
                hi, lo = (int.from_bytes(raw[k:k + 8], "little", signed=True) for k in (0, 8))
                if raw in seen or not len(hashes) or doc is None:
                    rows.append((doc, hi, lo, len(hashes), True, None, None, None))
                    continue
                seen.add(raw)
                for k, band in enumerate(bands.of(len(hashes))):
                    need = block_keys(hashes, band, bands)[1]
                    rows.append((doc, hi, lo, len(hashes), k == 0, band, need, short_sketch(hashes, band, bands)))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)]
                                             if rows else [pa.array([], t) for t in kinds], names)

    return docs.selectExpr("cast(doc_id as bigint) as doc_id", "text").mapInArrow(run, schema)


def key_rows(docs: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE, ratio: float = BAND_RATIO) -> DataFrame:
    """doc_id, key: the block keys of all bands, once a task for texts with one set, so that a set that a third of all
    documents share sends its keys once a task.

    All keys take more room than the texts, so they are not stored but made from the texts where they are shuffled.
    Which of the documents with one set sends the keys may differ from the one with the sketch in ``signatures``."""
    text_batches(docs.sparkSession)

    def rows(ids: list[int], keys: list[np.ndarray]) -> pa.RecordBatch:
        all_ids = np.repeat(np.array(ids, np.int64), [len(k) for k in keys])
        return pa.RecordBatch.from_arrays([pa.array(all_ids), pa.array(np.concatenate(keys))], ["doc_id", "key"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, seen = Bands(percent, ratio), set()
        for batch in batches:
            ids, keys, held = [], [], 0
            for doc, hashes in zip(batch.column("doc_id").to_pylist(), shingle_sets(batch.column("text"), shingle)):
                raw = xxhash.xxh128_digest(hashes.tobytes())
                if raw in seen or not len(hashes) or doc is None:
                    continue
                seen.add(raw)
                for band in bands.of(len(hashes)):
                    keys.append(block_keys(hashes, band, bands)[0])
                    ids.append(doc)
                    held += len(keys[-1])
                if held > KEY_ROWS:
                    yield rows(ids, keys)
                    ids, keys, held = [], [], 0
            if keys:
                yield rows(ids, keys)

    return docs.selectExpr("cast(doc_id as bigint) as doc_id", "text").mapInArrow(run, "doc_id long, key long")


def _groups(signed: DataFrame, nodes: DataFrame, keys: DataFrame) -> DataFrame:
    """key, node, center, _n: blocks that two or more sets share, with the smallest of them.

    A link shares at least ``need`` blocks of a band. So a set that shares fewer with anything has no link there, and of
    the s that it shares the s - need + 1 rarest are enough: two sets that share ``need`` can't share them all among the
    more common rest (prefix filtering, in the order of a block's members, then its key). This takes most of the blocks
    that are equal by chance or by one common passage. Near copies share many blocks with the same members; of these
    one is kept, as it meets the same pairs. A set that several tasks met has its keys from each, which only raises s."""
    shared = keys.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("key"))).where("_n > 1")
    bands = signed.where("band is not null").select("hi", "lo", "band", "need").distinct().join(nodes, ["hi", "lo"])
    needs = signed.where("own").select("doc_id", "hi", "lo").distinct().join(bands, ["hi", "lo"])
    mine = Window.partitionBy("doc_id", "band")
    known = (shared.withColumn("band", _band())
             .withColumn("_m", F.count(F.lit(1)).over(mine)).withColumn("_r", F.row_number().over(mine.orderBy("_n", "key")))
             .join(needs.select("doc_id", "band", "need", "node"), ["doc_id", "band"]).where("_r <= _m - need + 1"))
    known = materialize(known.select("key", "node").distinct())
    digests = [F.bit_xor(F.xxhash64("node", *more)) for more in ([], [F.lit(1)])]  # of the members, 128 bits
    per = known.groupBy("key").agg(F.min("node").alias("center"), F.count(F.lit(1)).alias("_n"),
                                   *[d.alias(name) for d, name in zip(digests, ("_x", "_y"))]).where("_n > 1")
    once = per.groupBy("center", "_n", "_x", "_y").agg(F.min("key").alias("key")).drop("_x", "_y")
    return materialize(known.join(once, "key").select("key", "node", "center", "_n"))


def _near(left: str, right: str) -> str:
    """SQL: the sizes allow a link, and the Hamming distance of the sketches does."""
    lo, hi = f"least({left}.n, {right}.n)", f"greatest({left}.n, {right}.n)"
    hamming = f"aggregate(zip_with({left}.sketch, {right}.sketch, (x, y) -> bit_count(x ^ y)), 0, (s, x) -> s + x)"
    return f"100 * {lo} >= %d * {hi} and {hamming} <= ({lo} + {hi}) * %d div %d"


def _pass_bounds(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, band) that sizes and sketches leave possible."""
    row = F.struct("n", "sketch")
    out = pairs.join(sketches.select(F.col("node").alias("a"), "band", row.alias("_l")), ["a", "band"])
    out = out.join(sketches.select(F.col("node").alias("b"), "band", row.alias("_r")), ["b", "band"])
    return out.where(_near("_l", "_r") % (percent, 100 - percent, 100 + percent)).select("a", "b").distinct()


def verified(pairs: DataFrame, docs: DataFrame, percent: int, shingle: int = SHINGLE) -> DataFrame:
    """The pairs (a, b) whose shingle sets are similar enough. Only the texts of these ids are hashed again."""
    ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    few = docs.selectExpr("cast(doc_id as bigint) as doc_id", "text").join(
        sized_broadcast(materialize(ids), ID_ROWS), "doc_id", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [h.tobytes() for h in shingle_sets(batch.column("text"), shingle)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sets, pa.binary())], ["id", "hashes"])

    sets = materialize(few.mapInArrow(run, "id long, hashes binary"))
    both = (pairs.join(sets.select(F.col("id").alias("a"), F.col("hashes").alias("_l")), "a")
            .join(sets.select(F.col("id").alias("b"), F.col("hashes").alias("_r")), "b"))

    @F.pandas_udf("boolean")
    def similar(left: pd.Series, right: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(left, right):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            shared = len(np.intersect1d(x, y, assume_unique=True))
            out.append(100 * shared >= percent * (len(x) + len(y) - shared))
        return pd.Series(out, dtype=bool)

    return both.where(similar("_l", "_r")).select("a", "b").distinct()


def _band():
    return F.col("key").bitwiseAND(F.lit(255)).cast("int")


def _open_groups(groups: DataFrame, comps: DataFrame) -> DataFrame:
    """key, node, comp, _n of the blocks in which more than one component meets; of two members the star has
    tested the only pair."""
    known = groups.where("_n > 2").join(comps, groups.node == comps.id, "left").select(
        "key", "node", F.coalesce("comp", "node").alias("comp"), "_n")
    mixed = known.groupBy("key").agg(F.min("comp").alias("_a"), F.max("comp").alias("_b")).where("_a != _b")
    return known.join(mixed.select("key"), "key")


def _small_groups(opened: DataFrame) -> DataFrame:
    """(a, b, band) of different components in blocks of at most ``SMALL_GROUP`` members."""
    small = opened.where(F.col("_n") <= SMALL_GROUP)
    left = small.select("key", F.col("node").alias("a"), F.col("comp").alias("_ca"))
    right = small.select("key", F.col("node").alias("b"), F.col("comp").alias("_cb"))
    return left.join(right, "key").where("a < b and _ca != _cb").select("a", "b", _band().alias("band")).distinct()


def _across(opened: DataFrame, sketches: DataFrame, percent: int, forest: bool) -> DataFrame:
    """Pairs of different components in one large block that pass the bounds; with ``forest`` just a spanning
    forest of each task's components, the nearest pairs first. A block is compared part by part, so that a task
    holds two parts at most."""
    parts = F.expr(f"cast(ceil(_n / {GROUP_ROWS}) as bigint)")
    dealt = (opened.where(F.col("_n") > SMALL_GROUP).withColumn("_parts", parts)
             .withColumn("_part", F.expr("pmod(xxhash64(node), _parts)"))
             .withColumn("_other", F.explode(F.expr("sequence(0L, _parts - 1L)")))
             .select("key", "node", "comp", _band().alias("band"), F.least("_part", "_other").alias("_i"),
                     F.greatest("_part", "_other").alias("_j")))
    rows = dealt.join(sketches, ["node", "band"]).select("key", "_i", "_j", "node", "comp", "n", "sketch")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        node, comp, n = (pdf[c].to_numpy(np.int64) for c in ("node", "comp", "n"))
        sketch = np.stack(pdf["sketch"].to_numpy()).astype(np.int64).view(np.uint64)
        found = []
        for i in range(len(pdf) - 1):
            rest = slice(i + 1, None)
            low, high = np.minimum(n[i], n[rest]), np.maximum(n[i], n[rest])
            may = np.flatnonzero((comp[i] != comp[rest]) & (100 * low >= percent * high))
            if len(may):
                far = np.bitwise_count(sketch[rest][may] ^ sketch[i]).sum(1).astype(np.int64)
                room = (low + high)[may] * (100 - percent) // (100 + percent) - far
                keep = room >= 0
                found.append(np.c_[np.full(int(keep.sum()), i), may[keep] + i + 1, room[keep]])
        pairs = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
        if forest and len(pairs):
            pairs = pairs[np.argsort(-pairs[:, 2], kind="stable")]
            pairs = pairs[_spanning(comp[pairs[:, 0]], comp[pairs[:, 1]])]
        a, b = node[pairs[:, 0]], node[pairs[:, 1]]
        return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return rows.groupBy("key", "_i", "_j").applyInPandas(compare, "a long, b long").distinct()


def _spanning(left: np.ndarray, right: np.ndarray) -> list[int]:
    """Places of the pairs that join two trees not joined yet, in the order given."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for k, (x, y) in enumerate(zip(left.tolist(), right.tolist())):
        x, y = find(x), find(y)
        if x != y:
            root[x] = y
            out.append(k)
    return out


def join(docs: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE,
         ratio: float = BAND_RATIO) -> tuple[DataFrame, DataFrame]:
    """(rows: doc_id, n_shingles, component_id of every document; spanning links between class representatives: a, b).

    Pairs already in one component are not tested, so the links give the components, not every similar pair."""
    signed = materialize(signatures(docs, percent, shingle, ratio))
    sets = signed.where("own and n > 0 and doc_id is not null").select("doc_id", "hi", "lo")
    nodes = materialize(sets.groupBy("hi", "lo").agg(F.min("doc_id").alias("node")))
    # rows with one id and several texts: their classes belong together
    digest = F.struct("hi", "lo")
    several = sets.groupBy("doc_id").agg(F.min(digest).alias("_x"), F.max(digest).alias("_y")).where("_x != _y")
    versions = sets.join(several.select("doc_id"), "doc_id").join(nodes, ["hi", "lo"])
    links = [materialize(versions.select(F.col("node").alias("a"), F.col("doc_id").alias("b")).where("a != b").distinct())]

    groups = _groups(signed, nodes, key_rows(docs, percent, shingle, ratio))
    meeting = groups.select("node", _band().alias("band")).distinct()
    sketches = materialize(signed.where("band is not null").select("hi", "lo", "band", "n", "sketch")
                           .join(nodes, ["hi", "lo"]).join(meeting, ["node", "band"], "left_semi")
                           .dropDuplicates(["hi", "lo", "band"]).select("node", "band", "n", "sketch"))
    star = (groups.select(F.col("node").alias("b"), F.col("center").alias("a"), _band().alias("band"))
            .where("a != b").distinct())
    tested = materialize(_pass_bounds(star, sketches, percent))
    links.append(materialize(verified(tested, docs, percent, shingle)))
    for forest in (True, False):
        opened = materialize(_open_groups(groups, components(_all(links))))
        pairs = _across(opened, sketches, percent, forest)
        if forest:
            pairs = pairs.unionByName(_pass_bounds(_small_groups(opened), sketches, percent)).distinct()
        pairs = materialize(pairs.join(tested, ["a", "b"], "left_anti"))
        links.append(materialize(verified(pairs, docs, percent, shingle)))
        tested = tested.unionByName(pairs)
    comps = components(_all(links))
    found = nodes.join(comps, nodes.node == comps.id, "left").select("hi", "lo", F.coalesce("comp", "node").alias("_comp"))
    rows = (signed.where("own").join(found, ["hi", "lo"], "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("_comp", "doc_id")).alias("component_id")))
    return rows, _all(links)


def _all(links: list[DataFrame]) -> DataFrame:
    out = links[0]
    for more in links[1:]:
        out = out.unionByName(more)
    return out


def one_of_each(docs: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE, ratio: float = BAND_RATIO) -> DataFrame:
    """The rows of ``docs`` but one document for each component, that with the smallest id; of rows equal in id
    one stays. Rows without shingles or without id all stay."""
    rows, _ = join(docs, percent, shingle, ratio)
    extra = materialize(rows.where("n_shingles > 0 and component_id != doc_id").select("doc_id").distinct())
    again = materialize(rows.where("n_shingles > 0").groupBy("doc_id").count().where("count > 1").select("doc_id"))
    whole = docs.select(F.struct(*docs.columns).alias("_row"), F.col("doc_id").cast("long").alias("doc_id"))
    left = whole.join(sized_broadcast(extra, ID_ROWS), "doc_id", "left_anti")
    again = sized_broadcast(again, ID_ROWS)
    first = Window.partitionBy("doc_id").orderBy(F.col("_row.text").asc_nulls_last())
    single = (left.join(again, "doc_id", "left_semi").withColumn("_nth", F.row_number().over(first)).where("_nth = 1"))
    return left.join(again, "doc_id", "left_anti").select("_row.*").unionByName(single.select("_row.*"))
