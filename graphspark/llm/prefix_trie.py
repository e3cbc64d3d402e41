"""Operator 12: the trie of conversation prefixes by truncation peeling.

Conversations descend from the greatest depth. At each depth the conversations that end there are merged with the
nodes that survived from below, which makes that depth's nodes with all their sums; then each node's last turn is
stripped and the nodes regroup as their parents. A node is discovered and finished in the same step, so each turn is
touched once.

Depths are peeled in bands, (0, 1], (1, 2], (2, 4], (4, 8] and so on, no wider than ``WIDEST``. What meets inside a
band has the same prefix at its upper depth. Such a group is peeled through its whole band in one task if a count
proves it small (``GROUP_CELLS``); larger groups, whatever their size, are peeled depth by depth with aggregations
that combine in every task before the shuffle. So a first turn that most conversations share costs a few rounds, and
one very long conversation a few bands, not a round a turn. Equal conversations are counted before the descent.

Turns are 128-bit hashes of (depth, role, text); a prefix is the exclusive or of its turns' hashes, so a conversation
needs no task of its own: rows are sorted over all conversations, placed by offsets of the sorted parts, and joined to
arrays by (conversation, band).

Nulls: a null role or text counts as empty, a null turn comes first; rows that agree in conversation and turn are
ordered by role, then text; repeated rows are turns of their own. Rows without conv_id belong to no conversation. An
empty table has no node, not even a root. Extra columns don't matter.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from graphspark.llm.common import WORD_JAVA, partitions, sized_broadcast, text_batches
from graphspark.session import materialize

#: Depths of a band at most: bounds the arrays that a row carries.
WIDEST = 512
#: Rows times depths of a group that one task may peel.
GROUP_CELLS = 200_000
#: Ids of one piece of an id list at most; pieces are digested one after the other.
PIECE_IDS = 4_096
#: Nodes with more children are joined to them by broadcast (there are at most nodes / this many).
MANY_CHILDREN = 5_000
#: Every so many conversations share their first turns (see :func:`rebuild`), at most MOST_SHARED - 1 of them.
SHARED_BY, MOST_SHARED = 20, 4

STATE = "depth int, k1 long, k2 long, conv_id long, n_convs long, n_children long, n_leaves long, saved long"
NODE = STATE + ", p1 long, p2 long"
_STATE = [c.split()[0] for c in STATE.split(", ")]
_NODE = [c.split()[0] for c in NODE.split(", ")]
_PEELED = pa.schema([(c, pa.int32() if c == "depth" else pa.int64()) for c in _NODE] + [("live", pa.bool_())])


def bands(deepest: int) -> list[tuple[int, int]]:
    """(upper depth, lower depth] of each band, from the top."""
    out, low = [], 0
    while low < deepest:
        high = max(1, min(2 * low, low + WIDEST))
        out.append((low, high))
        low = high
    return out


def _band_of(depth: Column) -> Column:
    """The lower depth of the band that holds a depth."""
    doubling = reduce(lambda rest, p: F.when(depth <= p, F.lit(p)).otherwise(rest),
                      [1 << k for k in reversed(range(WIDEST.bit_length()))], F.lit(None))
    return F.coalesce(doubling, (F.ceil(depth / F.lit(WIDEST)) * WIDEST)).cast("int")


# ---- conversations as arrays of prefix keys ----

def ordered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, h1, h2, words, _part, _at: all turns sorted over all conversations and stored without their texts."""
    rows = (conversations.where(F.col("conv_id").isNotNull())
            .select(F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"),
                    F.coalesce("text", F.lit("")).alias("text")))
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text"]
    rows = (rows.repartitionByRange(partitions(rows.sparkSession), *order).sortWithinPartitions(*order)
            .withColumn("_id", F.monotonically_increasing_id()))
    return materialize(rows.select(
        "conv_id", F.xxhash64(F.lit(1), "role", "text").alias("h1"), F.xxhash64(F.lit(2), "role", "text").alias("h2"),
        F.regexp_count("text", F.lit(WORD_JAVA)).cast("long").alias("words"),
        F.shiftright("_id", 33).cast("int").alias("_part"), F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)).alias("_at")))


def placed(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Each conversation's parts (conv_id, _part, _from, _first, total), one narrow row for each part it lies in, and
    the conversations (conv_id, total)."""
    parts = turns.groupBy("conv_id", "_part").agg(F.count("*").alias("n"), F.min("_at").alias("_first"))
    conv = Window.partitionBy("conv_id")
    earlier = conv.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("conv_id", "_part", "_first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_from"),
                         F.sum("n").over(conv).alias("total"))
    return parts, turns.groupBy("conv_id").agg(F.count("*").alias("total"))


def rebuild(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The conversations to put into the trie, (conv_id, length), and their turns (conv_id, depth, h1, h2, words).

    The first h turns of conversation c are those of conversation c - c % 20 (all if it has fewer, none if there is
    none), h being the crc32 of the decimal id modulo 4; its own turns after its first h follow."""
    parts, convs = placed(turns)
    parts, convs = materialize(parts), convs.withColumn(
        "h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % MOST_SHARED)
    convs = convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % SHARED_BY)
    bases = convs.select(F.col("conv_id").alias("base"), F.col("total").alias("_base_total"))
    lead = F.least("h", F.coalesce("_base_total", F.lit(0)))
    convs = materialize(convs.join(bases, "base", "left").withColumn("lead", lead).select(
        "conv_id", "base", "h", "lead", (F.col("lead") + F.greatest(F.lit(0), F.col("total") - F.col("h"))).alias("length")))
    placed_parts = parts.join(convs.select("conv_id", "h", "lead"), "conv_id")
    own = turns.join(placed_parts, ["conv_id", "_part"]).withColumn("_place", F.col("_from") + F.col("_at") - F.col("_first"))
    tail = own.where("_place >= h").select(
        "conv_id", (F.col("_place") - F.col("h") + F.col("lead") + 1).alias("depth"), "h1", "h2", "words")
    firsts = (turns.where(F.col("conv_id") % SHARED_BY == 0).join(parts, ["conv_id", "_part"])
              .withColumn("_place", F.col("_from") + F.col("_at") - F.col("_first"))
              .where(F.col("_place") < MOST_SHARED - 1)
              .select(F.col("conv_id").alias("base"), "_place", "h1", "h2", "words"))
    head = (convs.join(firsts, "base").where("_place < h")
            .select("conv_id", (F.col("_place") + 1).alias("depth"), "h1", "h2", "words"))
    return convs.select("conv_id", "length"), head.unionByName(tail)


def chains(turns: DataFrame) -> DataFrame:
    """conv_id, band, keys, g1, g2: for each band of each conversation the keys of its prefixes there with the words
    of their last turns, in order of depth, and the key of the prefix above the band."""
    rows = turns.select("conv_id", F.col("depth").cast("int").alias("depth"), "words", _band_of(F.col("depth")).alias("band"),
                        *[F.xxhash64(F.lit(k), "depth", "h1", "h2").alias(f"x{k}") for k in (1, 2)])
    inside = Window.partitionBy("conv_id", "band").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.select("conv_id", "band", "depth", "words", *[F.expr(f"bit_xor(x{k})").over(inside).alias(f"x{k}") for k in (1, 2)])
    rows = materialize(rows.groupBy("conv_id", "band").agg(
        F.sort_array(F.collect_list(F.struct("depth", "x1", "x2", "words"))).alias("keys")))
    above = Window.partitionBy("conv_id").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.select("conv_id", "band", *[F.element_at("keys", -1)[f"x{k}"].alias(f"t{k}") for k in (1, 2)])
    sums = sums.select("conv_id", "band", *[F.coalesce(F.expr(f"bit_xor(t{k})").over(above), F.lit(0)).alias(f"g{k}") for k in (1, 2)])
    keys = F.transform("keys", lambda x: F.struct(x["x1"].bitwiseXOR(F.col("g1")).alias("k1"),
                                                  x["x2"].bitwiseXOR(F.col("g2")).alias("k2"), x["words"].alias("words")))
    return materialize(rows.join(sums, ["conv_id", "band"]).select("conv_id", "band", "g1", "g2", keys.alias("keys"))
                       .sortWithinPartitions("band"))


# ---- peeling ----

def _finish(n_children: int, n_leaves: int) -> int:
    return n_leaves if n_children else 1


def peel_group(rows: list[dict], low: int, high: int) -> Iterator[dict]:
    """Peel one group (equal prefixes at depth ``low``) from ``high`` to ``low``: its nodes, then the node at ``low``
    as far as it is known (``live``)."""
    levels: dict[int, dict] = defaultdict(dict)

    def add(depth, key, chain, conv_id, *sums):
        there = levels[depth].get(key)
        if there is None:
            levels[depth][key] = [chain, conv_id, *sums]
        else:
            if conv_id < there[1]:
                there[:2] = chain, conv_id
            there[2:] = [a + b for a, b in zip(there[2:], sums)]

    for r in rows:
        add(r["depth"], (r["k1"], r["k2"]), r["keys"], r["conv_id"], r["n_convs"], r["n_children"], r["n_leaves"], r["saved"])
    for depth in range(high, low, -1):
        for (k1, k2), (chain, conv_id, n_convs, n_children, n_leaves, saved) in levels.pop(depth, {}).items():
            at = depth - low - 1
            n_leaves, saved = _finish(n_children, n_leaves), saved + (n_convs - 1) * chain[at]["words"]
            parent = (chain[at - 1]["k1"], chain[at - 1]["k2"]) if at else (rows[0]["g1"], rows[0]["g2"])
            yield dict(zip(_NODE, (depth, k1, k2, conv_id, n_convs, n_children, n_leaves, saved, *parent)), live=False)
            add(depth - 1, parent, chain, conv_id, n_convs, 1, n_leaves, saved)
    for (k1, k2), (_, conv_id, *sums) in levels.pop(low, {}).items():
        yield dict(zip(_STATE, (low, k1, k2, conv_id, *sums)), live=True)


def _peel_in_tasks(rows: DataFrame, low: int, high: int) -> DataFrame:
    """Groups proven small, each peeled through the band in one task; a task streams its groups."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def stream():
            for batch in batches:
                yield from batch.to_pylist()

        out = []
        for _, group in groupby(stream(), key=lambda r: (r["g1"], r["g2"])):
            out += peel_group(list(group), low, high)
            if len(out) > 20_000:
                yield pa.RecordBatch.from_pylist(out, _PEELED)
                out = []
        yield pa.RecordBatch.from_pylist(out, _PEELED)

    dealt = rows.repartition(partitions(rows.sparkSession), "g1", "g2").sortWithinPartitions("g1", "g2")
    return dealt.mapInArrow(run, NODE + ", live boolean")


def _level(rows: DataFrame, depth: int, low: int) -> DataFrame:
    """The finished nodes of one depth, with their chains: merge what ends there with what survived."""
    key = F.col("keys")[depth - low - 1]
    nodes = (rows.groupBy("k1", "k2")
             .agg(F.min(F.struct("conv_id", "keys", "g1", "g2")).alias("top"),
                  *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")])
             .select("k1", "k2", "top.*", "n_convs", "n_children", "n_leaves", "saved"))
    up = F.col("keys")[depth - low - 2] if depth > low + 1 else F.struct(F.col("g1").alias("k1"), F.col("g2").alias("k2"))
    return nodes.select(
        F.lit(depth).alias("depth"), "k1", "k2", "conv_id", "n_convs", "n_children",
        F.when(F.col("n_children") == 0, F.lit(1)).otherwise(F.col("n_leaves")).cast("long").alias("n_leaves"),
        (F.col("saved") + (F.col("n_convs") - 1) * key["words"]).alias("saved"),
        up["k1"].alias("p1"), up["k2"].alias("p2"), "keys", "g1", "g2")


def _strip(nodes: DataFrame) -> DataFrame:
    """Finished nodes as rows of their parents, not yet regrouped."""
    return nodes.select((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2"), "conv_id",
                        "n_convs", F.lit(1).cast("long").alias("n_children"), "n_leaves", "saved", "keys", "g1", "g2")


def _peel_by_depth(rows: DataFrame, low: int, high: int) -> tuple[list[DataFrame], DataFrame]:
    """Groups of any size, a depth at a time: the nodes of each depth, and the survivors at ``low``."""
    done, live = [], None
    for depth in range(high, low, -1):
        here = rows.where(F.col("depth") == depth)
        nodes = materialize(_level(here if live is None else here.unionByName(live), depth, low))
        done.append(nodes.select(*_NODE))
        live = _strip(nodes)
    return done, live.select(*_STATE)


def _peel_band(rows: DataFrame, low: int, high: int) -> tuple[list[DataFrame], DataFrame]:
    """Nodes of a band and the survivors at its upper depth."""
    if high - low == 1:
        return _peel_by_depth(rows, low, high)
    rows = materialize(rows)
    large = (rows.groupBy("g1", "g2").agg(F.count("*").alias("_n"))
             .where(F.col("_n") * (high - low) > GROUP_CELLS).select("g1", "g2"))
    n_large = large.count()
    if not n_large:
        peeled = materialize(_peel_in_tasks(rows, low, high))
        return [peeled.where("NOT live").select(*_NODE)], peeled.where("live").select(*_STATE)
    large = sized_broadcast(large)
    peeled = materialize(_peel_in_tasks(rows.join(large, ["g1", "g2"], "left_anti"), low, high))
    done, live = _peel_by_depth(rows.join(large, ["g1", "g2"], "left_semi"), low, high)
    return [*done, peeled.where("NOT live").select(*_NODE)], live.unionByName(peeled.where("live").select(*_STATE))


def peel(convs: DataFrame, chain: DataFrame) -> DataFrame:
    """All nodes (``NODE``) of the conversations (conv_id, length) with the given :func:`chains`."""
    ends = end_keys(convs, chain)
    ended = materialize(ends.groupBy("depth", "k1", "k2").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"))
                        .select("depth", "k1", "k2", "conv_id", "n_convs",
                                *[F.lit(0).cast("long").alias(c) for c in ("n_children", "n_leaves", "saved")]))
    deepest = convs.agg(F.max("length")).first()[0]
    live, done = None, []
    for low, high in reversed(bands(deepest or 0)):
        rows = ended.where((F.col("depth") > low) & (F.col("depth") <= high))
        rows = rows if live is None else rows.unionByName(live)
        band = chain.where(F.col("band") == high).drop("band")
        nodes, live = _peel_band(rows.join(band, "conv_id"), low, high)
        done += nodes
    root = ended.where("depth = 0") if live is None else ended.where("depth = 0").unionByName(live)
    root = (root.groupBy("depth", "k1", "k2").agg(F.min("conv_id").alias("conv_id"),
                                                   *[F.sum(c).alias(c) for c in _STATE[4:]])
            .withColumn("n_leaves", F.when(F.col("n_children") == 0, F.lit(1)).otherwise(F.col("n_leaves")).cast("long"))
            .select(*_STATE, F.lit(None).cast("long").alias("p1"), F.lit(None).cast("long").alias("p2")))
    return materialize(reduce(DataFrame.unionByName, done, root))


# ---- what a node's row holds besides ----

def end_keys(convs: DataFrame, chain: DataFrame) -> DataFrame:
    """conv_id, depth, k1, k2: the node at which each conversation ends."""
    last = chain.select("conv_id", "band", F.element_at("keys", -1).alias("_end"))
    return (convs.withColumn("band", F.when(F.col("length") > 0, _band_of(F.col("length"))))
            .join(last, ["conv_id", "band"], "left")
            .select("conv_id", F.col("length").cast("int").alias("depth"),
                    *[F.coalesce(F.col(f"_end.k{k}"), F.lit(0)).alias(f"k{k}") for k in (1, 2)]))


def end_digests(ends: DataFrame) -> DataFrame:
    """k1, k2, ends_sha256: digest of the ascending, comma-joined ids that end at each node.

    Ids are joined in pieces of an id range each, which a task digests one after the other; it holds one batch."""
    text_batches(ends.sparkSession)
    pieces = (ends.groupBy("k1", "k2", F.floor(F.col("conv_id") / F.lit(PIECE_IDS)).alias("piece"))
              .agg(F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids")))
    schema = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("ends_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            out = []
            for k1, k2, ids in zip(*(column.to_pylist() for column in batch.columns)):
                if key == (k1, k2):
                    state.update(b"," + ids.encode())
                else:
                    if key is not None:
                        out.append({"k1": key[0], "k2": key[1], "ends_sha256": state.hexdigest()})
                    key, state = (k1, k2), hashlib.sha256(ids.encode())
            yield pa.RecordBatch.from_pylist(out, schema)
        if key is not None:
            yield pa.RecordBatch.from_pylist([{"k1": key[0], "k2": key[1], "ends_sha256": state.hexdigest()}], schema)

    dealt = pieces.repartition(partitions(ends.sparkSession), "k1", "k2").sortWithinPartitions("k1", "k2", "piece")
    return dealt.select("k1", "k2", "ids").mapInArrow(run, "k1 long, k2 long, ends_sha256 string")


def with_parents(nodes: DataFrame) -> DataFrame:
    """Nodes with the smallest member of their parent. Parents of many children go by broadcast where proven few,
    so that the shuffle holds no hot key; the root's children need no join."""
    parents = nodes.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"),
                           "n_children")
    many = F.col("n_children") > MANY_CHILDREN
    first = nodes.join(sized_broadcast(parents.where(many).drop("n_children")), ["p1", "p2"], "left")
    known = F.col("parent_conv_id").isNotNull()
    rest = first.where(~known).drop("parent_conv_id").join(parents.where(~many).drop("n_children"), ["p1", "p2"], "left")
    return first.where(known).unionByName(rest)


def trie(conversations: DataFrame) -> DataFrame:
    """One row a node of the rebuilt conversations' trie."""
    convs, turns = rebuild(ordered_turns(conversations))
    chain = chains(turns)
    nodes = with_parents(peel(convs, chain)).join(end_digests(end_keys(convs, chain)), ["k1", "k2"], "left")
    return nodes.select("conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children",
                        "n_leaves", F.col("saved").alias("saved_tokens"),
                        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))


ORACLE_SQL = r"""
WITH RECURSIVE crc(conv_id, rest, crc, bit) AS (
  SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR), CAST(4294967295 AS BIGINT), 0 FROM conversations
  WHERE conv_id IS NOT NULL
  UNION ALL
  SELECT conv_id, CASE WHEN bit = 7 THEN substr(rest, 2) ELSE rest END,
         CASE WHEN x & 1 = 1 THEN xor(x >> 1, CAST(3988292384 AS BIGINT)) ELSE x >> 1 END, (bit + 1) % 8
  FROM (SELECT conv_id, rest, bit, CASE WHEN bit = 0 THEN xor(crc, CAST(ascii(rest) AS BIGINT)) ELSE crc END AS x
        FROM crc WHERE rest <> '') AS step),
ids AS (SELECT conv_id, xor(crc, CAST(4294967295 AS BIGINT)) % 4 AS h FROM crc WHERE rest = ''),
turns AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                 row_number() OVER (PARTITION BY conv_id
                                    ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
          FROM conversations WHERE conv_id IS NOT NULL),
rebuilt AS (
  SELECT i.conv_id, 0 AS own, t.place, t.role, t.text
  FROM ids i JOIN turns t ON t.conv_id = i.conv_id - i.conv_id % 20 AND t.place <= i.h
  UNION ALL
  SELECT i.conv_id, 1, t.place, t.role, t.text FROM ids i JOIN turns t ON t.conv_id = i.conv_id AND t.place > i.h),
paths AS (SELECT i.conv_id, coalesce(r.path, []) AS path
          FROM ids i LEFT JOIN (SELECT conv_id, list({'role': role, 'text': text} ORDER BY own, place) AS path
                                FROM rebuilt GROUP BY conv_id) r ON r.conv_id = i.conv_id),
members AS (SELECT conv_id, len(path) AS length, d.depth, path[1:d.depth] AS prefix, path[d.depth].text AS last_text
            FROM paths, LATERAL (SELECT unnest(range(len(path) + 1)) AS depth) AS d),
nodes AS (SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
                 CASE WHEN depth = 0 THEN 0
                      ELSE (count(*) - 1) * len(regexp_extract_all(any_value(last_text), '[^\x20\x09-\x0D]+')) END AS saved,
                 coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE length = depth), '') AS ends
          FROM members GROUP BY prefix, depth),
children AS (SELECT prefix[1:depth - 1] AS prefix, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
sums AS (SELECT a.prefix, sum(a.saved) AS saved, sum(CASE WHEN c.n IS NULL THEN 1 ELSE 0 END) AS n_leaves
         FROM (SELECT n.prefix[1:u.up] AS prefix, n.prefix AS whole, n.saved
               FROM nodes n, LATERAL (SELECT unnest(range(n.depth + 1)) AS up) AS u) a
         LEFT JOIN children c ON c.prefix = a.whole GROUP BY a.prefix)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children,
       CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM nodes n JOIN sums s ON s.prefix = n.prefix
LEFT JOIN children c ON c.prefix = n.prefix
LEFT JOIN nodes p ON n.depth > 0 AND p.prefix = n.prefix[1:n.depth - 1]
"""
