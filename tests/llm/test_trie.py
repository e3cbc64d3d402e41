"""Operator 12: the trie of conversation prefixes against a plain one, on each way of peeling."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from graphspark.llm import prefix_trie, queries

from .conftest import CLASH, SF

WORD = re.compile("[^\\x20\\x09-\\x0D]+")
SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in convs.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        path = own.get(c - c % 20, [])[:h] + turns[h:]
        keys = [b""]
        for turn in path:
            keys.append(hashlib.sha256(keys[-1] + repr(turn).encode()).digest())
        for d, key in enumerate(keys):
            members[d, key].append(c)
            if d:
                parent[d, key], last[d, key] = (d - 1, keys[d - 1]), path[d - 1][1]
        ends[len(path), keys[-1]].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in sorted(members, key=lambda n: -n[0]):
        leaves[node] = leaves[node] or 1
        saved[node] += (len(members[node]) - 1) * len(WORD.findall(last[node])) if node[0] else 0
        if node[0]:
            up = parent[node]
            children[up] += 1
            leaves[up] += leaves[node]
            saved[up] += saved[node]
    return sorted((min(m), n[0], min(members[parent[n]]) if n[0] else None, len(m), children[n], leaves[n], saved[n],
                   hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest()) for n, m in members.items())


parent, last = {}, {}
COLS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def rows_of(df):
    assert df.columns == COLS
    return sorted(map(tuple, df.collect()), key=lambda r: tuple((x is not None, x) for x in r))


def table_of(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return df.select("*", *[F.lit(v).alias(c) for c, v in (CLASH | {"depth": "d", "keys": "k", "h": "h"}).items()])


def same(spark, rows):
    got, want = rows_of(prefix_trie.trie(table_of(spark, rows))), brute(rows)
    assert sorted(got, key=repr) == sorted(want, key=repr)


HARD = [(0, 0, "u", "a b"), (0, 1, "a", "c"), (0, 2, "u", "d d d"), (0, 3, "a", "e"),
        (1, 0, "u", "x"), (2, None, None, "y"), (2, None, None, "y"), (2, 5, "u", None), (3, 1, "u", ""), (3, 1, "b", "z"),
        (3, 1, "b", "z"), (45, 0, "u", "no base"), (45, 1, "a", "t"), (46, 0, "u", "no base"), (46, 1, "a", "t"),
        (60, 0, "u", "one"), (61, 0, "u", "one"), (62, 0, "u", "one"), (63, 0, "u", "p"), (None, 0, "u", "nobody"),
        *[(70 + k, t, "u", f"w{t}") for k in range(8) for t in range(3 + k % 3)], (2**62, 0, "u", "far")]


def grown(n, seed=5):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rng.randint(0, 9)):
            rows.append((c, t, "u", "first" if t == 0 and c % 3 else f"w w{rng.randint(0, 1 + t // 2)}"))
        rows += [(c, t, "u", "same") for t in range(rng.choice([0, 0, 0, 12]))]
    return rows


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted(rows_of(queries.conversation_trie(spark, SF)), key=repr) == sorted(brute(rows), key=repr)


def test_nulls_ties_repeats_and_missing_bases(spark):
    same(spark, HARD)


def test_empty_table_has_no_node(spark):
    assert prefix_trie.trie(table_of(spark, HARD).limit(0)).count() == 0
    assert prefix_trie.trie(table_of(spark, [(None, 1, "u", "t")])).count() == 0


def test_groups_of_any_size_peel_alike(spark, monkeypatch):
    rows = grown(150)
    same(spark, rows)
    monkeypatch.setattr(prefix_trie, "GROUP_CELLS", 40)  # most groups go depth by depth
    monkeypatch.setattr(prefix_trie, "MANY_CHILDREN", 2)
    monkeypatch.setattr(prefix_trie, "PIECE_IDS", 7)
    same(spark, rows)


def test_very_long_conversation_in_few_bands(spark):
    rows = [(c, t, "u", f"w{t}") for c in (20, 21, 22) for t in range(1_300 + c)] + [(23, 0, "u", "w0"), (24, 1, "u", "v")]
    assert len(prefix_trie.bands(1_322)) == 12
    same(spark, rows)


@pytest.mark.parametrize("depth", [1, 2, 3, 4, 5, 8, 9, 512, 513, 1024, 1025, 1536, 5000])
def test_bands_hold_every_depth(spark, depth):
    low, high = next(b for b in prefix_trie.bands(depth) if b[0] < depth <= b[1])
    assert high - low <= prefix_trie.WIDEST
    assert spark.range(1).select(prefix_trie._band_of(F.lit(depth))).first()[0] == high
