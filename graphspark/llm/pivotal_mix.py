"""Operator 4: mixing sources to target weights by pivotal dependent rounding.

Each source gets a target of words; each of its documents the expected copies target / source size. Whole
copies are taken at once. The fractions left over are rounded dependently: two documents of a source meet, and
words move at random from one to the other until one fraction is 0 or 1, so that the source's words stay the
same and each document keeps its expectation. Within a group the largest documents meet first, and one that is large
beside all that follow meets these together, so that what stays open is mostly small. Groups of documents are reduced to one open fraction each; open
fractions meet again, group by group, in a tree; the last one of a source is drawn.

All chance is a hash of (source, group, level) over a fixed order, so reruns and lost executors give the same
mix. A null source is a source of its own; null and empty texts have size 0 and add nothing. Rows equal in the kept
columns and size are counted first and their copies rounded together, then dealt evenly, so no group of equal rows meets
in one task. An empty table gives an empty mix. Extra columns don't matter.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from graphspark.llm.common import global_rank, sized_broadcast, text_batches, words_of
from graphspark.session import materialize

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_REPEATS = 2
#: Documents that one task rounds together, and open fractions that meet in one group of the tree.
GROUP = 1_024
#: Equal rows that are dealt their copies in one go.
EQUAL_ROWS = 100_000
FAN_IN = 256
#: Fractions nearer than this to 0 or 1 are whole.
EPS = 1e-9
#: A document with more than this part of the words of those that follow it in its group is large.
LARGE = 1 / 64


def sizes(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns and ``_size``, the number of words of ``text`` (null: 0); no shuffle."""
    text_batches(docs.sparkSession)

    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        return pd.Series([len(words_of(t)) if t else 0 for t in texts], dtype="int64")

    return docs.select(*keep, count("text").alias("_size"))


def targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = MAX_REPEATS) -> DataFrame:
    """_source, _size_sum, _n, _target: ``share`` of all words dealt to the sources by weight.

    Weights repeat over the sources in code point order, null last. A target above ``cap`` times its source
    stops there and the excess is dealt again by weight, until none is above: each round is one aggregation
    over the sources, and the driver sees two sums of it."""
    per = (sized.groupBy(F.col("source").alias("_source"))
           .agg(F.sum("_size").alias("_size_sum"), F.count(F.lit(1)).alias("_n")))
    per = global_rank(per, "_rank", F.col("_source").asc_nulls_last())
    deal = F.array(*[F.lit(float(w)) for w in weights])
    per = per.withColumn("_weight", deal[(F.col("_rank") % len(weights)).cast("int")]).drop("_rank")
    per = materialize(per)
    total = per.agg(F.sum("_size_sum")).first()[0] or 0
    most = F.col("_size_sum") * float(cap)
    level, full = 0.0, -1
    while True:  # words for each unit of weight, from those not full yet; ends after a round that fills none
        capped = most <= F.col("_weight") * F.lit(level)
        row = per.agg(F.sum(F.when(capped, most)), F.sum(F.when(~capped, F.col("_weight"))),
                      F.count(F.when(capped, 1))).first()
        if row[2] == full or not row[1]:
            break
        full = row[2]
        level = (share * total - (row[0] or 0.0)) / row[1]
    return per.select("_source", "_size_sum", "_n", F.least(most, F.col("_weight") * F.lit(level)).alias("_target"))


def _round_large(size: np.ndarray, part: np.ndarray, rng: np.random.Generator) -> None:
    """Large documents, first to last, each against all open ones after it taken together: words move at random one way
    or the other until the large one is whole or one of the others is. The others change by the same fraction each."""
    for i in range(len(part) - 1):
        if not EPS < part[i] < 1 - EPS:
            continue
        others = i + 1 + np.flatnonzero((part[i + 1:] > EPS) & (part[i + 1:] < 1 - EPS))
        words = size[others].sum()
        if size[i] <= LARGE * words or not len(others):
            return
        up = min((1 - part[i]) * size[i], part[others].min() * words)  # words that the large one can gain
        down = min(part[i] * size[i], (1 - part[others].max()) * words)
        move = up if rng.random() * (up + down) < down else -down
        part[i] += move / size[i]
        part[others] -= move / words


def _round_group(size: np.ndarray, part: np.ndarray, seed: int) -> int | None:
    """Make all fractions of ``part`` whole but one at most; the place of that one, if any.

    Words, not copies, are kept: moving d words changes the fractions by d / size."""
    rng = np.random.default_rng(seed)
    _round_large(size, part, rng)
    held = None
    for i in range(len(part)):
        if part[i] <= EPS or part[i] >= 1 - EPS:
            part[i] = round(part[i])
            continue
        if held is None:
            held = i
            continue
        a, b = held, i
        up = min((1 - part[a]) * size[a], part[b] * size[b])  # words that a can gain from b
        down = min(part[a] * size[a], (1 - part[b]) * size[b])
        move = up if rng.random() * (up + down) < down else -down
        part[a] += move / size[a]
        part[b] -= move / size[b]
        for k in (a, b):
            if part[k] <= EPS or part[k] >= 1 - EPS:
                part[k] = round(part[k])
        still = [k for k in (a, b) if 0 < part[k] < 1]
        held = still[0] if still else None
    return held


def counted(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns (narrow ones) and ``source`` of each different row, with ``_size``, ``_size_sum``, ``_target``,
    ``_rows`` (how many rows are equal in these) and ``_copies``: how often the mix takes them together. ``docs`` has
    ``source`` and ``text``; texts are counted where they are read, and only narrow rows are stored and shuffled."""
    names = list(dict.fromkeys([*keep, "source"]))
    sized = materialize(sizes(docs, *keep, *[c for c in ["source"] if c not in keep]))
    key = "concat('s', {})"  # null is a source of its own
    per = targets(sized).selectExpr(f"coalesce({key.format('_source')}, '-') as _key", "_size_sum", "_n", "_target")
    rows = (sized.groupBy(*names, "_size").agg(F.count(F.lit(1)).alias("_rows"))
            .withColumn("_key", F.expr(f"coalesce({key.format('source')}, '-')"))
            .join(sized_broadcast(per), "_key")
            .withColumn("_mean", F.when(F.col("_size_sum") > 0, F.col("_target") / F.col("_size_sum")).otherwise(0.0))
            .withColumn("_mean", F.col("_mean") * F.col("_rows"))
            .withColumn("_copies", F.floor(F.col("_mean") + F.lit(EPS)).cast("long"))
            .withColumn("_part", F.when(F.col("_size") > 0, F.greatest(F.col("_mean") - F.col("_copies"), F.lit(0.0)))
                        .otherwise(0.0))
            .withColumn("_order", F.xxhash64(*keep, "_size"))
            .withColumn("_group", F.expr(f"pmod(_order, cast(ceil(_n / {GROUP}) as bigint))"))
            .drop("_mean", "_n"))
    out, level = None, 0
    while True:
        done = materialize(_reduce(rows, level))
        whole, left = done.where("not _open"), done.where("_open").drop("_open")
        out = whole.drop("_open") if out is None else out.unionByName(whole.drop("_open"))
        width = left.groupBy("_key").count().agg(F.max("count")).first()[0] or 0
        if width <= 1:
            break
        level += 1
        # once a source has few open fractions, they all meet in one group
        rows = left.withColumn("_group", F.lit(0).cast("long") if width <= FAN_IN
                               else F.floor(F.col("_group") / FAN_IN))
    out = out.unionByName(_draw(left))
    return out.select(*names, "_size", "_size_sum", "_target", "_rows", "_copies")


def copies(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns and ``source`` of each row with ``_size``, ``_size_sum``, ``_target`` and ``_copies``: how often
    the mix takes it. Of equal rows the first ones get the odd copies."""
    rows = counted(docs, *keep)
    names = [c for c in rows.columns if c not in ("_rows", "_copies")]
    parts = rows.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(_rows - 1) div {EQUAL_ROWS}"))))
    few, many = parts.where(f"_rows <= {EQUAL_ROWS}"), parts.where(f"_rows > {EQUAL_ROWS}").repartition("_part", *names)
    first = f"_part * {EQUAL_ROWS}"
    return (few.unionByName(many)
            .withColumn("_nth", F.explode(F.expr(f"sequence({first} + 1, least(_rows, {first} + {EQUAL_ROWS}))")))
            .select(*names, F.expr("cast(_copies div _rows + if(_nth <= _copies % _rows, 1, 0) as int)").alias("_copies")))


def _reduce(rows: DataFrame, level: int) -> DataFrame:
    """One level of the tree: in each group of a source at most one row stays ``_open``."""
    names = rows.columns

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_size", "_order"], ascending=[False, True], kind="stable").reset_index(drop=True)
        part = pdf["_part"].to_numpy(float).copy()
        seed = _seed(pdf["_key"][0], int(pdf["_group"][0]), level)
        held = _round_group(pdf["_size"].to_numpy(float), part, seed)
        still = np.zeros(len(pdf), bool)
        if held is not None:
            still[held] = True
        gained = np.where(still, 0, np.rint(part)).astype(int)
        return pdf.assign(_copies=pdf["_copies"] + gained, _part=np.where(still, part, 0.0), _open=still)[[*names, "_open"]]

    cols = ", ".join(f"`{name}` {kind}" for name, kind in rows.dtypes)
    return rows.groupBy("_key", "_group").applyInPandas(run, cols + ", _open boolean")


def _seed(key: str, group: int, level: int) -> int:
    return zlib.crc32(f"{level} {group} {key}".encode("utf-8", "surrogatepass"))


def _draw(left: DataFrame) -> DataFrame:
    """The last open fraction of a source: taken with its own probability."""
    chance = F.pmod(F.xxhash64("_key", "_order", F.lit("last")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return left.withColumn("_copies", F.col("_copies") + (chance < F.col("_part")).cast("int"))


def mix(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, with the columns of ``docs``.

    The decision is made on narrow rows and joined to the texts by (doc_id, hash of the text, source). Rows
    equal in these are alike: the copies of such a group are dealt evenly to its rows, the odd ones to the first in
    the order of a hash of all columns."""
    ident = ["coalesce(cast(doc_id as string), '-') as _doc", "coalesce(sha2(text, 256), '-') as _sha"]
    taken = (counted(docs.selectExpr(*ident, "source", "text"), "_doc", "_sha", "source").where("_copies > 0")
             .selectExpr("_doc", "_sha", "coalesce(concat('s', source), '-') as _src", "_copies as _all", "_rows"))
    rows = docs.select(F.struct(*docs.columns).alias("_row")).selectExpr(
        "_row", "coalesce(cast(_row.doc_id as string), '-') as _doc", "coalesce(sha2(_row.text, 256), '-') as _sha",
        "coalesce(concat('s', _row.source), '-') as _src")
    same = Window.partitionBy("_doc", "_sha", "_src").orderBy(F.xxhash64("_row"))
    dealt = rows.join(taken, ["_doc", "_sha", "_src"]).withColumn("_nth", F.row_number().over(same))
    times = F.expr("cast(_all div _rows + if(_nth <= _all % _rows, 1, 0) as int)")
    return dealt.select("_row", F.explode(F.array_repeat(F.lit(1), times)).alias("_one")).select("_row.*")
