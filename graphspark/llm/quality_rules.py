"""Operator 1: quality rules judged by an isolation forest on rule statistics.

Every text gets its rule statistics. A forest of random splits, its leaves counted over all labelled rows,
gives each document a mean path length; short paths are anomalies. The cut between kept and rejected is
calibrated on all labels.

Null and empty texts have no words: all statistics are 0 and the base rule rejects them. Ties and repeated
rows are judged alike, row by row. Without labels (empty table) only the base rule decides. Only ``doc_id``
and ``text`` are read, so extra columns don't matter.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphspark.llm.common import WORD, text_batches, words_of
from graphspark.session import materialize

#: Labelled rows that the trees' random subsamples are drawn from, those with the smallest hash of their id.
FIT_ROWS = 8_192
#: Steps of the score among which the cut is sought.
GRID = 100_000
TREES = 100
TREE_ROWS = 256
SEED = 20_240_501
#: Share of good labelled rows that the calibrated cut may reject at most.
MAX_GOOD_LOSS = 0.005
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
#: Words of a block whose share of different words is taken, so that it doesn't hang on the length of a text.
BLOCK_WORDS = 100

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = ["f_symbols", "f_dup_lines", "f_repeat", "f_word_len", "f_upper", "f_marks", "f_distinct", "f_distinct_low"]
STATS_SCHEMA = ", ".join([f"{c} long" for c in BASE] + [f"{c} double" for c in FEATURES])

_SYMBOL = np.zeros(128, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_SPACE = np.zeros(128, bool)
_SPACE[[32, *range(9, 14)]] = True
_UPPER = np.zeros(128, bool)
_UPPER[65:91] = True
_LOWER = np.zeros(128, bool)
_LOWER[97:123] = True
_DIGIT = np.zeros(128, bool)
_DIGIT[48:58] = True


def repeated_words(words: list[str]) -> int:
    """Words that lie in a window of five words found twice or more (all its places count)."""
    n = len(words)
    if n <= WINDOW:
        return 0
    place = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(place.__getitem__, words), np.int64, n)
    code, base = ids, len(place)
    if base ** WINDOW < 2 ** 62:
        last = n - WINDOW + 1
        code = ids[:last].copy()
        for k in range(1, WINDOW):
            code = code * base + ids[k:last + k]
    else:  # too many different words for one number: renumber after each word added
        for k in range(1, WINDOW):
            code = np.unique(code[:-1] * base + ids[k:], return_inverse=True)[1]
    order = np.argsort(code, kind="stable")
    same = code[order][1:] == code[order][:-1]
    twice = np.zeros(len(code), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + WINDOW, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def distinct_shares(words: list[str]) -> tuple[float, float]:
    """Mean and lowest share of different words over the blocks of the whole text; the last block ends with it."""
    n = len(words)
    if n <= BLOCK_WORDS:
        return (len(set(words)) / max(n, 1),) * 2
    starts = [*range(0, n - BLOCK_WORDS, BLOCK_WORDS), n - BLOCK_WORDS]
    shares = [len(set(words[a:a + BLOCK_WORDS])) / BLOCK_WORDS for a in starts]
    return sum(shares) / len(shares), min(shares)


def rule_stats(text: str | None) -> tuple:
    """Base statistics and the forest's features of one text."""
    if not text:
        return (0,) * len(BASE) + (0.0,) * len(FEATURES)
    words = words_of(text)
    n = len(words)
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    low = code[code < 128]
    n_symbols = int(_SYMBOL[low].sum())
    chars = len(code) - int(_SPACE[low].sum())
    seen: set[str] = set()
    n_lines = n_dup = 0
    for line in text.split("\n"):
        if WORD.search(line):
            n_lines += 1
            if line in seen:
                n_dup += 1
            else:
                seen.add(line)
    repeat = repeated_words(words)
    upper, lower = int(_UPPER[low].sum()), int(_LOWER[low].sum())
    marks = len(low) - upper - lower - int(_DIGIT[low].sum()) - int(_SPACE[low].sum())
    m = max(n, 1)
    return (n, chars, n_symbols, n_dup, repeat, n_symbols / m, n_dup / max(n_lines, 1), repeat / m,
            float(np.log1p(chars / m)), upper / max(upper + lower, 1), marks / max(chars, 1), *distinct_shares(words))


def stats_of(text: str) -> Column:
    """Rule statistics of whole texts as a struct; other columns never leave the JVM.

    Marked as not deterministic so that Spark doesn't push a filter on the statistics below them: it would compute them
    a second time, in a second Python worker beside the first."""
    @F.pandas_udf(STATS_SCHEMA)
    def stats(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([rule_stats(t) for t in texts], columns=BASE + FEATURES)

    return stats.asNondeterministic()(text)


def harmonic(n):
    """Mean path length of an unsuccessful search among ``n`` rows (0 for one row)."""
    n = np.asarray(n, float)
    return np.where(n > 1, 2 * (np.log(np.maximum(n - 1, 1)) + np.euler_gamma) - 2 * (n - 1) / np.maximum(n, 1), 0.0)


def grow(rows: np.ndarray, low: np.ndarray, high: np.ndarray, rng, limit: int) -> list[tuple]:
    """One tree as a list of nodes (feature, cut, left, right, length); a leaf has feature -1.

    ``low`` and ``high`` bound all labelled rows. Half of the cuts fall anywhere in the node's box, so that
    empty space around the node's rows is cut off early and what lies there gets a short path."""
    nodes: list[tuple] = []

    def add(part: np.ndarray, low: np.ndarray, high: np.ndarray, depth: int) -> int:
        at = len(nodes)
        nodes.append(())
        if rng.random() < 0.5 and len(part):
            a, b = part.min(0), part.max(0)
        else:
            a, b = low, high
        spread = np.flatnonzero(b > a)
        if depth >= limit or len(part) <= 1 or not len(spread):
            nodes[at] = (-1, 0.0, at, at, depth + float(harmonic(len(part))))
            return at
        f = int(rng.choice(spread))
        cut = float(rng.uniform(a[f], b[f]))
        left = part[:, f] <= cut
        below, above = high.copy(), low.copy()
        below[f] = above[f] = cut
        nodes[at] = (f, cut, add(part[left], low, below, depth + 1), add(part[~left], above, high, depth + 1), 0.0)
        return at

    add(rows, low, high, 0)
    return nodes


def fit_forest(x: np.ndarray, box: np.ndarray):
    """``TREES`` trees on ``TREE_ROWS`` rows of ``x`` each, as arrays; the same rows give the same forest.

    ``box`` holds the rows whose range bounds the cuts."""
    rng = np.random.default_rng(SEED)
    size = min(TREE_ROWS, len(x))
    limit = 2 * int(np.ceil(np.log2(max(size, 2))))
    low, high = box.min(0), box.max(0)
    forest = []
    for _ in range(TREES):
        nodes = grow(x[rng.choice(len(x), size, replace=False)], low, high, rng, limit)
        forest.append(tuple(np.array(col) for col in zip(*nodes)))
    return forest, float(harmonic(size)), limit


def anomaly(model, x: np.ndarray) -> np.ndarray:
    """2 ** (-mean path length / expected length): near 1 anomalous, below 0.5 ordinary."""
    forest, expected, limit = model
    total = np.zeros(len(x))
    every = np.arange(len(x))
    for feature, cut, left, right, length in forest:
        at = np.zeros(len(x), np.int64)
        for _ in range(limit):
            f = feature[at]
            at = np.where(x[every, np.maximum(f, 0)] <= cut[at], left[at], right[at])
        total += length[at]
    return 2.0 ** (-total / len(forest) / max(expected, 1e-9))


def leaf_of(tree, x: np.ndarray, limit: int) -> np.ndarray:
    """The leaf of a tree that each row falls into."""
    feature, cut, left, right, _ = tree
    at, every = np.zeros(len(x), np.int64), np.arange(len(x))
    for _ in range(limit):
        f = feature[at]
        at = np.where(x[every, np.maximum(f, 0)] <= cut[at], left[at], right[at])
    return at


def recounted(forest, counts: dict[tuple[int, int], int]):
    """The forest with leaf lengths from the numbers of rows given for (tree, leaf), instead of those it was grown on."""
    out = []
    for t, (feature, cut, left, right, length) in enumerate(forest):
        depth = np.zeros(len(feature))
        for at in range(len(feature)):  # a node comes before its children
            if feature[at] >= 0:
                depth[left[at]] = depth[right[at]] = depth[at] + 1
        held = np.array([counts.get((t, at), 0) for at in range(len(feature))])
        out.append((feature, cut, left, right, np.where(feature < 0, depth + harmonic(held), 0.0)))
    return out


def calibrate(cuts: np.ndarray, good: np.ndarray, bad: np.ndarray) -> float:
    """Cut with the best (bad rejected - good rejected) among those that lose few good rows.

    ``good`` and ``bad`` count the labelled rows at each of the ascending cuts, and above the one before."""
    if not good.sum() or not bad.sum():
        return float("inf")
    lost = 1 - np.cumsum(good) / good.sum()
    caught = 1 - np.cumsum(bad) / bad.sum()
    gain = np.where(lost <= MAX_GOOD_LOSS, caught - lost, -1.0)
    return float(cuts[int(gain.argmax())])


def fit(docs: DataFrame, labels: DataFrame):
    """Forest and cut from all labelled rows; None without labelled rows.

    A document with several labels counts as bad if one says so. Every labelled row has its part in the range of the
    cuts, in the leaf counts that make path lengths, and in the calibration of the verdict. Only where the random cuts
    of the ``TREES`` trees fall hangs on the ``TREE_ROWS`` rows that each is grown on, as isolation forests are. The
    driver sees those rows, a count for each leaf and at most ``GRID`` counts of scores."""
    ids = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
           .groupBy("doc_id").agg((F.min("quality") > 0).alias("good")))
    stats = docs.where(F.col("doc_id").isNotNull()).select("doc_id", stats_of("text").alias("_s")).select("doc_id", "_s.*")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    rows = materialize(stats.where(~failed).select("doc_id", *FEATURES).join(ids, "doc_id"))
    ends = rows.agg(F.count_if("good").alias("good"), F.count("*").alias("n"), *[F.min(c).alias(f"low_{c}") for c in FEATURES],
                    *[F.max(c).alias(f"high_{c}") for c in FEATURES]).first()
    if not ends["n"]:
        return None
    low, high = (np.array([ends[f"{side}_{c}"] for c in FEATURES], float) for side in ("low", "high"))
    chosen, n = (rows.where("good"), ends["good"]) if ends["good"] >= TREE_ROWS // 4 else (rows, ends["n"])
    grown = chosen.orderBy(F.xxhash64("doc_id"), "doc_id", *FEATURES).select(FEATURES).limit(FIT_ROWS).toPandas()
    forest, _, limit = fit_forest(grown.to_numpy(float), np.stack([low, high]))

    def leaves(batches):
        counts = [np.zeros(len(tree[0]), np.int64) for tree in forest]
        for batch in batches:
            x = batch.to_numpy(float)
            for t, tree in enumerate(forest):
                counts[t] += np.bincount(leaf_of(tree, x, limit), minlength=len(counts[t]))
        for t, c in enumerate(counts):
            at = np.flatnonzero(c)
            yield pd.DataFrame({"tree": t, "leaf": at, "n": c[at]})

    counts = chosen.select(FEATURES).mapInPandas(leaves, "tree long, leaf long, n long").groupBy("tree", "leaf").agg(F.sum("n").alias("n"))
    model = recounted(forest, {(r["tree"], r["leaf"]): r["n"] for r in counts.collect()}), float(harmonic(n)), limit

    @F.pandas_udf("long")
    def scored(values: pd.DataFrame) -> pd.Series:
        return pd.Series(on_grid(anomaly(model, values[FEATURES].to_numpy(float))))

    scores = (rows.select("good", scored(F.struct(*FEATURES)).alias("cut")).groupBy("cut")
              .agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad")).toPandas().sort_values("cut"))
    return model, calibrate(*(scores[c].to_numpy() for c in ("cut", "good", "bad")))


def on_grid(score: np.ndarray) -> np.ndarray:
    """Scores (0 to 1) as whole numbers up to ``GRID``, rounded up: the steps in which the cut is sought."""
    return np.ceil(score * GRID).astype(np.int64)


def base_failed(rows: pd.DataFrame) -> pd.Series:
    return (rows["n_words"] < MIN_WORDS) | (100 * rows["n_repeat_words"] > MAX_REPEAT_PERCENT * rows["n_words"])


def judge(docs: DataFrame, labels: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns and ``_verdict``: base statistics, ``base_failed``, ``anomaly`` (0 to 1) and ``kept``."""
    text_batches(docs.sparkSession)
    model = fit(docs, labels)

    @F.pandas_udf(", ".join(f"{c} long" for c in BASE) + ", base_failed boolean, anomaly double, kept boolean")
    def verdict(texts: pd.Series) -> pd.DataFrame:
        rows = pd.DataFrame([rule_stats(t) for t in texts], columns=BASE + FEATURES)
        failed = base_failed(rows)
        if model:
            score, cut = anomaly(model[0], rows[FEATURES].to_numpy(float)), model[1]
        else:
            score, cut = np.zeros(len(rows)), np.inf
        return rows[BASE].assign(base_failed=failed, anomaly=score, kept=~failed & (on_grid(score) <= cut))

    return docs.select(*keep, verdict("text").alias("_verdict"))


def kept(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns."""
    rows = docs.select(F.struct(*docs.columns).alias("_row"), "text")
    return judge(rows.withColumn("doc_id", F.col("_row.doc_id")), labels, "_row").where("_verdict.kept").select("_row.*")
