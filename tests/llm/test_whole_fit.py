"""The quality forest and its cut come from all labelled rows, not from the rows that its trees were grown on."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from graphspark.llm import quality_rules as rules


def test_counts_and_cut_come_from_all_labelled_rows(spark, monkeypatch):
    rng = np.random.default_rng(1)
    words = np.array([f"word{k}" for k in range(500)])
    rows = [(i, " ".join(rng.choice(words, 40))) for i in range(400)] + [(400 + i, "# $ % & * | ## $$ %% && " + " ".join(rng.choice(words, 20)).upper()) for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.range(500).select(F.col("id").alias("doc_id"), (F.col("id") < 400).cast("int").alias("quality"))
    monkeypatch.setattr(rules, "FIT_ROWS", 64)
    (forest, expected, limit), cut = rules.fit(docs, labels)
    assert expected == rules.harmonic(400)
    stats = np.array([rules.rule_stats(t)[-len(rules.FEATURES):] for _, t in rows], float)
    for tree in forest[:5]:
        at, held = np.unique(rules.leaf_of(tree, stats[:400], limit), return_counts=True)
        depth = dict.fromkeys([0], 0)
        for node in range(len(tree[0])):
            if tree[0][node] >= 0:
                depth[tree[2][node]] = depth[tree[3][node]] = depth[node] + 1
        assert np.allclose(tree[4][at], [depth[a] + float(rules.harmonic(n)) for a, n in zip(at, held)])
    scores = rules.on_grid(rules.anomaly((forest, expected, limit), stats))
    good, bad = scores[:400], scores[400:]
    best = max((((bad > c).mean() - (good > c).mean()), -c) for c in np.unique(scores) if (good > c).mean() <= rules.MAX_GOOD_LOSS)
    assert cut == -best[1]
    assert (bad > cut).mean() > 0.9


def test_statistics_are_computed_once_a_text(spark):
    docs = spark.createDataFrame([(1, "one two three"), (2, "# # #"), (3, None)], "doc_id long, text string")
    stats = docs.select("doc_id", rules.stats_of("text").alias("_s")).select("doc_id", "_s.*").where("n_words > 0")
    plan = stats._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1  # not once more below the filter
    assert sorted((r["doc_id"], r["n_symbols"]) for r in stats.collect()) == [(1, 0), (2, 3)]
