import re
import pytest
from conftest import rows

from graphspark.functions import cosine
from graphspark.operators import classify, knn


@pytest.fixture(scope="module")
def question(spark):
    return spark.createDataFrame([(1, "q", [1.0, 0.0])], "question_id long, question string, "
                                                        "embedding array<float>")


def test_top3_ties_broken_by_id_and_zero_vector_never_ranks(question, node_vectors):
    out = rows(knn.top_k(question, node_vectors, 3), "rank", "id", "sim")
    assert out == [(0, "D:0", 1.0), (1, "D:1", 0.8), (2, "P:1", 0.8)]
    everything = rows(knn.top_k(question, node_vectors, 50), "id")
    assert ("Z:0",) not in everything and len(everything) == 6


def test_top_k_is_prefix_of_top_k_plus_one(spark, node_vectors):
    qs = spark.createDataFrame([(1, [0.3, 0.7]), (2, [-0.2, 1.0]), (3, [1.0, 1.0])],
                               "question_id long, embedding array<float>")
    for k in (1, 2, 4):
        a = rows(knn.top_k(qs, node_vectors, k), "question_id", "rank", "id")
        b = rows(knn.top_k(qs, node_vectors, k + 1), "question_id", "rank", "id")
        assert set(a) <= set(b)


def test_blocked_broadcast_and_partitioning_do_not_change_result(spark, node_vectors):
    qs = spark.createDataFrame([(i, [float(i % 3) - 1.0, 1.0]) for i in range(9)],
                               "question_id long, embedding array<float>")
    base = rows(knn.top_k(qs, node_vectors, 3), "question_id", "rank", "id", "sim")
    blocked = rows(knn.top_k(qs, node_vectors, 3, query_block=2, item_block=2),
                   "question_id", "rank", "id", "sim")
    assert base == blocked
    for n in (1, 4, 16):
        again = rows(knn.top_k(qs.repartition(n), node_vectors.repartition(n), 3),
                     "question_id", "rank", "id", "sim")
        assert again == base


def test_numpy_path_agrees_with_sql_expression(spark, node_vectors):
    qs = spark.createDataFrame([(7, [0.3, 0.7])], "question_id long, embedding array<float>")
    fast = {r["id"]: r["sim"] for r in knn.top_k(qs, node_vectors, 10).collect()}
    from pyspark.sql import functions as F
    j = node_vectors.withColumn("q", F.array(F.lit(0.3).cast("float"), F.lit(0.7).cast("float")))
    expr = {r["id"]: round(r["c"], 6) for r in
            j.select("id", cosine("q", "embedding").alias("c")).collect() if r["c"] is not None}
    assert fast == expr


def test_classifier_ties_keep_menu_order_and_cutoff_inclusive(spark):
    menu = spark.createDataFrame(
        [(0, "kg:a", [1.0, 0.0]), (1, "kg:b", [1.0, 0.0]), (2, "kg:c", [0.0, 1.0])],
        "pos int, predicate string, embedding array<float>")
    qs = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])],
                               "question_id long, embedding array<float>")
    ranked = classify.rank_predicates(qs, menu)
    got = rows(ranked, "question_id", "rank", "predicate", "score")
    assert got[:3] == [(1, 0, "kg:a", 1.0), (1, 1, "kg:b", 1.0), (1, 2, "kg:c", 0.0)]
    picked = rows(classify.pick_predicates(ranked, 1.0), "question_id", "predicate")
    assert picked == [(1, "kg:a"), (1, "kg:b"), (2, "kg:c")]
    marks = rows(classify.calibration(ranked, 0.5), "question_id", "predicate", "mark")
    assert (2, "kg:a", " ") in marks and (2, "kg:c", "*") in marks


def test_hash_embedding_unit_norm(spark):
    from graphspark.operators import embed
    docs = spark.createDataFrame([(1, "Alpha beta beta"), (2, "")], "doc_id long, text string")
    sparse = embed.hash_embed(docs, "doc_id", "text", dim=16)
    w = [r["weight"] for r in sparse.where("doc_id = 1").collect()]
    assert abs(sum(x * x for x in w) - 1.0) < 1e-12
    assert sparse.where("doc_id = 2").count() == 0
    dense = embed.to_dense(sparse, "doc_id", 16).collect()
    assert len(dense[0]["embedding"]) == 16


def test_item_blocks_do_not_change_the_result(spark, node_vectors):
    qs = spark.createDataFrame([(i, [float(i % 5) - 2.0, 1.0]) for i in range(12)],
                               "question_id long, embedding array<float>")
    base = rows(knn.top_k(qs, node_vectors, 3), "question_id", "rank", "id", "sim")
    assert rows(knn.top_k(qs, node_vectors, 3, item_block=1, query_block=5), "question_id", "rank", "id", "sim") == base
    plan = knn.top_k(qs, node_vectors, 3)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "Nested" not in plan and "Cartesian" not in plan


def test_a_menu_beyond_the_broadcast_bound_scores_the_same(spark, question, node_vectors):
    menu = spark.createDataFrame([(i, f"p{i % 3}", [float(i % 4), 1.0]) for i in range(9)],
                                 "pos int, predicate string, embedding array<float>")
    cols = ("question_id", "pos", "predicate", "score", "rank")
    assert rows(knn.score_menu(question, menu), *cols) == rows(knn.score_menu(question, menu, max_menu_rows=2), *cols)


def test_wide_buckets_are_all_used(spark):
    from pyspark.sql import functions as F

    from graphspark.functions import md5_bucket
    top = spark.range(20_000).select(md5_bucket(F.col("id").cast("string"), 1 << 20).alias("b")).agg(F.max("b")).first()[0]
    assert top > 1 << 19


def test_vectors_of_two_encoders_are_refused(spark, question, node_vectors):
    from pyspark.sql import functions as F

    from graphspark.plans import rag
    with pytest.raises(ValueError):
        rag.vector_rag(question.withColumn("encoder", F.lit("a")), node_vectors.withColumn("encoder", F.lit("b")))


def _vectors(spark, n, dim, seed, spread):
    import numpy as np
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    rows = [(f"i{k:04d}", (centres[k % 12] + spread * rng.normal(size=dim)).round(2).tolist()) for k in range(n)]
    rows += [("same1", rows[0][1]), ("same0", rows[0][1]), ("zero", [0.0] * dim), ("none", None)]
    return spark.createDataFrame(rows, "id string, embedding array<double>")


def test_cell_index_gives_the_rows_of_the_full_scan(spark):
    from graphspark.operators import cells
    items = _vectors(spark, 600, 8, 1, 0.1)
    asked = items.where("id < 'i0040' OR id IN ('zero', 'none', 'same0')").selectExpr("id AS question_id", "embedding")
    for k, n_cells, block in ((3, None, 50_000), (7, 40, 20), (1, 1, 50_000), (700, 12, 50_000)):
        index = cells.build(items, n_cells=n_cells, item_block=block)
        assert index.n_items == 602
        hits, met = cells.top_k(index, asked, k, query_block=16)
        want = rows(knn.top_k(asked, items, k), "question_id", "rank", "id", "sim")
        assert rows(hits, "question_id", "rank", "id", "sim") == want
        assert all(0 <= r["pruned"] <= 1 and r["n_items"] == 602 for r in met.collect())
    near = cells.top_k(cells.build(items, n_cells=60), asked, 3)[1].selectExpr("avg(pruned)").first()[0]
    assert near > 0.5  # clustered vectors: most items are never compared


def test_cell_index_of_nothing(spark):
    from graphspark.operators import cells
    items = _vectors(spark, 20, 4, 2, 1.0)
    asked = items.selectExpr("id AS question_id", "embedding")
    assert cells.top_k(cells.build(items.limit(0)), asked, 2)[0].count() == 0
    assert cells.top_k(cells.build(items), asked.limit(0), 2)[0].count() == 0
    with pytest.raises(ValueError):
        cells.top_k(cells.build(items), asked, 0)


def test_learned_encoder_against_plain_counting(spark):
    import hashlib
    import math
    from collections import Counter
    from graphspark.operators import embed
    texts = {"a": "Rare word rare", "b": "word of the day", "c": "слово дня", "d": "東京 word", "e": "...", "f": None, "g": "I"}
    docs = spark.createDataFrame(list(texts.items()), "id string, text string")

    def grams(text):
        out = Counter()
        for w in re.findall(r"[^\W_]+", (text or "").lower()):
            w = f"^{w}$"
            out.update(w[i:i + 3] for i in range(max(1, len(w) - 2)))
        bucket = Counter()
        for g, n in out.items():
            bucket[int(hashlib.md5(g.encode()).hexdigest()[:15], 16) % embed.GRAM_BUCKETS] += n
        return bucket

    counts = {k: grams(t) for k, t in texts.items()}
    df = Counter(g for c in counts.values() for g in c)
    n = sum(bool(c) for c in counts.values())
    weight = {g: math.log((1 + n) / (1 + d)) + 1 for g, d in df.items()}
    fitted = embed.fit_grams(docs, "id", "text")
    assert {r["gram"]: pytest.approx(r["weight"]) for r in fitted.collect()} == weight
    got = {}
    for r in embed.gram_embed(docs, "id", "text", fitted, 64).collect():
        got.setdefault(r["id"], {})[r["bucket"]] = r["weight"]
    assert set(got) == {"a", "b", "c", "d", "g"}  # every script has vectors
    for k in got:
        want = Counter()
        for g, c in counts[k].items():
            want[g // 2 % 64] += (1 - 2 * (g % 2)) * weight[g] * (math.log(c) + 1)
        size = math.sqrt(sum(w * w for w in want.values()))
        assert got[k] == pytest.approx({b: w / size for b, w in want.items()})
    unseen = spark.createDataFrame([("x", "Rares"), ("y", "qqqq")], "id string, text string")
    found = {r["id"] for r in embed.gram_embed(unseen, "id", "text", fitted, 64).collect()}
    assert found == {"x"}  # an inflected word shares grams, an unknown one has none


def test_grams_of_keys_with_one_row_stay_in_the_scan_task(spark, monkeypatch):
    from graphspark.operators import embed
    rows = [("a", "rare word"), ("a", "word again"), ("b", "word ab ab"), (None, "null key"), (None, "key word"), ("c", ""), ("d", None), ("e", "東京 ab")]
    docs = spark.createDataFrame(rows, "id string, text string")

    def all_rows():
        fitted = embed.fit_grams(docs, "id", "text")
        return ({r["gram"]: pytest.approx(r["weight"]) for r in fitted.collect()},
                {(r["id"], r["bucket"]): pytest.approx(r["weight"]) for r in embed.gram_embed(docs, "id", "text", fitted, 16).collect()})

    got = all_rows()
    monkeypatch.setattr(embed, "SLICE_WORDS", 1)
    assert all_rows() == got  # in slices of one text
    monkeypatch.setattr(embed, "_by_rows", lambda df, key: (df.limit(0), df))
    assert all_rows() == got  # all keys counted by grouped aggregation
    monkeypatch.undo()
    single = docs.where("id IN ('b', 'e')")
    weights = spark.createDataFrame(embed.fit_grams(single, "id", "text").collect(), "gram int, weight double")
    plan = embed.gram_embed(single, "id", "text", weights, 16)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Generate" not in plan  # the text's grams aren't shuffled
