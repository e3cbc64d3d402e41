"""The derived graph builds only the tables that a query reads, and vectors are laid out once a row."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from graphspark.operators import cells, embed, knn
from graphspark.plans import kg_testdata as kg


@pytest.fixture
def tables(spark, tmp_path):
    rows = {"region": ("r_regionkey bigint, r_name string", [(0, "ASIA")]),
            "nation": ("n_nationkey bigint, n_name string, n_regionkey bigint", [(0, "INDIA", 0)]),
            "customer": ("c_custkey bigint, c_name string, c_nationkey bigint, c_mktsegment string", [(100, "ann", 0, "X"), (1, None, 0, None)]),
            "supplier": ("s_suppkey bigint, s_name string, s_nationkey bigint", [(7, "sam", 0)]),
            "part": ("p_partkey bigint, p_name string, p_brand string, p_type string, p_size int", [(5, "ring", "B", "T", 30)]),
            "orders": ("o_orderkey bigint, o_custkey bigint, o_orderpriority string", [(9, 100, "1-URGENT")]),
            "lineitem": ("l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_returnflag string",
                         [(9, 1, 5, 7, "R"), (9, 2, 5, 7, "N")])}
    for name, (schema, data) in rows.items():
        spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_a_table_is_built_when_it_is_read(spark, tables):
    graph = kg.StoredGraph(spark, tables)
    assert graph.edge_rows.count() == 9  # 1 + 2 + 1 part_of, 1 placed_by, 2 contains, 1 supplies, 1 ordered_from
    assert graph.hierarchy.count() == 7
    built = graph.base.removeprefix("file:")
    assert os.path.isdir(f"{built}/hierarchy") and not os.path.exists(f"{built}/vectors") and not os.path.exists(f"{built}/edges")
    assert sorted(graph.edges.columns) == sorted(graph.edge_rows.columns) and graph.edges.count() == 9


def test_stored_triples_hold_only_what_queries_read_again(spark, tables):
    graph = kg.StoredGraph(spark, tables)
    assert sorted(graph.triples.columns) == ["object", "predicate", "subject"] and graph.triples.count() == 9
    built = graph.base.removeprefix("file:")
    assert os.path.isdir(f"{built}/triples") and not os.path.exists(f"{built}/edges")
    assert all(f.endswith(".zstd.parquet") or not f.startswith("part-") for _, _, fs in os.walk(f"{built}/triples") for f in fs)


def test_distinct_pairs_take_tasks_by_the_line_items(spark, tables, monkeypatch):
    monkeypatch.setattr(kg, "PAIR_ROWS", 1)
    rows = kg.edges(spark, tables)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") == 2  # supplies, ordered_from: two line items, two tasks each
    assert rows.count() == 9 and rows.where("predicate IN ('kg:supplies', 'kg:ordered_from')").count() == 2


def test_dense_rows_of_any_bucket_order(spark):
    sparse = spark.createDataFrame([("a", 3, 2), ("a", 0, 1), ("b", 2, 5), (None, 1, 1)], "k string, bucket int, weight bigint")
    got = {r["k"]: r["embedding"] for r in embed.to_dense(sparse, "k", 4, "float").collect()}
    assert got == {"a": [1.0, 0.0, 0.0, 2.0], "b": [0.0, 0.0, 5.0, 0.0], None: [0.0, 1.0, 0.0, 0.0]}
    plan = embed.to_dense(sparse, "k", 4)._jdf.queryExecution().optimizedPlan().toString()
    assert "map_from_entries" not in plan  # it was built anew for each place of the vector


def _vectors(spark, n):
    items = spark.range(n).select(F.format_string("i%04d", n - F.col("id")).alias("id"),
                                  F.array((F.col("id") % 3).cast("float") + 1, (F.col("id") % 2).cast("float")).alias("embedding"))
    asked = spark.range(9).select(F.col("id").alias("question_id"), F.array(F.lit(1.0).cast("float"), (F.col("id") % 2).cast("float")).alias("embedding"))
    return asked, items


def test_equal_vectors_enter_the_grid_once(spark):
    asked, items = _vectors(spark, 600)
    assert knn.without_surplus(items, "id", "embedding", 4).count() == 6 * 4
    vectors = [(r["id"], r["embedding"]) for r in items.collect()]
    want = set()
    for q in asked.collect():
        a = q["embedding"]
        def sim(b):
            return round((a[0] * b[0] + a[1] * b[1]) / ((a[0] ** 2 + a[1] ** 2) * (b[0] ** 2 + b[1] ** 2)) ** 0.5, 6)
        best = sorted((-sim(b), i) for i, b in vectors)[:4]
        want |= {(q["question_id"], rank, i, -s) for rank, (s, i) in enumerate(best)}
    assert {tuple(r) for r in knn.top_k(asked, items, 4).collect()} == want
    hits, met = cells.top_k(cells.build(items), asked, 4)
    assert {tuple(r) for r in hits.collect()} == want and met.count() == 9


def test_rows_of_one_question_key_share_its_ranks(spark):
    asked, items = _vectors(spark, 60)
    twice = asked.where("question_id = 0").unionByName(asked.where("question_id = 0"))
    got = [(r["rank"], r["id"]) for r in knn.top_k(twice, items, 4).orderBy("rank").collect()]
    once = [r["id"] for r in knn.top_k(twice.limit(1), items, 4).orderBy("rank").collect()]
    assert got == list(enumerate([once[0], once[0], once[1], once[1]]))


def test_each_different_vector_is_compared_once(spark):
    asked, items = _vectors(spark, 600)
    known = items.unionByName(items.where("id = 'i0001'"))
    once, ids = knn.firsts(known, "id", "embedding", 4)
    assert once.count() == 6 and ids.count() == 6 * 4  # before, all of these ids entered the grid
    assert {r["id"] for r in once.collect()} == {f"i{n:04d}" for n in range(1, 7)}


def test_single_rows_are_encoded_without_shuffling_them(spark):
    rows = spark.createDataFrame([("a", "one two two"), ("b", "Three"), ("c", "?"), ("d", None), (None, "one"), ("e", ""), ("f", "été 5")],
                                 "k string, t string")
    several = rows.unionByName(spark.createDataFrame([("b", "four"), ("b", "three")], "k string, t string"))
    for df in (rows, several, rows.limit(0)):
        want = df.join(kg.encoded(df, "k", "t").drop("encoder"), "k")
        got = embed.with_bags(df, "k", "t", kg.VECTOR_DIM)
        assert sorted((r["k"], r["t"] or "", r["embedding"]) for r in got.collect()) == sorted(
            (r["k"], r["t"] or "", r["embedding"]) for r in want.collect())
    assert "Exchange" not in embed.with_bags(rows, "k", "t", 16)._jdf.queryExecution().executedPlan().toString()


def test_bags_of_single_rows_are_counted_without_a_shuffle(spark):
    rows = spark.createDataFrame([("a", "one two two"), ("b", "?"), ("c", None), ("d", "é 5")], "k string, t string")
    assert "Exchange" not in embed.hash_embed(rows, "k", "t", 64)._jdf.queryExecution().executedPlan().toString()
    parts = spark.createDataFrame([("a", "one"), ("a", "two"), ("a", "two"), (None, "x"), (None, "x y"), ("d", "é"), ("d", "5")],
                                  "k string, t string")
    for normalise in (True, False):
        got = {(r["k"], r["bucket"]): r["weight"] for r in embed.hash_embed(parts, "k", "t", 64, normalise).where("k IS NOT NULL").collect()}
        want = {(r["k"], r["bucket"]): r["weight"] for r in embed.hash_embed(rows, "k", "t", 64, normalise).collect()}
        assert got.keys() == want.keys() and all(abs(got[x] - want[x]) < 1e-12 for x in got)
    nulls = embed.hash_embed(parts, "k", "t", 64, False).where("k IS NULL").collect()
    assert sorted(r["weight"] for r in nulls) == [1, 2]
