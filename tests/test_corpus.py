import pytest
from conftest import rows
from pyspark.sql import functions as F

from graphspark.operators import corpus, subgraph


def test_node_text_and_ids(edges, nodes):
    text = {r["id"]: r["text"] for r in corpus.node_text(edges, nodes).collect()}
    assert text["D:0"] == "umbrella. [U, umb]. top node"
    assert text["D:1"] == "subtype one. [S1]"
    assert text["P:1"] == "loose joint"
    ids = {r["id"] for r in corpus.node_ids(edges).collect()}
    assert ids == {"D:0", "D:1", "D:2", "P:1", "P:2", "P:9", "G:1"}
    assert len(text) == 6 and "Z:0" not in text


def test_coverage(edges, nodes):
    r = corpus.text_coverage(edges, nodes).collect()[0]
    assert (r["with_desc"], r["total"], r["n_ids"]) == (2, 6, 7)


def test_named_triples_drop_unknown_endpoints(edges, nodes):
    out = rows(corpus.name_triples(edges, nodes), "subject", "predicate", "object")
    assert ("subtype one", "kg:causes", "gene one") not in out
    assert ("gene one", "kg:causes", "subtype one") in out
    assert len(out) == 9  # e7 points at P:9, which has no node row


def test_seed_selection_inactive_flag(spark):
    df = spark.createDataFrame(
        [("A:1", "x ring", None), ("A:2", "y ring", "0"), ("A:3", "z ring", "False"),
         ("A:4", "w ring", ""), ("B:1", "v ring", None), ("A:5", "other", None)],
        "id string, name string, inactive string")
    got = {r["id"] for r in subgraph.select_seeds(df, "^A:", "ring").collect()}
    assert got == {"A:1", "A:2", "A:4"}


def test_extract_edges_modes(spark):
    edges = spark.createDataFrame(
        [("e1", "part:1", "p", "x:1", "src"), ("e2", "part:10", "p", "x:2", "src"),
         ("e3", "x:3", "p", "x:4", "part:1"), ("e4", "part:1", "p", "part:1", "src")],
        "id string, subject string, predicate string, object string, source string")
    seeds = spark.createDataFrame([("part:1",)], "id string")
    end = sorted(r["id"] for r in subgraph.extract_edges(edges, seeds, "endpoint").collect())
    anyc = sorted(r["id"] for r in subgraph.extract_edges(edges, seeds, "any_column").collect())
    assert end == ["e1", "e4"]          # part:10 is not part:1; self-loop once
    assert anyc == ["e1", "e3", "e4"]   # token in another column counts
    # Without a size proof for the seeds the shuffled path gives the same rows.
    shuffled = subgraph.extract_edges(edges, seeds, "any_column", max_broadcast_seeds=0)
    assert sorted(r["id"] for r in shuffled.collect()) == anyc
    # A row matched by two seeds is kept once on both paths.
    two = spark.createDataFrame([("part:1",), ("x:4",)], "id string")
    for cap in (1_000_000, 0):
        got = subgraph.extract_edges(edges, two, "any_column", max_broadcast_seeds=cap)
        assert sorted(r["id"] for r in got.collect()) == ["e1", "e3", "e4"]


def test_endpoint_rows_are_among_any_column_rows(spark):
    ids = ["ZFIN:ZDB-GENE-990415-8", "Reactome:R-HSA-1", "MONDO:1", "odd id, with | signs", "part:1.5"]
    edges = spark.createDataFrame(
        [(f"e{i}", x, "p", "o:1", None) for i, x in enumerate(ids)]
        + [("l1", "x:1", "p", "x:2", '["MONDO:1", "MONDO:10"]'), ("l2", "x:1", "p", "x:2", "a:1|part:1.5"),
           ("l3", "x:1", "p", "x:2", "MONDO:10 MONDO:1.2"), ("l4", "x:1", "p", None, "Reactome:R-HSA-1-x")],
        "id string, subject string, predicate string, object string, list string")
    seeds = spark.createDataFrame([(x,) for x in ids], "id string")
    for cap in (1_000_000, 0):
        end = {r["id"] for r in subgraph.extract_edges(edges, seeds, "endpoint", max_broadcast_seeds=cap).collect()}
        anyc = sorted(r["id"] for r in subgraph.extract_edges(edges, seeds, "any_column", max_broadcast_seeds=cap).collect())
        assert end == {"e0", "e1", "e2", "e3", "e4"}
        assert anyc == ["e0", "e1", "e2", "e3", "e4", "l1", "l2"]


def test_endpoint_plan_scans_edges_once(spark, edges):
    seeds = spark.createDataFrame([("D:1",)], "id string")
    plan = subgraph.extract_edges(edges, seeds, "endpoint")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("Scan ExistingRDD") == 3   # the edges once, the seeds twice


def test_histograms(edges):
    hist = rows(subgraph.predicate_inventory(edges), "predicate", "n")
    assert ("kg:has_phenotype", 5) in hist and ("kg:subclass_of", 3) in hist
    assert subgraph.edge_total(edges).collect()[0]["n"] == 10


def test_any_column_plan_scans_edges_once(spark):
    edges = spark.createDataFrame(
        [("e1", "part:1", "p", "x:1"), ("e2", "x:3", "p", "part:1")],
        "id string, subject string, predicate string, object string")
    seeds = spark.createDataFrame([("part:1",)], "id string")
    out = subgraph.extract_edges(edges, seeds, "any_column")
    plan = out._jdf.queryExecution().executedPlan().toString()
    # Seeds are probed by broadcast inside the scan; no join back to a second scan.
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert plan.count("Scan ExistingRDD") == 2   # the edges once, the seeds once


def test_more_than_a_hundred_thousand_seeds_are_one_automaton(spark, edges, monkeypatch):
    seeds = spark.range(100_500).select(F.concat(F.lit("D:"), "id").alias("id"))
    want = rows(subgraph.extract_substring(edges, seeds, max_automaton_seeds=0), "id")
    with monkeypatch.context() as m:
        m.setattr(subgraph, "_gram_join", lambda *_: pytest.fail("the rows were cut into grams"))
        assert rows(subgraph.extract_edges(edges, seeds, "substring"), "id") == want and want
    monkeypatch.setattr(subgraph, "MAX_AUTOMATON_CHARS", 100)
    joined = []
    monkeypatch.setattr(subgraph, "_gram_join", lambda e, _: joined.append(1) or e)
    subgraph.extract_edges(edges, seeds, "substring")
    assert joined
