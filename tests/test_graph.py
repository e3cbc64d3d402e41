import pytest
from conftest import rows

from graphspark.operators import graph


@pytest.fixture(scope="module")
def inc(edges):
    return graph.incidence(edges)


def _anchors(spark, pairs):
    return spark.createDataFrame([(i, a, p) for i, (a, p) in enumerate(pairs)],
                                 "question_id long, anchor string, predicate string")


def test_degree_self_loop_once(inc):
    deg = {(r["node"], r["predicate"]): r["n"] for r in graph.degree(inc).collect()}
    hp = "kg:has_phenotype"
    assert [deg.get((n, hp), 0) for n in ("D:1", "D:2", "P:1", "P:2", "D:0")] == [3, 2, 2, 2, 0]
    assert deg[("P:2", "kg:related_to")] == 1


def _cands(spark, ids):
    return spark.createDataFrame([(1, r, i) for r, i in enumerate(ids)],
                                 "question_id long, rank long, id string")


def _picked(spark, preds):
    return spark.createDataFrame([(1, p) for p in preds], "question_id long, predicate string")


def test_hub_choice_ties_and_none(spark, edges):
    hp = ["kg:has_phenotype"]
    hub = graph.disambiguate(_cands(spark, ["P:1", "P:2", "D:2", "D:1"]), _picked(spark, hp), edges)
    assert rows(hub, "id", "rank", "n_edges") == [("D:1", 3, 3)]
    tie = graph.disambiguate(_cands(spark, ["P:1", "P:2"]), _picked(spark, hp), edges)
    assert rows(tie, "id") == [("P:1",)]
    # The broadcast path and the pre-aggregated shuffle path agree.
    cands = _cands(spark, ["P:1", "P:2", "D:2", "D:1", "G:1"])
    two = _picked(spark, hp + ["kg:causes"])
    assert (rows(graph.disambiguate(cands, two, edges, small=True), "id", "rank", "n_edges")
            == rows(graph.disambiguate(cands, two, edges, small=False), "id", "rank", "n_edges"))
    keys = spark.createDataFrame([(n, p) for n in ("P:1", "P:2", "D:2", "D:1", "G:1")
                                  for p in hp + ["kg:causes"]], "node string, predicate string")
    assert (rows(graph.degree_of(edges, keys, small=True), "node", "predicate", "n")
            == rows(graph.degree_of(edges, keys, small=False), "node", "predicate", "n"))
    none = graph.disambiguate(_cands(spark, ["Z:0", "D:0"]), _picked(spark, hp), edges, small=True)
    assert none.count() == 0


def test_traverse_cases(spark, edges, nodes):
    cases = [("D:1", "kg:has_phenotype"), ("D:2", "kg:has_phenotype"), ("D:1", "kg:causes"),
             ("D:1", "kg:subclass_of"), ("P:2", "kg:related_to")]
    out = rows(graph.traverse(_anchors(spark, cases), edges, nodes), "question_id", "other_id", "dir")
    assert out == [(0, "P:1", "out"), (0, "P:1", "out"), (0, "P:2", "out"),
                   (1, "P:2", "out"),
                   (2, "G:1", "in"),
                   (3, "D:0", "out"), (3, "D:2", "in"),
                   (4, "P:2", "out")]


def test_traverse_symmetry(spark, edges, nodes):
    a = rows(graph.traverse(_anchors(spark, [("D:1", "kg:subclass_of")]), edges, nodes),
             "other_id", "dir")
    b = rows(graph.traverse(_anchors(spark, [("D:0", "kg:subclass_of")]), edges, nodes),
             "other_id", "dir")
    assert ("D:0", "out") in a and ("D:1", "in") in b


def test_negated_edges_optional(edges):
    kept = graph.incidence(edges).where("node = 'D:2' and predicate = 'kg:has_phenotype'").count()
    dropped = graph.incidence(edges, exclude_negated=True).where(
        "node = 'D:2' and predicate = 'kg:has_phenotype'").count()
    assert (kept, dropped) == (2, 1)


def test_plans_have_no_cartesian_or_nested_loop(spark, edges, inc, nodes):
    hub = graph.disambiguate(_cands(spark, ["P:1", "D:1"]), _picked(spark, ["kg:has_phenotype"]),
                             edges, small=True)
    hop = graph.traverse(_anchors(spark, [("D:1", "kg:has_phenotype")]), edges, nodes, small=True)
    for df in (hub, hop, graph.degree(inc)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_degree_without_proof_aggregates_before_the_join(spark, edges):
    keys = spark.createDataFrame([("D:1", "kg:has_phenotype")], "node string, predicate string")
    plan = graph.degree_of(edges, keys, small=False)._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    semi = next(i for i, s in enumerate(lines) if "LeftSemi" in s)
    partial = max(i for i, s in enumerate(lines) if "HashAggregate" in s and "partial_count" in s)
    # The pairs are met after the edges were counted (partially, per task): the
    # semi-join sits above the partial aggregation in the printed tree.
    assert semi < partial


def test_keys_that_are_not_small_meet_filtered_edges(spark, edges):
    """Edges without a key's node stay out of the shuffle; rows and counts are those of the broadcast plans."""
    keys = spark.createDataFrame([("D:1", "kg:has_phenotype", 1), ("P:2", "kg:related_to", 2), ("P:2", "kg:has_phenotype", 3)],
                                 "node string, predicate string, q int")
    wide = graph.incident(edges, keys)
    assert wide._jdf.queryExecution().optimizedPlan().toString().count("_words") >= 2
    assert rows(wide, "node", "q", "other", "dir") == rows(graph.incident(edges, keys, True), "node", "q", "other", "dir")
    counted = graph.degree_of(edges, keys)
    assert "_words" in counted._jdf.queryExecution().optimizedPlan().toString()
    assert rows(counted, "node", "predicate", "n") == rows(graph.degree_of(edges, keys, True), "node", "predicate", "n")
    some = graph.degree(graph.incidence(edges), keys)
    assert "_words" in some._jdf.queryExecution().optimizedPlan().toString()
    assert rows(some, "node", "predicate", "n") == rows(graph.degree(graph.incidence(edges), keys, True), "node", "predicate", "n")
