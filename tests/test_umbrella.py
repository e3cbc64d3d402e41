"""Umbrella questions: hierarchy index, choice of the level, facts of all members."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from graphspark import evaluation
from graphspark.operators import hierarchy
from graphspark.operators.embed import check_same_encoder
from graphspark.plans import kg_testdata as kg
from graphspark.plans import rag, umbrella
from graphspark.sources import cases_frame

HAS = "kg:has_phenotype"


@pytest.fixture(scope="module")
def index(edges):
    return hierarchy.ancestor_index(edges, "kg:subclass_of").cache()


def test_index_has_least_steps_and_ends_on_cycles(spark, index):
    # D:1 -> D:0 -> D:2 -> D:1 is a cycle
    assert rows(index, "node", "ancestor", "up") == [
        ("D:0", "D:1", 2), ("D:0", "D:2", 1), ("D:1", "D:0", 1), ("D:1", "D:2", 2), ("D:2", "D:0", 2), ("D:2", "D:1", 1)]
    chain = spark.createDataFrame([(f"n{i + 1}", "sub", f"n{i}") for i in range(9)] + [("n5", "sub", "n0"), ("n3", "sub", "n3"),
                                   (None, "sub", "n1"), ("n2", "other", "n9")],
                                  "subject string, predicate string, object string")
    got = {(r["node"], r["ancestor"]): r["up"] for r in hierarchy.ancestor_index(chain, "sub").collect()}
    want = {(f"n{i}", f"n{j}"): i - j if i < 5 or j > 0 else 1 + i - 5 for i in range(1, 10) for j in range(i)}
    assert got == want
    assert hierarchy.ancestor_index(chain, "none").count() == 0


def test_members_and_rolled_up_degrees(spark, edges, index):
    anchors = spark.createDataFrame([("D:0",), ("P:1",), ("P:1",), (None,)], "anchor string")
    sets = hierarchy.members(index, anchors)
    assert rows(sets, "anchor", "member", "down") == [("D:0", "D:0", 0), ("D:0", "D:1", 1), ("D:0", "D:2", 2), ("P:1", "P:1", 0)]
    degrees = hierarchy.rolled_up_degree(edges, sets, spark.createDataFrame([(HAS,), (HAS,)], "predicate string"))
    assert rows(degrees, "anchor", "predicate", "n_edges", "n_direct") == [("D:0", HAS, 5, 0), ("P:1", HAS, 2, 2)]


def test_level_follows_what_the_question_names(spark):
    cands = spark.createDataFrame(
        [(1, 0, "class", 0.9), (1, 1, "member", 0.85), (2, 0, "member", 0.9), (2, 1, "class", 0.5),
         (3, 0, "nothing", 0.9), (3, 1, "class", 0.2), (3, 2, "member", 0.1), (4, 0, "nothing", 0.9)],
        "question_id long, rank long, id string, sim double")
    picked = spark.createDataFrame([(q, "p") for q in (1, 2, 3, 4)], "question_id long, predicate string")
    degrees = spark.createDataFrame([("class", "p", 50, 0), ("member", "p", 5, 5)],
                                    "anchor string, predicate string, n_edges long, n_direct long")
    got = hierarchy.choose_level(cands, picked, degrees, 0.9)
    assert rows(got, "question_id", "id", "n_edges") == [(1, "class", 50), (2, "member", 5), (3, "class", 50)]


@pytest.fixture(scope="module")
def parts(spark, nodes, edges, node_vectors):
    questions = spark.createDataFrame([(1, "about the umbrella", [1.0, 0.05]), (2, "nothing asked", [-1.0, 0.0]),
                                       (3, "about subtype two", [0.6, 0.8])],
                                      "question_id long, question string, embedding array<double>")
    predicates = spark.createDataFrame([(0, HAS, "d", [1.0, 1.0])],
                                       "pos int, predicate string, description string, embedding array<double>")
    return rag.graph_parts(questions, node_vectors, nodes, edges, predicates, cutoff=0.1, recall_k=3, prefix="kg:")


def test_facts_of_all_members_reach_the_gold(spark, parts, index, edges):
    u = umbrella.UmbrellaParts(parts, index, nearness=0.99)
    anchors = {r["question_id"]: r for r in u.anchors.collect()}
    assert (anchors[1]["anchor"], anchors[1]["widened"], anchors[1]["n_members"]) == ("D:0", True, 3)
    assert parts.hub.where("question_id = 1").first()["id"] == "D:1"  # the simple chain ends at one subtype
    got = [r[1] for r in rows(u.fact_keys.where("question_id = 1"), "question_id", "other_id")]
    assert got == ["P:1", "P:2"]
    cases = cases_frame(spark, [{"id": "c", "anchor": "D:0", "predicate": HAS, "direction": "out", "expand_subclasses": True}])
    gold = evaluation.oracle_answers(cases, edges.where("object <> 'P:9'"), "kg:subclass_of")
    found = u.fact_keys.where("question_id = 1").select(F.lit("c").alias("case_id"), F.lit("umbrella").alias("system"),
                                                       F.col("other_id").alias("entity"))
    gap = evaluation.aggregation_gap(evaluation.prf(found, gold, cases, ["graph", "umbrella"]), cases,
                                     expanded_system="umbrella").first()
    assert (gap["recall_single"], gap["recall_expanded"], gap["passes"]) == (0.0, 1.0, True)


def test_every_question_keeps_a_row(parts, index):
    out = {r["question_id"]: r for r in umbrella.graph_rag_umbrella(umbrella.UmbrellaParts(parts, index)).collect()}
    assert out[2]["status"] == "no_predicate" and out[2]["n_facts"] == 0 and out[2]["user_prompt"] is None
    assert out[1]["status"] == "ok" and out[1]["n_total"] == 4  # the far end P:9 is no known node
    lines = out[1]["user_prompt"].split("\n")
    assert lines[0] == "Facts about umbrella:"
    assert lines[1].endswith("loose joint") and " — has_phenotype — " in lines[1]
    capped = umbrella.UmbrellaParts(parts, index)
    parts.max_facts = 2
    try:
        row = {r["question_id"]: r for r in umbrella.graph_rag_umbrella(capped).collect()}[1]
        assert (row["n_facts"], row["n_total"], row["truncated"]) == (2, 4, True)
    finally:
        parts.max_facts = 40


def test_gold_belongs_to_its_question(spark):
    sf = "/root/testdata/sf0.001"
    got = kg.cases(spark, sf).where("question_id IS NOT NULL").collect()
    text = {r["id"]: r["text"] for r in kg.node_vectors(spark, sf).collect()}
    menu = dict((p, d) for p, d in kg.PREDICATE_MENU)
    assert len(got) > 150 and sum(r["expand_subclasses"] for r in got) == 150
    for r in got:
        assert r["question"] == f"{menu[r['predicate']]}: {text[r['anchor']]}"
        assert r["expand_subclasses"] == (r["anchor"].split(":")[0] in kg.CLASS_KINDS)


def test_words_of_any_script_have_vectors(spark):
    df = spark.createDataFrame([("a", "Москва столица"), ("b", "東京"), ("c", "Ünïcode"), ("d", "..."), ("e", "москва")],
                               "id string, text string")
    got = {r["id"]: r for r in kg.encoded(df, "id", "text").collect()}
    assert set(got) == {"a", "b", "c", "e"}
    shared = [x * y for x, y in zip(got["a"]["embedding"], got["e"]["embedding"])]
    assert sum(shared) >= 1 and len(got["a"]["embedding"]) == kg.VECTOR_DIM
    assert {r["encoder"] for r in got.values()} == {f"md5-hash-{kg.VECTOR_DIM}"}


def test_vectors_of_different_encoders_are_refused(spark, parts, node_vectors, nodes, edges):
    named = node_vectors.withColumn("encoder", F.lit("x"))
    other = parts.questions.withColumn("encoder", F.lit("y"))
    for left, right in ((other, named), (parts.questions, named), (other, node_vectors),
                        (other, named.withColumn("encoder", F.lit(None).cast("string")))):
        with pytest.raises(ValueError):
            check_same_encoder(left, right)
        with pytest.raises(ValueError):
            rag.vector_rag(left, right)
    with pytest.raises(ValueError):
        rag.graph_rag(other, named.withColumn("encoder", F.lit("y")), nodes, edges, parts.predicates, cutoff=0.1)
    check_same_encoder(other, named.withColumn("encoder", F.lit("y")), other.limit(0))
