"""Synthetic gold, the hybrid prompt, and seeds matched as substrings."""

import random

import pytest
from conftest import rows

from graphspark import evaluation
from graphspark.operators import subgraph
from graphspark.plans import hybrid, rag

EDGE = "subject string, predicate string, object string"


@pytest.fixture(scope="module")
def graph(spark):
    rng = random.Random(3)
    edges = [(f"a{int(rng.paretovariate(0.6)) % 60}", rng.choice(["p", "q", "unasked"]), f"b{rng.randint(0, 40)}") for _ in range(900)]
    edges += [("a1", "p", "a1"), (None, "p", "b1"), ("a1", "p", None), ("ghost", "p", "b1")]
    nodes = [(f"{k}{i}", f"name of {k}{i} [syn]") for k in "ab" for i in range(61)] + [("a2x", "[only]")]
    templates = [("p", "who is p"), ("q", "who is q")]
    return (edges, spark.createDataFrame(edges, EDGE), spark.createDataFrame(nodes, "id string, text string"),
            spark.createDataFrame(templates, "predicate string, description string"))


COLS = ("id", "question", "anchor", "predicate", "direction", "target", "degree", "bucket")


def test_synthetic_gold_is_the_same_on_any_partitioning(graph):
    _, edges, nodes, templates = graph
    want = rows(evaluation.synthetic_gold(edges, nodes, templates, per_stratum=3), *COLS)
    assert rows(evaluation.synthetic_gold(edges.repartition(7), nodes.repartition(3), templates, per_stratum=3), *COLS) == want
    more = rows(evaluation.synthetic_gold(edges, nodes, templates, per_stratum=5), *COLS)
    assert set(want) < set(more)
    other = rows(evaluation.synthetic_gold(edges, nodes, templates, per_stratum=3, seed=1), *COLS)
    assert set(other) != set(want) and len({r[0] for r in want}) == len(want)
    assert evaluation.synthetic_gold(edges.limit(0), nodes, templates, per_stratum=3).count() == 0


def test_synthetic_strata_are_degree_quantiles(graph):
    plain, edges, nodes, templates = graph
    got = evaluation.synthetic_gold(edges, nodes, templates, per_stratum=10**6, buckets=3).collect()
    far = {}
    for s, p, o in plain:
        if p != "unasked" and s and o and s != o:
            far.setdefault((s, p, "out"), set()).add(o)
            far.setdefault((o, p, "in"), set()).add(s)
    far.pop(("ghost", "p", "out"))
    assert {(r["anchor"], r["predicate"], r["direction"]) for r in got} == set(far)
    for r in got:
        mine = far[r["anchor"], r["predicate"], r["direction"]]
        alike = [len(v) for k, v in far.items() if k[1:] == (r["predicate"], r["direction"])]
        assert r["degree"] == len(mine) and r["target"] in mine
        assert r["bucket"] == sum(d < len(mine) for d in alike) * 3 // len(alike)
        assert r["question"] == f"who is {r['predicate']}: name of {r['anchor']}"


def test_oracle_answers_hold_the_synthetic_target(graph):
    _, edges, nodes, templates = graph
    cases = evaluation.synthetic_gold(edges, nodes, templates, per_stratum=4).cache()
    answers = set(rows(evaluation.oracle_answers(cases, edges, "none"), "case_id", "entity"))
    assert cases.count() > 20 and all((r["id"], r["target"]) in answers for r in cases.collect())


@pytest.fixture(scope="module")
def parts(spark, nodes, edges, node_vectors):
    questions = spark.createDataFrame([(1, "what has subtype one", [0.8, 0.6]), (2, "nothing", [-1.0, 0.0])],
                                      "question_id long, question string, embedding array<double>")
    predicates = spark.createDataFrame([(0, "kg:has_phenotype", "d", [1.0, 1.0])],
                                       "pos int, predicate string, description string, embedding array<double>")
    return rag.graph_parts(questions, node_vectors, nodes, edges, predicates, cutoff=0.1, recall_k=4, prefix="kg:")


def test_hybrid_prompt_fuses_both_channels(parts):
    out = {r["question_id"]: r for r in hybrid.hybrid_rag(parts, k=3).collect()}
    one = out[1]
    assert (one["n_text"], one["n_facts"], one["n_dropped"], one["n_both"]) == (3, 3, 0, 1)
    context, facts = one["user_prompt"].split("\n\nFacts about subtype one:\n")
    assert context.startswith("Context:\n[") and facts.split("\n")[0] == "subtype one — has_phenotype — loose joint"
    assert context.split("\n")[1].startswith("[P:1]")  # P:1 is a hit and a fact, so it comes first
    assert out[2]["n_facts"] == 0 and "Facts about" not in out[2]["user_prompt"]
    assert out[1]["answer"].startswith("[P:1]")


def test_hybrid_budget_cuts_and_reports(parts):
    whole = hybrid.hybrid_rag(parts, k=3).where("question_id = 1").first()
    for budget in (0, 30, 80, 140, 10_000):
        r = hybrid.hybrid_rag(parts, k=3, budget=budget).where("question_id = 1").first()
        lines = [x for x in r["user_prompt"].split("\n") if x.startswith("[") or " — " in x]
        assert sum(len(x) + 1 for x in lines) <= budget and len(lines) == r["n_text"] + r["n_facts"]
        assert len(lines) + r["n_dropped"] == whole["n_text"] + whole["n_facts"]


ROWS = [("part:1", "p", "x"), ("part:10", "p", "y"), ("z", "p", "see part:10, or"), (None, "p", "PART:1"), ("é", "naïve", "日本語"),
        ("b", "part", ":1"), ("part:1", "p", "x"), (None, None, None)]


@pytest.mark.parametrize("bound", [100, 0])
@pytest.mark.parametrize("seeds", [["part:1"], ["part:10", "part:1", "x"], ["ïv", "本"], ["\tp\t"], ["nowhere"], [], ["part:1", None],
                                   ["part:10, or some", "p", "b"], [""]])
def test_substring_seeds_equal_contains(spark, seeds, bound):
    edges = spark.createDataFrame(ROWS, EDGE)
    got = subgraph.extract_substring(edges, spark.createDataFrame([(s,) for s in seeds], "id string"), "id", bound)
    want = [r for r in ROWS if any(s is not None and s in "\t".join(x or "" for x in r) for s in seeds)]
    assert sorted(map(repr, (tuple(r) for r in got.collect()))) == sorted(map(repr, want))


def test_many_substring_seeds_on_both_ways(spark):
    rng = random.Random(8)
    table = [(f"MONDO:{rng.randint(0, 400):07d}", "p", f"HP:{rng.randint(0, 400):07d}") for _ in range(300)]
    seeds = spark.createDataFrame([(f"MONDO:{n:07d}",) for n in range(0, 400, 7)] + [("0003",)], "id string")
    edges = spark.createDataFrame(table, EDGE)
    one, other = (subgraph.extract_edges(edges, seeds, "substring", max_broadcast_seeds=n) for n in (1000, 5))
    assert rows(one, "subject", "object") == rows(other, "subject", "object")
    assert 0 < one.count() < len(table)


def test_substring_seeds_stay_within_their_row(spark):
    """Rows of a batch are searched as one text: no match may go across two of them, and the first and last row count."""
    rows = spark.createDataFrame([(n, t) for n, t in enumerate(["xab", "cab", "c", "", "bca", "é\u0000ab", None, "ab"])],
                                 "n int, t string").coalesce(1)
    edges = rows.select("t")
    seeds = spark.createDataFrame([("ca",), ("é\u0000a",), ("abc",)], "id string")
    assert sorted(r["t"] for r in subgraph.extract_substring(edges, seeds).collect()) == ["bca", "cab", "é\u0000ab"]
