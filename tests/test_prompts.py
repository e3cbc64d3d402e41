from conftest import rows

from graphspark.functions import display_name
from graphspark.operators import prompts


def test_display_name(spark):
    df = spark.createDataFrame([("umbrella. [U, umb]. top node",), ('subtype two. has "odd quote',),
                                ("  x.. [y]",)], "text string")
    got = [r[0] for r in df.select(display_name("text")).collect()]
    assert got == ["umbrella", 'subtype two. has "odd quote', "x"]


def test_cap_and_lines_and_prompt(spark):
    facts = spark.createDataFrame(
        [(1, f"P:{i}", "out" if i % 2 else "in", f"name {i}. [s]") for i in range(5)],
        "question_id long, other_id string, dir string, text string")
    capped = prompts.cap_facts(facts, 3)
    got = rows(capped, "rn", "other_id", "dir", "truncated")
    assert got == [(0, "P:0", "in", True), (1, "P:2", "in", True), (2, "P:4", "in", True)]
    anchors = spark.createDataFrame([(1, "hub", "kg:has_phenotype")],
                                    "question_id long, anchor_name string, predicate string")
    lines = prompts.fact_lines(capped, anchors, prefix="kg:")
    assert rows(lines, "line")[0] == ("name 0 — has_phenotype — hub",)
    qs = spark.createDataFrame([(1, "what?"), (2, "none?")], "question_id long, question string")
    ask = prompts.graph_prompt(qs, anchors.select("question_id", "anchor_name"), lines)
    text = ask.collect()[0]["user_prompt"]
    assert text.startswith("Facts about hub:\nname 0 — has_phenotype — hub\n")
    assert text.endswith("\n\nQuestion: what?")
    ans = prompts.generate(ask).collect()[0]["answer"]
    assert ans == "name 0 — has_phenotype — hub"


def test_text_prompt_and_generation_seam(spark):
    qs = spark.createDataFrame([(1, "q1"), (2, "q2")], "question_id long, question string")
    hits = spark.createDataFrame([(1, 1, "B", "bee"), (1, 0, "A", "ay")],
                                 "question_id long, rank long, id string, text string")
    ask = prompts.text_prompt(qs, hits)
    got = dict(rows(ask, "question_id", "user_prompt"))
    assert got[1] == "Context:\n[A] ay\n[B] bee\n\nQuestion: q1"
    assert got[2] == "Context:\n\n\nQuestion: q2"

    def factory():
        return lambda systems, users: [u.upper()[:3] for u in users]
    out = dict(rows(prompts.generate(ask, factory, system="s"), "question_id", "answer"))
    assert out == {1: "CON", 2: "CON"}
    stub = dict(rows(prompts.generate(ask), "question_id", "answer"))
    assert stub == {1: "[A] ay", 2: prompts.NO_ANSWER}
