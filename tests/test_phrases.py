"""Phrases in texts, the keyword classifier, and groundedness of answers."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from graphspark.functions import display_name
from graphspark.operators import classify, grounding, phrases, prompts
from graphspark.operators.graph import texts


def test_longest_match_from_the_left(spark):
    index = phrases.phrase_index(spark.createDataFrame(
        [("new york", 1), ("New-York city", 2), ("york", 3), ("city hall", 4), ("hall", 5), ("hall", 6), ("...", 7),
         (None, 8), ("москва", 9), ("x", None)], "p string, i int"), "p", "i")
    assert rows(index.where("id IN (1, 2, 7, 8)"), "phrase", "n_words", "id") == [("new york", 2, 1), ("new york city", 3, 2)]
    docs = spark.createDataFrame([(1, "In new york city hall"), (2, "YORK, city hall; new york!"), (3, ""), (4, None),
                                  (5, "в Москва hall hall")], "k int, t string")
    got = phrases.longest(phrases.matches(docs, "t", index, "k"), "k")
    assert rows(got, "k", "start", "phrase") == [
        (1, 2, "new york city"), (1, 5, "hall"), (2, 1, "york"), (2, 2, "city hall"), (2, 4, "new york"),
        (5, 2, "москва"), (5, 3, "hall"), (5, 4, "hall")]
    assert phrases.longest(phrases.matches(docs, "t", index.limit(0), "k"), "k").count() == 0


def test_longest_equals_a_plain_scan(spark):
    import random
    rng = random.Random(2)
    known = {" ".join(rng.choice("abc") for _ in range(rng.randint(1, 4))) for _ in range(25)}
    lines = [" ".join(rng.choice("abcd") for _ in range(rng.randint(0, 25))) for _ in range(60)]
    want = []
    for k, line in enumerate(lines):
        w, at = line.split(), 0
        while at < len(w):
            n = next((n for n in range(4, 0, -1) if at + n <= len(w) and " ".join(w[at:at + n]) in known), 0)
            if n:
                want.append((k, at + 1, n))
            at += n or 1
    index = phrases.phrase_index(spark.createDataFrame([(p, p) for p in known], "p string, i string"), "p", "i")
    found = phrases.matches(spark.createDataFrame(list(enumerate(lines)), "k int, t string"), "t", index, "k")
    assert rows(phrases.longest(found, "k"), "k", "start", "n_words") == sorted(want)


@pytest.fixture(scope="module")
def triggers(spark):
    return spark.createDataFrame([(0, "has", "symptoms of"), (0, "has", "sign"), (1, "gene", "gene"), (2, "cause", "gene"),
                                  (2, "cause", "gene that causes")], "pos int, predicate string, phrase string")


def test_keyword_classifier_ranks_like_the_vector_one(spark, triggers):
    questions = spark.createDataFrame([(1, "Symptoms of the gene?"), (2, "Which gene that causes it"), (3, "nothing here"),
                                       (4, None)], "question_id long, question string")
    got = {}
    for r in classify.keyword_predicates(questions, triggers).orderBy("question_id", "rank").collect():
        got.setdefault(r["question_id"], []).append((r["predicate"], r["score"]))
    assert got[1] == [("has", 0.666667), ("gene", 0.333333), ("cause", 0.333333)]
    assert got[2] == [("cause", 1.0), ("has", 0.0), ("gene", 0.0)]
    assert got[3] == got[4] == [("has", 0.0), ("gene", 0.0), ("cause", 0.0)]


def test_agreement_of_two_classifiers(spark):
    schema = "question_id long, rank long, predicate string, score double"
    a = spark.createDataFrame([(1, 0, "x", .9), (1, 1, "y", .5), (2, 0, "x", .1), (3, 0, "x", .9)], schema)
    b = spark.createDataFrame([(1, 0, "y", .9), (1, 1, "x", .5), (2, 0, "x", .9), (3, 0, "x", .9)], schema)
    got = rows(classify.agreement(a, b, 0.4, 0.4), "question_id", "top_first", "top_second", "same_top", "n_first", "n_second", "n_both")
    assert got == [(1, "x", "y", False, 2, 2, 2), (2, None, "x", False, 0, 1, 0), (3, "x", "x", True, 1, 1, 1)]


@pytest.fixture(scope="module")
def known(nodes):
    return phrases.phrase_index(texts(nodes).select("id", display_name("text").alias("n")), "n", "id")


@pytest.fixture(scope="module")
def relations(spark):
    return phrases.phrase_index(spark.createDataFrame(
        [("kg:has_phenotype", "has_phenotype"), ("kg:causes", "causes")], "p string, n string"), "n", "p")


ANSWERS = [
    (1, "subtype one — has_phenotype — loose joint\nsubtype one — has_phenotype — soft skin"),
    (2, "subtype one — causes — loose joint"),                      # wrong predicate
    (3, "It has a loose joint. Soft skin too! Gene one as well."),  # anchor is implied; the third fact isn't given
    (4, "Loose joint and gene one."),                               # one of two nodes is not backed
    (5, prompts.NO_ANSWER), (6, None), (7, ""), (8, "Nothing that is known. Subtype one."),
    (9, "subtype one, loose joint, soft skin"),
]


def _context(spark):
    answers = spark.createDataFrame(ANSWERS, "question_id long, answer string")
    facts = spark.createDataFrame([(q, "D:1", "kg:has_phenotype", o) for q, _ in ANSWERS for o in ("P:1", "P:2", "P:1")],
                                  "question_id long, subject string, predicate string, object string")
    return answers, facts, spark.createDataFrame([(q, "D:1") for q, _ in ANSWERS], "question_id long, anchor string")


def test_claims_are_lines_or_sentences(spark):
    df = spark.createDataFrame([(1, "a. b — c. d — e\n\n  One. Two!  Three"), (2, None), (3, prompts.NO_ANSWER)], "k int, answer string")
    assert rows(grounding.claims(df, "k"), "k", "claim_no", "claim") == [
        (1, 0, "a. b — c. d — e"), (1, 1, "One."), (1, 2, "Two!"), (1, 3, "Three")]


def test_groundedness_per_answer(spark, known, relations):
    out = grounding.groundedness(*_context(spark), known, relations, "question_id")
    got = {r["question_id"]: (r["n_claims"], r["n_supported"], r["score"]) for r in out.collect()}
    assert got == {1: (2, 2, 1.0), 2: (1, 0, 0.0), 3: (3, 2, 0.666667), 4: (1, 0, 0.0), 5: (0, 0, None), 6: (0, 0, None),
                   7: (0, 0, None), 8: (2, 0, 0.0), 9: (1, 1, 1.0)}


def test_any_node_of_a_shared_name_will_do(spark, nodes, relations):
    twins = nodes.unionByName(nodes.where("id = 'P:1'").withColumn("id", F.lit("P:1b")))
    index = phrases.phrase_index(texts(twins).select("id", display_name("text").alias("n")), "n", "id")
    out = grounding.groundedness(*_context(spark), index, relations, "question_id")
    assert out.where("question_id = 1").first()["n_supported"] == 2


def test_grams_are_filtered_before_they_meet_many_phrases(spark, monkeypatch):
    texts = spark.createDataFrame([(1, "Loose joint and soft skin, soft"), (2, None), (3, "nothing")], "k int, t string")
    index = phrases.phrase_index(spark.createDataFrame([("loose joint", "a"), ("soft", "b"), ("Soft", "c"), ("skin", "d")], "p string, i string"), "p", "i")
    want = sorted(map(tuple, phrases.matches(texts, "t", index, "k").collect()))
    monkeypatch.setattr(phrases, "MAX_BROADCAST_PHRASES", 0)
    found = phrases.matches(texts, "t", index, "k")
    assert "_words" in found._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, found.collect())) == want and len(want) == 4
