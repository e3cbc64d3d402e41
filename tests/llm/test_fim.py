"""Operator 11: fill-in-middle cuts against a plain walk over the units."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from graphspark.llm import fim_capture, queries

from .conftest import CLASH, ROWS, SF

UNIT = re.compile("[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+")


def brute(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    digits = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digits[8 * k:8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if text == "" or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return len(units), "plain", None, None, text
    if h[3] % 100 < 80:
        return len(units), "spm", len(p), len(m), "<S>" + s + "<P>" + p + "<M>" + m
    return len(units), "psm", len(p), len(m), "<P>" + p + "<S>" + s + "<M>" + m


HARD = ["", " ", "a", " a ", "\n\n", "a\x1cb c", "<", "<S", "P> x <", "<<P", "a <P> b", "x<S>", "<M>", "é ü z 😀 q\t",
        "S> < P> <M M>"]


def test_ends_are_those_of_the_units(monkeypatch):
    for text in HARD + [t for _, t, _, _ in ROWS if t]:
        ends = [m.end() for m in UNIT.finditer(text)]
        assert fim_capture.unit_ends(text).tolist() == ends
    text = " ab" * 30 + " \n"
    ends = fim_capture.unit_ends(text).tolist()
    monkeypatch.setattr(fim_capture, "BLOCK_CHARS", 10)
    monkeypatch.setattr(fim_capture, "_BLOCK", fim_capture.regex.compile(f"{fim_capture._UNIT}{{1,7}}"))
    assert fim_capture.unit_ends(text).tolist() == ends == [m.end() for m in UNIT.finditer(text)]


def test_a_text_of_many_units_is_matched_in_blocks():
    n = 2_500_000
    ends = fim_capture.unit_ends("ab " * n)
    assert len(ends) == n + 1 and ends[0] == 2 and ends[-1] == 3 * n and (ends[1:-1] - ends[:-2] == 3).all()


def test_cuts_equal_brute_force_and_outputs_read_back(spark, docs, no_docs):
    rows = [(i, t) for i in range(40) for t in HARD] + [(None, "a b c"), (None, None)]
    made = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, _fim string")
    for df in (docs, made):
        out = (fim_capture.transform(df, "doc_id", "text").select("doc_id", "text", "_fim.*")
               .withColumn("back", fim_capture.restored(F.col("output"), F.col("form"))).collect())
        assert len(out) == df.count()
        for r in out:
            assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == brute(r["doc_id"], r["text"])
            assert r["back"] == (r["text"] or "")
    assert {r["form"] for r in out} == {"plain", "psm", "spm"}
    assert fim_capture.transform(no_docs, "doc_id", *CLASH).count() == 0


def test_rates_are_parameters(docs):
    never = fim_capture.transform(docs, "doc_id", fim_percent=0).select("_fim.form").distinct().collect()
    assert [r[0] for r in never] == ["plain"]
    psm = fim_capture.transform(docs, "text", fim_percent=100, spm_percent=0).select("text", "_fim.form").collect()
    assert all(r["form"] == ("psm" if r["text"] else "plain") for r in psm)


def test_query_equals_brute_force(spark, real):
    out = {r["doc_id"]: r for r in queries.fill_in_middle(spark, SF).collect()}
    texts = {r["doc_id"]: r["text"] for r in real["documents"].collect()}
    assert out.keys() == texts.keys()
    for doc_id, text in texts.items():
        n, form, prefix, middle, output = brute(doc_id, text)
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (output, text or "")]
        r = out[doc_id]
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"]) == (n, form, prefix, middle)
        assert [r["output_sha256"], r["restored_sha256"]] == sha


@pytest.mark.parametrize("name", ["op11_fim_capture"])
def test_registered_with_sql(name):
    assert name in queries.QUERIES and name in queries.ORACLE_SQL
