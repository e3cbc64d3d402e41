import importlib.util
import pathlib

import pytest

ROOT = pathlib.Path(__file__).resolve().parent.parent


@pytest.fixture(scope="module")
def entry_mod():
    spec = importlib.util.spec_from_file_location("spark_entry", ROOT / "__spark_entry__.py")
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_every_query_has_an_oracle(entry_mod):
    qs, orc = entry_mod.queries(), entry_mod.oracle_sql()
    from graphspark.plans import catalog
    assert set(orc) <= set(qs)
    # of the corpus queries some can't be said in SQL; their own tests hold them against brute force
    assert set(catalog.queries()) <= set(orc)
    assert len(qs) >= 30


def test_entry_runs_on_smoke_data(spark, entry_mod):
    df = entry_mod.entry(spark)
    out = df.collect()
    assert len(out) > 0
    assert {"question_id", "status", "user_prompt"} <= set(df.columns)
    assert {r["status"] for r in out} <= {"ok", "no_anchor", "no_predicate"}
