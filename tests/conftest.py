"""Shared fixtures: one local session and the tiny graph of FIXTURES.md §2."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from graphspark.session import get_session  # noqa: E402

SF_SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", 4, app_name="graphspark-tests",
                    extra_conf={"spark.driver.memory": "4g"})
    yield s
    s.stop()


NODE_ROWS = [
    # id, category, name, synonym, description, embedding
    ("D:0", "kg:Disease", "umbrella", "[U, umb]", "top node", [1.0, 0.0]),
    ("D:1", "kg:Disease", "subtype one", "[S1]", None, [0.8, 0.6]),
    ("D:2", "kg:Disease", "subtype two", None, 'has "odd quote', [0.6, 0.8]),
    ("P:1", "kg:Phenotype", "loose joint", None, None, [0.8, 0.6]),
    ("P:2", "kg:Phenotype", "soft skin", "[skin]", None, [0.0, 1.0]),
    ("G:1", "kg:Gene", "gene one", None, None, [-1.0, 0.0]),
    ("Z:0", "kg:Other", "zero vector", None, None, [0.0, 0.0]),
]

EDGE_ROWS = [
    # id, subject, predicate, object, negated
    ("e1", "D:1", "kg:subclass_of", "D:0", None),
    ("e2", "D:2", "kg:subclass_of", "D:1", None),
    ("e3", "D:0", "kg:subclass_of", "D:2", None),
    ("e4", "D:1", "kg:has_phenotype", "P:1", None),
    ("e5", "D:1", "kg:has_phenotype", "P:1", None),
    ("e6", "D:1", "kg:has_phenotype", "P:2", None),
    ("e7", "D:2", "kg:has_phenotype", "P:9", None),
    ("e8", "G:1", "kg:causes", "D:1", None),
    ("e9", "P:2", "kg:related_to", "P:2", None),
    ("e10", "D:2", "kg:has_phenotype", "P:2", "true"),
]


@pytest.fixture(scope="session")
def nodes(spark):
    return spark.createDataFrame(
        NODE_ROWS, "id string, category string, name string, synonym string, "
                   "description string, embedding array<float>")


@pytest.fixture(scope="session")
def edges(spark):
    return spark.createDataFrame(
        EDGE_ROWS, "id string, subject string, predicate string, object string, negated string")


@pytest.fixture(scope="session")
def node_vectors(nodes):
    from graphspark.functions import node_text
    return nodes.select("id", "category", node_text().alias("text"), "embedding")


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
