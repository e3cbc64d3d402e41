"""From raw documents to packed training sequences, in five stages.

Each stage takes what its predecessor kept. A stage's result is written as Parquet in the shared checkpoint folder
and read again, so that a lost executor costs tasks of one stage only.

Null, empty and blank texts and those of fewer than ten words are rejected by the first stage; were they in a later one's
input, line dedup and the join would keep them as they are, the mix takes no rows without words, and packing makes a
sequence entry of one token of them. Texts of any length go through whole. Of equal rows and near copies one stays (the
smallest doc_id). A null doc_id is judged like any other row. Other columns, whatever their names, come through the first
four stages unchanged. Empty tables give empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from graphspark.llm import exact_packing, line_dedup, parity_join, pivotal_mix, quality_rules
from graphspark.llm.common import table
from graphspark.llm.queries import tokenizer_path
from graphspark.session import materialize


#: Near copies share this percentage of their shingles of so many words; op3's own query keeps its 4 words and 85.
NEAR_SHINGLE = 5
NEAR_PERCENT = 80
#: Narrower size bands than op3's own: at 80 percent blocks are smaller and would more often be equal by chance.
NEAR_BAND_RATIO = 1.2


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.kept(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the runs of lines that stand in an earlier place; no document goes."""
    return line_dedup.dedup(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return parity_join.one_of_each(docs, NEAR_PERCENT, NEAR_SHINGLE, NEAR_BAND_RATIO)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return pivotal_mix.mix(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return exact_packing.pack(docs, tokenizer_path(), "doc_id")


STAGES = [("quality_rules", quality), ("line_dedup", lines), ("ngram_join", near_copies), ("mix", mix),
          ("packing", packing)]

#: The forest, the rounding and the packing can't be said in SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
    return docs
