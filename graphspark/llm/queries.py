"""One thin query for each operator, over its whole table, and SQL where it can express the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from graphspark.llm import (compression_quality, exact_packing, fim_capture, host_reputation, language_mixture,
                            license_rules, line_dedup, parity_join, pivotal_mix, prefix_trie, quality_rules, warc, winnowing)
from graphspark.llm.common import in_fold, table


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id")
    return rows.select("doc_id", "_verdict.*")


def fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.compare_edited(table(spark, sf_dir, "documents"))


def near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parity_join.join(table(spark, sf_dir, "documents"))[0]


def mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pivotal_mix.copies(table(spark, sf_dir, "documents"), "doc_id", "source")
    return rows.select("doc_id", F.col("_size").alias("size"), F.col("_size_sum").alias("source_size"),
                       F.col("_target").alias("target"), (F.col("_copies") * F.col("_size")).alias("taken"), "source",
                       F.col("_copies").alias("copies"))


def urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = host_reputation.judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))
    return rows.withColumns({c: F.round(c, 6) for c in ("bad_mean", "bad_bound")})  # sums of doubles have no fixed order


def packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), "doc_id")


def tokenizer_path() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = language_mixture.identify(table(spark, sf_dir, "documents"), "doc_id")
    return rows.select("doc_id", in_fold(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "langs")


def licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_rules.scan(table(spark, sf_dir, "documents"))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_dedup.cleaned(table(spark, sf_dir, "documents"))
    return rows.select("_row.doc_id", F.size("_gone").alias("n_removed"), F.col("_gone").alias("removed_lines"),
                       F.char_length("_text").alias("kept_chars"), F.sha2("_text", 256).alias("kept_sha256"))


def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = compression_quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id")
    return rows.select("doc_id", in_fold(F.col("doc_id")).alias("held_out"), "score", "predicted", "size_difference")


def fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fim_capture.transform(table(spark, sf_dir, "documents"), "doc_id").select("doc_id", "_fim.*")
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(fim_capture.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


def archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


QUERIES = {"op1_quality_rules": quality, "op2_winnowing": fingerprints, "op3_parity_join": near_copies, "op4_pivotal_mix": mix,
           "op5_host_reputation": urls, "op6_exact_packing": packing, "op7_language_mixture": languages,
           "op8_license_rules": licenses, "op9_line_dedup": lines,
           "op10_compression_quality": quality_scores, "op11_fim_capture": fill_in_middle, "op12_prefix_trie": conversation_trie,
           "op13_warc": archives}

ORACLE_SQL: dict[str, str] = {"op5_host_reputation": host_reputation.ORACLE_SQL, "op11_fim_capture": fim_capture.ORACLE_SQL, 
                              "op12_prefix_trie": prefix_trie.ORACLE_SQL, "op13_warc": warc.ORACLE_SQL}
