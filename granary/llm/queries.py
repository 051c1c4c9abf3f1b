"""Queries of this subpackage: name -> (spark, sf_dir) -> DataFrame, with SQL where it can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.llm import (
    bpe_chunks, bpe_tree, conversation_repair, decontaminate, language_id, licenses, line_rules, periodic_runs, quality_net, simhash, style_tree,
    suffix_dedup, url_filter,
)
from granary.llm.common import pick, share, table

VOCABULARY = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"


def vocabulary_path(name: str = VOCABULARY) -> str:
    """Where the public tokenizers package keeps a file; the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = simhash.components(table(spark, sf_dir, "documents"))
    return got.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = pick(table(spark, sf_dir, "documents"), "doc_id", "text")
    model = quality_net.fit(docs, table(spark, sf_dir, "labels"), learn_from=lambda c: share(c, 5, (1, 2, 3, 4)))
    got = docs.select("doc_id", share(F.col("doc_id"), 5, (0,)).alias("held_out"), quality_net.score_column(F.col("text"), model).alias("score"))
    return got.withColumn("predicted", (F.col("score") >= quality_net.THRESHOLD).cast("int"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = pick(table(spark, sf_dir, "documents"), "doc_id", "text", "lang")
    model = language_id.fit(docs.filter(share(F.col("doc_id"), 3, (0, 2))))
    got = language_id.identify(docs, model)
    return got.select("doc_id", share(F.col("doc_id"), 3, (1,)).alias("held_out"), "lang_pred", "score")


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = suffix_dedup.removed(pick(table(spark, sf_dir, "documents"), "doc_id", "text"))
    return got.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


def op6_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = pick(table(spark, sf_dir, "documents"), "doc_id", "text")
    field = line_rules.fit(docs, table(spark, sf_dir, "labels"), learn_from=lambda c: share(c, 5, (1, 2, 3, 4)))
    return line_rules.judge(docs, field)


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return got.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        decontaminate.items_digest(F.col("items")).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = style_tree.extract(table(spark, sf_dir, "pages"))
    return got.withColumn("n_chars", F.length("text").cast("long"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_chunks.encode_texts(table(spark, sf_dir, "documents"), vocabulary_path(), with_ids=False)


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    return bpe_tree.encode_texts(docs, vocabulary_path(RANKS), public_tokenizers.PATTERN, with_ids=False)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversation_repair.damaged(table(spark, sf_dir, "conversations"))
    return conversation_repair.repair(rows, copies_col="copies", with_text=False)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return periodic_runs.find_runs(docs, change=periodic_runs.planted, with_runs=False).drop("n_words")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_license_scan, op2_simhash, op3_quality, op4_language, op5_suffix_dedup, op6_line_rules, op7_url_filter,
        op8_decontaminate, op9_main_text, op10_bpe, op11_byte_bpe, op12_conversation_repair,
        op13_periodic_runs,
    )
}

ORACLE: dict[str, str] = {}
