"""Training-data pipeline over ``documents``: each stage calls one operator of ``granary.llm``.

Stages take (spark, docs, sf_dir) and return a DataFrame, which is written as Parquet and read again as
the next stage's documents. Null and empty texts pass through as the operators say; repeated rows are
copies of each other and the near-duplicate stage keeps one. All stages but the last return the columns
of ``documents``; the last returns the kept documents' token ids and their digests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.llm import bpe_chunks, decontaminate, quality_net, simhash, suffix_dedup
from granary.llm.common import packed, share, small_batches, table, unpacked
from granary.llm.queries import vocabulary_path
from granary.session import scratch_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject."""
    model = quality_net.fit(docs, table(spark, sf_dir, "labels"), learn_from=lambda c: share(c, 5, (1, 2, 3, 4)))
    rows = packed(docs, "text").withColumn("score", quality_net.score_column(F.col("text"), model))
    return unpacked(rows.filter(F.col("score") >= quality_net.THRESHOLD), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    small_batches(spark)
    return simhash.keep_one(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that are found elsewhere too."""
    small_batches(spark)
    return suffix_dedup.remove_repeats(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of test items."""
    return decontaminate.remove_contamination(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the documents."""
    small_batches(spark)
    return bpe_chunks.encode_texts(docs, vocabulary_path())


STAGES = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_duplicates),
    ("suffix-array dedup", repeats),
    ("benchmark decontamination", benchmark),
    ("BPE encoding and decoding", tokens),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
