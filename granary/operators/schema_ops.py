"""Schema-level operators: diff of two schemas, dataset registration."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.operators.records import parse_envelope


def schema_frame(spark: SparkSession, df: DataFrame) -> DataFrame:
    """(column_name, position) of a DataFrame's schema (1-based)."""
    rows = [(f.name, i + 1, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "column_name string, position int, data_type string")


def schema_diff(spark: SparkSession, left: DataFrame, right: DataFrame) -> DataFrame:
    """Left-only / right-only / shared columns with their positions.

    Schemas are metadata, so both sides have one row per column.
    """
    a = schema_frame(spark, left).select("column_name", F.col("position").alias("left_position"))
    b = schema_frame(spark, right).select("column_name", F.col("position").alias("right_position"))
    j = a.join(b, "column_name", "full_outer")
    return j.select(
        "column_name", "left_position", "right_position",
        F.when(F.col("left_position").isNull(), "right_only")
        .when(F.col("right_position").isNull(), "left_only")
        .otherwise("both").alias("presence"),
    )


def schema_summary(diff: DataFrame) -> DataFrame:
    """Counts per presence class and whether the shared columns keep order."""
    shared = F.col("presence") == "both"
    return diff.agg(
        F.count_if(F.col("presence") == "left_only").alias("left_only"),
        F.count_if(F.col("presence") == "right_only").alias("right_only"),
        F.count_if(shared).alias("shared"),
        F.bool_and(F.when(shared, F.col("left_position") == F.col("right_position")).otherwise(True)).alias("same_order"),
    )


def dataset_register(registry: DataFrame, pages: DataFrame) -> DataFrame:
    """Insert-if-absent of one dataset row per resource seen in the pages
    (name from the envelope title, default "Unknown Dataset"); the first page
    (offset, attempt) decides the name."""
    p = parse_envelope(pages)
    cand = p.select(
        F.col("resource_id").alias("dataset_id"),
        F.coalesce(F.col("env.title"), F.lit("Unknown Dataset")).alias("dataset_name"),
        "resource_id",
        F.col("source_system").alias("source_name"),
        F.struct(F.col("env.title").isNull(), "offset", "attempt").alias("seq"),
    )
    first = cand.groupBy("dataset_id").agg(
        F.min_by(F.struct("dataset_name", "resource_id", "source_name"), "seq").alias("w")
    ).select("dataset_id", "w.dataset_name", "w.resource_id", "w.source_name")
    new = first.join(registry.select("dataset_id"), "dataset_id", "left_anti")
    return registry.unionByName(new)
