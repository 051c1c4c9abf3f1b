"""Loading the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as it lies: its splits are the scan's. Which side of a join is broadcast is left to
    the planner and, at run time, to AQE (``spark.sql.autoBroadcastJoinThreshold``)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt to every core if a scan has fewer splits than there are cores (a few small files, whose row
    groups a scan can't split); a table of many files stays as it lies. For chains with much work per row."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
