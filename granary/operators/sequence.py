"""Successor of each row within a key, ordered - safe for hot keys.

A plain ``lead() over (partition by key order by ...)`` puts every row of a
key into one task; with one key holding a third of the data that task never
finishes. Here rows are first range-partitioned on (key, order...), which
splits a hot key across many partitions; ``lead`` then runs per
(key, partition) and the missing successor of each partition's last row is
taken from a small per-(key, partition) summary (one row each).

Range bounds are sampled anew each time a ranged frame is computed, so the
rows and their partition numbers are written once (a reliable checkpoint) and
both branches read that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from granary.session import shared_dir


def successor_pairs(df: DataFrame, key: str, order: list[str], payload: list[str],
                    num_partitions: int | None = None) -> DataFrame:
    """Rows (key, prev struct, next struct) for consecutive rows of each key.

    ``prev``/``next`` hold ``order + payload`` columns. Every consecutive pair
    is produced exactly once; the first row of a key has no predecessor.
    """
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cols = order + [c for c in payload if c not in order]
    row = F.struct(*[F.col(c) for c in cols])
    ranged = df.repartitionByRange(n, key, *order).select(key, row.alias("r"), F.spark_partition_id().alias("_pid"))
    shared_dir(df.sparkSession)
    ranged = ranged.checkpoint()
    w = Window.partitionBy(key, "_pid").orderBy(*[F.col("r." + c) for c in order])
    inner = ranged.select(key, F.col("r").alias("prev"), F.lead("r").over(w).alias("next")).where(F.col("next").isNotNull())
    ord_struct = F.struct(*[F.col("r." + c) for c in order])
    ends = ranged.groupBy(key, "_pid").agg(
        F.min_by("r", ord_struct).alias("first"),
        F.max_by("r", ord_struct).alias("last"),
    )
    w2 = Window.partitionBy(key).orderBy("_pid")
    boundary = ends.select(key, F.col("last").alias("prev"), F.lead("first").over(w2).alias("next")).where(
        F.col("next").isNotNull()
    )
    return inner.unionByName(boundary)
