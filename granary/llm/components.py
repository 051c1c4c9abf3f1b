"""Connected components of an edge list by alternating stars, with joins and aggregates only.

Each round replaces every edge by one towards the least neighbour, first for larger neighbours, then
for smaller ones, until the edges are stars around each component's least node. A hub is never
gathered: its minimum is a partial aggregate, and its edges meet that minimum in a join that Spark can
split. Rounds are cut with reliable checkpoints. No edges give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.common import checkpointed


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.shiftrightunsigned(F.xxhash64("hi", "lo"), 24))).first()
    return row[0], row[1]


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of ``edges`` (long columns a and b); root is the least node reached."""
    now = checkpointed(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct())
    seen = _signature(now)
    while seen[0]:
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(
            now.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(low, "hi").filter("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        now = checkpointed(small.unionAll(low.select("hi", F.col("m").alias("lo"))).distinct())
        before, seen = seen, _signature(now)
        if before == seen:
            break
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionAll(
        now.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())
