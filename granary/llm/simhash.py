"""SimHash near-duplicates: all links within 4 bits, found by Golay-code keys.

Texts become 64-bit fingerprints; equal fingerprints are merged first, with partial aggregates, so a
group of exact copies is one node however large. Each node gets about a hundred keys (see ``golay``):
nodes within 4 bits share one. Keys of a single node, nearly all, go first. Links are then found in two
steps that together lose no component:

1. In each key's bucket every node is compared with three nodes of the bucket, picked by different
   orders. This joins the bulk of a dense group without looking at its pairs.
2. Buckets that still hold several components are searched: nodes outside the bucket's largest
   component are compared with all others of another component. Links found here join components.

The work of step 2 is the number of leftover nodes of a bucket times its size, in a join that Spark
can split. Nothing is dropped or capped, and nothing is gathered per group or on the driver.

Null, empty and blank texts have fingerprint zero and are linked like any other. Repeated rows are
copies of each other. A row whose id is null is linked too; component ids are least non-null ids.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm import golay
from granary.llm.common import checkpointed, packed, pick, unpacked
from granary.llm.components import connected

SHINGLE = 4
SEED = 42
SALTS = (0, 0x5DEECE66D1F3A9B7, 0x2545F4914F6CDD1D)
_AT_ONCE = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Unsigned 64-bit SimHash: a bit is set where more than half the shingles' hashes have it."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    hashed = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return hashed(joined, seed)
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    starts = (ends - size)[:len(words) - shingle + 1].tolist()
    hashes = np.array([hashed(joined[a:b], seed) for a, b in zip(starts, ends[shingle - 1:].tolist())], np.uint64)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), _AT_ONCE):
        part = hashes[i:i + _AT_ONCE].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprint_column(text, shingle: int = SHINGLE):
    @F.pandas_udf("long")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64))

    return run(text)


def _bits(a, b):
    return F.bit_count(a.bitwiseXOR(b))


def fingerprint_components(nodes: DataFrame, max_bits: int = golay.MAX_BITS) -> DataFrame:
    """(fp, root) of distinct fingerprints ``fp``: equal roots where chains of links join them."""
    if max_bits > golay.MAX_BITS:
        raise ValueError(f"the keys hold for up to {golay.MAX_BITS} bits")

    @F.pandas_udf("array<long>")
    def keys(fps: pd.Series) -> pd.Series:
        return pd.Series(list(golay.keys(fps.to_numpy(np.int64).view(np.uint64))))

    # a node becomes a hundred rows: deal the nodes out to all tasks, however few bytes they are (by a hash of
    # fp: a frame that lies by fp already would stay as it lies)
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = nodes.repartition(parts, F.xxhash64("fp")).select("fp", F.explode(F.array_distinct(keys("fp"))).alias("key"))
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key")
    keyed = checkpointed(keyed.join(shared, "key", "left_semi"))

    # step 1: every node against three nodes of its bucket
    some = keyed.groupBy("key").agg(
        *[F.min(F.col("fp").bitwiseXOR(F.lit(s))).alias(f"m{i}") for i, s in enumerate(SALTS)],
    ).select("key", F.array(*[F.col(f"m{i}").bitwiseXOR(F.lit(s)) for i, s in enumerate(SALTS)]).alias("picks"))
    near = F.array_distinct(F.filter("picks", lambda p: (p != F.col("fp")) & (F.bit_count(p.bitwiseXOR(F.col("fp"))) <= max_bits)))
    first = keyed.join(some, "key").select(F.col("fp").alias("a"), near.alias("near")).filter(F.size("near") > 0)
    roots = checkpointed(connected(first.select("a", F.explode("near").alias("b")).distinct()))

    # step 2: what is still apart in a bucket
    named = keyed.join(roots, keyed["fp"] == roots["node"], "left").select(
        "key", "fp", F.coalesce("root", "fp").alias("comp"))
    counts = named.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("n"))
    mixed = counts.groupBy("key").agg(F.count(F.lit(1)).alias("comps"), F.max_by("comp", "n").alias("largest")).filter("comps > 1")
    left = named.join(mixed, "key").filter("comp <> largest").select("key", F.col("fp").alias("a"), F.col("comp").alias("ca"))
    right = named.select("key", F.col("fp").alias("b"), F.col("comp").alias("cb"))
    more = left.join(right, "key").filter((F.col("ca") != F.col("cb")) & (_bits(F.col("a"), F.col("b")) <= max_bits))
    more = more.select(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b")).distinct()
    joined = connected(more).select(F.col("node").alias("comp"), F.col("root").alias("over"))

    named = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", F.coalesce("root", "fp").alias("comp"))
    return named.join(joined, "comp", "left").select("fp", F.coalesce("over", "comp").alias("root"))


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
               max_bits: int = golay.MAX_BITS) -> DataFrame:
    """Per row: id, fp (the fingerprint as a signed long), component_id (least id of its component)."""
    rows = checkpointed(pick(docs, id_col, text_col).select(
        F.col(id_col).alias("id"), fingerprint_column(F.col(text_col), shingle).alias("fp")))
    nodes = rows.groupBy("fp").agg(F.min("id").alias("first"))
    roots = fingerprint_components(nodes.select("fp"), max_bits)
    named = nodes.join(roots, "fp")
    ids = named.groupBy("root").agg(F.min("first").alias("component_id"))
    named = checkpointed(named.join(ids, "root").select("fp", "component_id"))
    return rows.join(named, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
             max_bits: int = golay.MAX_BITS) -> DataFrame:
    """The documents' rows, one of each component: that of the least id, or any if no row of the component
    has an id. Among rows of that id the least row hash decides; ids may be null, repeat or be shared by
    different components."""
    columns = [F.col(f"whole.f{i}") for i in range(len(docs.columns))]
    # a hash skips nulls, so which columns are null is part of the row's key; equal keys are copies of a row
    nulls = F.concat(*[F.when(c.isNull(), "0").otherwise("1") for c in columns])
    rows = packed(docs, id_col, text_col).toDF("whole", "id", "text").withColumns({
        "h1": F.xxhash64(nulls, "whole"), "h2": F.xxhash64(F.lit(1), nulls, "whole")})
    small = checkpointed(rows.select("id", "h1", "h2", fingerprint_column(F.col("text"), shingle).alias("fp")))
    order = F.struct(F.col("id").isNull().alias("none"), "id", "h1", "h2")
    nodes = checkpointed(small.groupBy("fp").agg(F.min(order).alias("first")))
    best = nodes.join(fingerprint_components(nodes.select("fp"), max_bits), "fp").groupBy("root").agg(F.min("first").alias("first"))
    keep = best.select("first.h1", "first.h2")
    # copies of a row are merged before they are shuffled, however many there are
    single = rows.groupBy("h1", "h2").agg(F.first("whole").alias("whole"))
    return unpacked(single.join(keep, ["h1", "h2"], "left_semi"), docs)
