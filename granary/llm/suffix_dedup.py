"""Exact removal of repeated byte strings by prefix-free parsing.

Every byte that a ``length``-byte string covers which also starts elsewhere (in any text) is found.

A rolling hash over 8 bytes picks triggers: the window of ``length`` bytes at p is named by the least
hash in it, at m(p). Equal windows have their trigger at equal offsets, so neighbouring windows with
the same trigger (and the same quarter of the offset) form a *phrase*: a run of window starts whose
text is the dictionary entry. Two strings are taken of a phrase:

* ``core``: the bytes that every window of this trigger and quarter shares. Whatever the run, equal
  windows have equal cores. A core that's found once in the corpus settles the phrase: no repeats.
* ``hull``: all bytes of the run's windows. A hull that's found twice settles the phrase: all repeat.

What is left are phrases at the edges of repeated passages, a few hundredths of all windows. Their
windows, and those of one witness of each settled hull with the same core, are compared one by one.
Of the corpus' suffix order only the classes that agree in the first ``length`` bytes matter here, so
classes stand in for ranks; the order inside a class isn't worked out.

Hot passages: a task first merges equal hulls (and windows) among its own rows: one of them stands for
all, the others are settled on the spot. So a class reaches another task at most once per chunk of a
task. Text is moved once, by a hash of the text, in a join that Spark can split.

Null and empty texts, and those shorter than ``length``, have nothing to remove. Texts that occur
twice, also in repeated rows, repeat from end to end. Hashes are 64 bits wide (phrases must agree in
two of them).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from granary.llm.common import checkpointed, packed, unpacked

LENGTH = 200
TRIGGER = 8
CHUNK_ROWS = 100_000
SPANS = "array<struct<start:long,end:long>>"
_ROWS = "core long, hull long, key long, pos long, mult int"
_LOW = np.uint64(0xFFFFFFFF)


def triggers(data: bytes, length: int = LENGTH) -> np.ndarray:
    """m(p) for each window start p: where the least rolling hash of the window stands, leftmost."""
    n, width = len(data), length - TRIGGER + 1
    words = np.zeros(n - TRIGGER + 1, np.uint64)
    for k in range(TRIGGER):
        count = (n - k) // 8
        part = np.frombuffer(data, "<u8", count, k)
        words[k::8][:count] = part[:len(words[k::8])]
    words *= np.uint64(0x9E3779B97F4A7C15)
    words ^= words >> np.uint64(29)
    words *= np.uint64(0xBF58476D1CE4E5B9)
    words &= ~_LOW
    words |= np.arange(len(words), dtype=np.uint64)
    windows = len(words) - width + 1
    blocks = np.full(-(-len(words) // width) * width, 2**64 - 1, np.uint64)
    blocks[:len(words)] = words
    blocks = blocks.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, 1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    least = np.minimum(behind[:windows], ahead[width - 1:width - 1 + windows])
    return (least & _LOW).astype(np.int64)


def phrases(data: bytes, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """(first window, last window, start of the core, end of the core) of each phrase."""
    at = triggers(data, length)
    width = length - TRIGGER + 1
    quarter = -(-width // 4)
    part = (at - np.arange(len(at))) // quarter
    new = np.flatnonzero((at[1:] != at[:-1]) | (part[1:] != part[:-1])) + 1
    first = np.concatenate([[0], new])
    last = np.concatenate([new, [len(at)]]) - 1
    low = part[first] * quarter
    high = np.minimum(low + quarter - 1, width - 1)
    return first, last, at[first] - low, at[first] - high + length


def _signed(values) -> np.ndarray:
    return np.array(values, np.uint64).view(np.int64)


def _merged(core, hull, key, pos, mult) -> pa.RecordBatch:
    """Rows of a chunk: of equal hulls the first stands for all, with its count; the others are
    settled (mult 0) and dealt out by a hash of their own."""
    order = np.argsort(hull, kind="stable")
    same = np.concatenate([[False], hull[order][1:] == hull[order][:-1]])
    group = np.cumsum(~same) - 1
    total = np.bincount(group, weights=mult[order])
    settled = np.zeros(len(hull), bool)
    settled[order] = same
    many = np.empty(len(hull), np.int64)
    many[order] = np.minimum(total[group], 2)
    spread = ((key.view(np.uint64) + pos.view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)
    return pa.RecordBatch.from_arrays([
        pa.array(np.where(settled, spread, core)), pa.array(np.where(settled, 0, hull)), pa.array(key), pa.array(pos),
        pa.array(np.where(settled, 0, many).astype(np.int32)),
    ], names=["core", "hull", "key", "pos", "mult"])


def _phrase_rows(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        held: list[tuple] = []
        seen: dict[int, int] = {}
        copies: list[int] = []
        rows = 0

        def flush() -> pa.RecordBatch:
            core, hull, key, pos = (np.concatenate([h[i] for h in held]) for i in range(4))
            mult = np.repeat(copies, [len(h[0]) for h in held])
            return _merged(core, hull, key, pos, mult)

        for batch in batches:
            for key, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                if key in seen:
                    copies[seen[key]] += 1
                    continue
                data = data.as_buffer().to_pybytes()
                first, last, a, z = phrases(data, length)
                seen[key] = len(held)
                copies.append(1)
                held.append((
                    _signed([digest(data[i:j]) for i, j in zip(a.tolist(), z.tolist())]),
                    _signed([digest(data[i:j]) for i, j in zip(first.tolist(), (last + length).tolist())]),
                    np.full(len(first), key, np.int64), first << 8 | last - first))
                rows += len(first)
                if rows >= CHUNK_ROWS:
                    yield flush()
                    held, seen, copies, rows = [], {}, [], 0
        if held:
            yield flush()

    return run


def _window_rows(text_field: str, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        held: list[tuple] = []
        rows = 0

        def flush() -> pa.RecordBatch:
            hull, key, pos = (np.concatenate([h[i] for h in held]) for i in range(3))
            return _merged(hull, hull, key, pos, np.ones(len(hull), np.int64))

        for batch in batches:
            texts = batch.column("whole").field(text_field)
            for key, text, look in zip(batch.column("key").to_pylist(), texts, batch.column("look").to_pylist()):
                data = text.as_buffer().to_pybytes()
                starts = [np.arange(x >> 8, (x >> 8) + (x & 255) + 1) for x in look]
                at = np.unique(np.concatenate(starts))
                held.append((_signed([digest(data[p:p + length]) for p in at.tolist()]),
                             np.full(len(at), key, np.int64), at << 8))
                rows += len(at)
                if rows >= CHUNK_ROWS:
                    yield flush()
                    held, rows = [], 0
        if held:
            yield flush()

    return run


def merge_runs(runs, length: int = LENGTH) -> list[tuple[int, int]]:
    """Byte spans [start, end) covered by the windows of packed runs (first window << 8 | more)."""
    if runs is None or not len(runs):
        return []
    packed_runs = np.sort(np.asarray(runs, np.int64))
    starts = packed_runs >> 8
    ends = np.maximum.accumulate(starts + (packed_runs & 255) + length)
    new = np.flatnonzero(starts[1:] > ends[:-1]) + 1
    return list(zip(starts[np.concatenate([[0], new])].tolist(),
                    ends[np.concatenate([new - 1, [len(ends) - 1]])].tolist()))


def repeated_runs(docs: DataFrame, text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """``whole`` (see ``common.packed``) and ``runs``: packed runs of repeated windows, null if none."""
    names = packed(docs, text_col)
    field = f"f{[c for c in docs.columns].index(text_col)}" if text_col in docs.columns else \
        f"f{[c.lower() for c in docs.columns].index(text_col.lower())}"
    text = F.coalesce(F.col(f"whole.{field}"), F.lit(""))
    rows = names.select("whole", F.xxhash64(text).alias("key"))

    long = rows.select("key", F.col(f"whole.{field}").alias("text")).filter(F.octet_length("text") >= length)
    found = long.mapInArrow(_phrase_rows(length), _ROWS).repartition("core")
    by_hull, by_core = Window.partitionBy("core", "hull"), Window.partitionBy("core")
    found = found.withColumn("n_hull", F.sum("mult").over(by_hull)).withColumn("lead", F.min("key").over(by_hull))
    found = found.withColumn("n_core", F.sum("mult").over(by_core)).withColumn(
        "open", F.max(F.col("n_hull") == 1).over(by_core))
    done = (F.col("mult") == 0) | (F.col("n_hull") > 1)
    look = (F.col("mult") > 0) & (F.col("n_core") > 1) & F.col("open") & ((F.col("n_hull") == 1) | (F.col("key") == F.col("lead")))
    lists = checkpointed(found.filter(done | look).groupBy("key").agg(
        F.collect_set(F.when(done, F.col("pos"))).alias("done"), F.collect_set(F.when(look, F.col("pos"))).alias("look")))

    edges = rows.join(lists.filter(F.size("look") > 0).select("key", "look"), "key").select("whole", "key", "look")
    windows = edges.mapInArrow(_window_rows(field, length), _ROWS).repartition("core")
    windows = windows.withColumn("n", F.sum("mult").over(by_hull)).filter("mult = 0 or n > 1")
    windows = windows.groupBy("key").agg(F.collect_set("pos").alias("more"))
    runs = lists.join(windows, "key", "left").select(
        "key", F.concat("done", F.coalesce("more", F.array().cast("array<long>"))).alias("runs")).filter(F.size("runs") > 0)
    return rows.join(runs, "key", "left").select("whole", F.col(f"whole.{field}").alias("text"), "runs")


def removed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """Per row: id, n_bytes, spans (byte spans that repeat, merged), kept (the other bytes)."""

    @F.pandas_udf(f"spans {SPANS}, kept binary")
    def cut(texts: pd.Series, runs: pd.Series) -> pd.DataFrame:
        out = []
        for text, run in zip(texts, runs):
            data = (text or "").encode("utf-8", "surrogatepass")
            spans, kept, at = merge_runs(run, length), [], 0
            for a, b in spans:
                kept.append(data[at:a])
                at = b
            out.append(([{"start": a, "end": b} for a, b in spans], b"".join([*kept, data[at:]])))
        return pd.DataFrame(out, columns=["spans", "kept"])

    rows = repeated_runs(docs, text_col, length)
    at = docs.columns.index(id_col) if id_col in docs.columns else [c.lower() for c in docs.columns].index(id_col.lower())
    return rows.select(
        F.col(f"whole.f{at}").alias(id_col), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        cut("text", "runs").alias("r")).select(id_col, "n_bytes", "r.spans", "r.kept")


def without_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the spans; a character that a span covers in part stays."""
    data = text.encode("utf-8", "surrogatepass")
    out, at = [], 0
    for a, b in spans:
        while a < b and data[a] & 0xC0 == 0x80:
            a += 1
        while a < b < len(data) and data[b] & 0xC0 == 0x80:
            b -= 1
        out.append(data[at:a])
        at = b
    return b"".join([*out, data[at:]]).decode("utf-8", "surrogatepass")


def remove_repeats(docs: DataFrame, text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """The documents' rows with repeated spans taken out of the text; n_chars follows if there. A
    document of which nothing but white space is left goes, unless it was so before."""

    @F.pandas_udf("string")
    def cut(texts: pd.Series, runs: pd.Series) -> pd.Series:
        return pd.Series([t if not t or r is None else without_spans(t, merge_runs(r, length))
                          for t, r in zip(texts, runs)], dtype=object)

    rows = repeated_runs(docs, text_col, length)
    rows = rows.select("whole", "runs", F.when(F.col("runs").isNull(), F.col("text")).otherwise(cut("text", "runs")).alias("left"))
    rows = rows.filter(F.col("runs").isNull() | (F.trim("left") != ""))
    return unpacked(rows, docs, **{text_col: F.col("left"), "n_chars": F.length("left").cast("long")})
