"""Benchmark decontamination with a generalised suffix automaton.

The automaton holds every run of words of every test item. Training words stream through it; the
length of the longest match that ends at each word is tracked. A match of ``window`` words or more,
or a match of a whole item of fewer words, marks its words as hit.

Test items go into one automaton as long as their words number at most ``block_words``; beyond that
Spark deals them out to blocks of about so many words, longer items in overlapping pieces. The driver passes
the blocks on one at a time, as broadcasts that lie on disk. A task takes some documents at a time
(``HELD_CHARS``) and runs the blocks' automata over them in turn, with one automaton in memory. So what
a task or the driver holds is bounded whatever the size of the benchmark; the time grows with the blocks.

Null and empty texts have no words and no hits; items without words match nothing; an empty benchmark
hits nothing. Repeated items count by item_id. Repeated documents give repeated rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.common import WORD_BYTES, checkpointed, packed, pick, plain_words, unpacked

WINDOW = 10
BLOCK_WORDS = 150_000  # about 0.1 GB of automaton in each Python worker
HELD_CHARS = 16_000_000
MAX_COVERAGE = 0.8


class SuffixAutomaton:
    """Generalised suffix automaton over word ids; windows never cross items."""

    def __init__(self, items: list[tuple], window: int = WINDOW):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.len = [0]
        self.items: list[set] = [set()]
        self.short: list[int] = [0]  # length of the short item that ends here, else 0
        self.shortest = window
        for item_id, words in items:
            if not words:
                continue
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]
            self.shortest = min(self.shortest, len(ids))
            last = 0
            for c in ids:
                last = self._extend(last, c)
        for item_id, words in items:  # again, now that no state will be split any more
            if not words:
                continue
            ids = [self.vocabulary[w] for w in words]
            if len(ids) < window:
                state = 0
                for c in ids:
                    state = self.next[state][c]
                self.short[state] = len(ids)
                self.items[state].add(item_id)
            else:
                state, n = 0, 0
                for c in ids:
                    state, n = self.next[state][c], n + 1
                    state, n = self.cut(state, n)
                    if n == window:
                        self.items[state].add(item_id)
        # the nearest state at or above each one that ends a short item
        self.above = [-1] * len(self.link)
        for s in sorted(range(len(self.link)), key=self.len.__getitem__):
            self.above[s] = s if self.short[s] else self.above[self.link[s]] if self.link[s] >= 0 else -1

    def _add(self, length: int, nxt: dict, link: int) -> int:
        self.next.append(nxt)
        self.len.append(length)
        self.link.append(link)
        self.items.append(set())
        self.short.append(0)
        return len(self.len) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        clone = self._add(self.len[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, c: int) -> int:
        if c in self.next[last]:
            q = self.next[last][c]
            return q if self.len[q] == self.len[last] + 1 else self._split(last, c, q)
        state = self._add(self.len[last] + 1, {}, 0)
        p = last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = state
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[state] = q if self.len[q] == self.len[p] + 1 else self._split(p, c, q)
        return state

    def cut(self, state: int, n: int) -> tuple[int, int]:
        """The state of the last ``window`` words of a match of n words; keeps matches at that length."""
        if n > self.window:
            n = self.window
        while self.link[state] >= 0 and self.len[self.link[state]] >= n:
            state = self.link[state]
        return state, n

    def spans(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Merged word spans [start, end) covered by windows, and the ids of the items they are from."""
        get = self.vocabulary.get
        ids = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        known = np.concatenate([[0], (ids >= 0).view(np.int8), [0]])
        edge = np.diff(known)
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        long = ends - starts >= self.shortest
        out: list[tuple[int, int]] = []
        found: set = set()
        nxt, link, length, window = self.next, self.link, self.len, self.window

        def hit(a: int, b: int) -> None:
            while out and out[-1][1] >= a:
                a = min(a, out.pop()[0])
            out.append((a, b))

        for a, b in zip(starts[long].tolist(), ends[long].tolist()):
            state = n = 0
            for i, c in enumerate(ids[a:b].tolist(), a + 1):
                while state and c not in nxt[state]:
                    state = link[state]
                    n = length[state]
                if c in nxt[state]:
                    state, n = nxt[state][c], n + 1
                    if n >= window:
                        state, n = self.cut(state, n)
                        hit(i - window, i)
                        found |= self.items[state]
                    s = self.above[state]
                    if s >= 0 and self.short[s] > n:  # the state's own longest word run isn't matched whole
                        s = self.above[link[s]]
                    while s >= 0:
                        hit(i - self.short[s], i)
                        found |= self.items[s]
                        s = self.above[link[s]] if link[s] >= 0 else -1
        return out, found


def pieces(text: str | None, window: int, block_words: int) -> list[str]:
    """The item's words joined by spaces; beyond ``block_words`` in pieces that hold each window whole."""
    words = plain_words(text)
    step = max(block_words, window)
    if len(words) <= step:
        return [b" ".join(words).decode()] if words else []
    return [b" ".join(words[a:a + step + window - 1]).decode() for a in range(0, len(words) - window + 1, step)]


def blocks(benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> list[Broadcast]:
    """Broadcasts of lists of (item_id, words as a text), of about ``block_words`` words each; the driver holds
    one of them at a time."""

    @F.pandas_udf("array<string>")
    def cut(texts: pd.Series) -> pd.Series:
        return pd.Series([pieces(t, window, block_words) for t in texts], dtype=object)

    spark = benchmark.sparkSession
    items = pick(benchmark, "item_id", "text").select("item_id", F.explode(cut("text")).alias("text")).distinct()
    items = checkpointed(items)  # copies of an item say nothing new
    n_words = F.length("text") - F.length(F.replace("text", F.lit(" "), F.lit(""))) + 1
    n = -(-(items.agg(F.sum(n_words)).first()[0] or 0) // block_words)
    if n <= 1:
        return [spark.sparkContext.broadcast([tuple(r) for r in items.collect()])] if n else []
    items = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n)))
    items = items.repartition(n, "block").sortWithinPartitions("block")
    return [spark.sparkContext.broadcast([(r["item_id"], r["text"]) for r in rows])
            for _, rows in groupby(items.toLocalIterator(), key=lambda r: r["block"])]


def _automaton(part: Broadcast, window: int) -> SuffixAutomaton:
    made = SuffixAutomaton([(i, t.encode().split(b" ")) for i, t in part.value], window)
    vars(part).pop("_value", None)  # the block stays on disk only
    return made


def _groups(batches: Iterator[pd.Series], chars: int) -> Iterator[list]:
    """The texts of several batches at a time, of about ``chars`` characters."""
    held: list = []
    n = 0
    for texts in batches:
        held += texts.tolist()
        n += sum(len(t) for t in texts if t)
        if n >= chars:
            yield held
            held, n = [], 0
    if held:
        yield held


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and out[-1][1] >= a:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def matches(parts: list[Broadcast], window: int = WINDOW, held_chars: int = HELD_CHARS):
    """Column function: text -> struct(n_words, n_hit, items, spans of words)."""

    @F.pandas_udf("n_words long, n_hit long, items array<long>, spans array<struct<start:int,end:int>>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        only = _automaton(parts[0], window) if len(parts) == 1 else None
        for texts in _groups(batches, 0 if only or not parts else held_chars):
            spans: list[list] = [[] for _ in texts]
            items: list[set] = [set() for _ in texts]
            for part in parts:
                automaton = only or _automaton(part, window)
                for k, t in enumerate(texts):
                    got, found = automaton.spans(plain_words(t))
                    spans[k] = _merge(spans[k] + got)
                    items[k] |= found
                del automaton  # before the next one is built
            rows = [(len(plain_words(t)), sum(b - a for a, b in x), sorted(i, key=str), [{"start": a, "end": b} for a, b in x])
                    for t, x, i in zip(texts, spans, items)]
            yield pd.DataFrame(rows, columns=["n_words", "n_hit", "items", "spans"])

    return run


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per row: id, n_words, n_hit, items (ids of the items with windows in it), spans (in words)."""
    run = matches(blocks(benchmark, window, block_words), window)
    return pick(docs, id_col, text_col).select(F.col(id_col), run(F.col(text_col)).alias("r")).select(id_col, "r.*")


def items_digest(items):
    """sha256 of the item ids, sorted as strings and joined by commas."""
    return F.sha2(F.concat_ws(",", F.sort_array(F.transform(items, lambda x: x.cast("string")))), 256)


def without_words(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans and what stands between them."""
    data = text.encode("utf-8", "surrogatepass")
    flat = np.frombuffer(data.translate(WORD_BYTES), np.uint8) != 32
    edge = np.diff(np.concatenate([[0], flat.view(np.int8), [0]]))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    out, at = [], 0
    for a, b in spans:
        out.append(data[at:starts[a]])
        at = ends[b - 1]
    out.append(data[at:])
    return b"".join(out).decode("utf-8", "surrogatepass")


def remove_contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
                         window: int = WINDOW, max_coverage: float = MAX_COVERAGE,
                         block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents' rows with hit spans taken out of the text; a document of which more than
    ``max_coverage`` of the words are hit goes altogether. n_chars follows the text if there."""
    automaton_run = matches(blocks(benchmark, window, block_words), window)

    @F.pandas_udf("string")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([
            without_words(t, [(s["start"], s["end"]) for s in x]) if t and x is not None and len(x) else t
            for t, x in zip(texts, spans)], dtype=object)

    rows = packed(docs, text_col).withColumn("r", automaton_run(F.col(text_col)))
    rows = rows.filter(F.col("r.n_hit") <= F.lit(max_coverage) * F.col("r.n_words"))
    rows = rows.withColumn("left", F.when(F.col("r.n_hit") > 0, cut(F.col(text_col), F.col("r.spans")))
                           .otherwise(F.col(text_col)))
    return unpacked(rows, docs, **{text_col: F.col("left")}, n_chars=F.length("left").cast("long"))


def digest_of(item_ids) -> str:
    return sha256(",".join(sorted(map(str, item_ids))).encode()).hexdigest()
