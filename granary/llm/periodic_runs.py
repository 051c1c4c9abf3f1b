"""Periodic runs of words by a dictionary of basic factors.

The basic factors of a text are its stretches of 2^k words. Each gets a name, equal for equal stretches:
names of level k + 1 are ranks of pairs of names of level k. Where a factor of length L occurs again within
2 L words, and then again at the same distance d, its occurrences form an arithmetic progression, which
proposes the period d. A block of neighbouring places with the same proposal is extended word by word as far
as words d apart are equal; the same stretch found at several levels counts once.

Nothing is missed: a run of smallest period q and of four periods or more holds, from its first word on, the
factor of length L with q <= L < 2q three times at distance q (2q + L < 4q), and no nearer, since a nearer
occurrence would give the run a smaller period. Nothing else is reported: a stretch of four proposed periods
d holds its proposing factor at every smaller period too, so d is the smallest.

A level without any repeated name ends the dictionary, as no longer factor can repeat. Null and empty texts
have no words and no runs; the operator's memory is a few integers for each word of one text. Repeated rows
give repeated results; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.common import pick

TIMES = 4  # a run holds its period so often at least
LEAST = 6  # and has so many words

RUNS = "array<struct<start:long,length:long,period:long>>"


def names_of(words: list[bytes]) -> np.ndarray:
    """Equal numbers for equal words."""
    known: dict[bytes, int] = {}
    return np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))


def _distances(names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rank of each name, distance to its next occurrence or 0)."""
    order = np.argsort(names, kind="stable")
    ranked = names[order]
    same = ranked[1:] == ranked[:-1]
    ranks = np.empty(len(names), np.int64)
    ranks[order] = np.concatenate([[0], np.cumsum(~same)])
    away = np.zeros(len(names), np.int64)
    away[order[:-1][same]] = (order[1:] - order[:-1])[same]
    return ranks, away


def _proposals(away: np.ndarray, length: int) -> Iterator[tuple[int, int]]:
    """(place, distance) of the first of each block of places whose factor comes again twice at one distance."""
    at = np.flatnonzero((away > 0) & (away <= 2 * length))
    at = at[away[at + away[at]] == away[at]]
    if len(at):
        starts = np.concatenate([[True], (at[1:] != at[:-1] + 1) | (away[at[1:]] != away[at[:-1]])])
        for i in at[starts].tolist():
            yield i, int(away[i])


def _agree(left: np.ndarray, right: np.ndarray) -> int:
    """How many leading entries are equal, looked at in growing slices."""
    n, done, step = min(len(left), len(right)), 0, 64
    while done < n:
        differ = np.flatnonzero(left[done:done + step][:n - done] != right[done:done + step][:n - done])
        if len(differ):
            return done + int(differ[0])
        done, step = done + step, step * 2
    return n


def runs(names: np.ndarray, times: int = TIMES, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, smallest period) of every maximal stretch of ``max(least, times * period)`` entries or
    more, by start, then period. ``times`` is 4 or more: fewer periods need not hold a factor three times."""
    if times < 4:
        raise ValueError("times must be 4 or more")
    n, length, level, found = len(names), 1, names, set()
    while n >= least and 2 * length <= n:
        ranks, away = _distances(level)
        if not away.any():
            break
        seen: dict[int, int] = {}  # distance -> end of its last stretch
        for i, d in _proposals(away, length):
            if i + d < seen.get(d, 0):
                continue
            back = _agree(names[:i][::-1], names[:i + d][::-1])
            ahead = _agree(names[i:], names[i + d:])
            seen[d] = i + ahead + d
            if back + ahead + d >= max(least, times * d):
                found.add((i - back, back + ahead + d, d))
        level = ranks[:-length] * n + ranks[length:]
        length *= 2
    return sorted(found, key=lambda r: (r[0], r[2]))


def kept_places(n: int, found: list[tuple[int, int, int]]) -> np.ndarray:
    """True for each place that no run covers after its first period."""
    cover = np.zeros(n + 1, np.int64)
    for start, length, period in found:
        cover[start + period] += 1
        cover[start + length] -= 1
    return np.cumsum(cover)[:n] == 0


def planted(words: list[bytes], doc_id) -> list[bytes]:
    """The words after the contract's change of one text in ten: from word a on, p words over and over. A
    null id counts as the empty text."""
    h = crc32(b"" if doc_id is None or doc_id is pd.NA else str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    block = words[a:a + p]
    return words[:a] + (block * ((n - a) // p + 1))[:n - a]


def find_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", change=None, with_runs: bool = True,
) -> DataFrame:
    """Per row: id, n_words, n_runs, ``runs`` and ``collapsed`` (the text with one period of each run, joined by
    one space; both if wanted), start, length, period and exponent_milli (1000 * length / period,
    rounded down) of the longest run (ties: the smallest start, then period; null if there is none), runs_sha256 and collapsed_sha256. ``change(words, id)`` may edit the words
    first. Words are what lies between ASCII white space."""

    real = f"runs {RUNS}, collapsed string, " if with_runs else ""

    @F.pandas_udf(f"n_words long, n_runs long, {real}start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string")
    def search(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for ids, texts in batches:
            out = []
            for key, text in zip(ids, texts):
                words = (text or "").encode("utf-8").split()
                if change is not None:
                    words = change(words, key)
                found = runs(names_of(words))
                keep = kept_places(len(words), found) if found else None
                rest = b" ".join(words if keep is None else [words[i] for i in np.flatnonzero(keep).tolist()])
                best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
                power = 1000 * best[1] // best[2] if found else None
                listed = "".join(f"{s},{m},{p}\n" for s, m, p in found)
                both = ([{"start": s, "length": m, "period": p} for s, m, p in found], rest.decode("utf-8")) if with_runs else ()
                out.append((len(words), len(found), *both, *best, power, sha256(listed.encode()).hexdigest(), sha256(rest).hexdigest()))
            names = ["n_words", "n_runs", *(["runs", "collapsed"] if with_runs else []), "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
            frame = pd.DataFrame(out, columns=names)
            yield frame.astype({c: "Int64" for c in ("start", "length", "period", "exponent_milli")})

    # the id goes in as text, so that no number becomes a float where some are null
    rows = pick(docs, id_col, text_col)
    return rows.select(id_col, search(F.col(id_col).cast("string"), F.col(text_col)).alias("r")).select(id_col, "r.*")
