"""Quality rules: base counts of a text, and a conditional random field over its lines.

A linear-chain field with two states labels each line that has a word as content or boilerplate, from
counts of its words and signs; Viterbi decoding picks the likeliest sequence. A text is kept if at
least ``MIN_SHARE`` of its words stand in content lines and the base rules don't fail it.

The field is trained here: the lines of at most ``MAX_SAMPLE`` labelled documents (those of least
hash; of a document with more than ``MAX_LINES`` its first and last pieces, the others evenly between)
take their document's quality label, and the log likelihood of these sequences is maximised. It
learns from the rows that the quality labels may be learnt from. Without labels of both kinds every
line is content.

Null and empty texts have counts 0 and fail the base rules (fewer than 20 words). Repeated rows
repeat; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.common import pick

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\r\x0b\x0c"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
MIN_SHARE = 0.5
MAX_SAMPLE = 3000
MAX_LINES = 128
PIECE = 64
FEATURES = 12
CONTENT = 1
_SIGNS = re.compile(r"[^\w\s.,;:'\"()\-]")
_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_MIX = np.random.default_rng(11).integers(1, 2**63, WINDOW, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def repeat_words(words: list, window: int = WINDOW) -> int:
    """Words inside ``window``-word runs that are found twice or more, the first time included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    known: dict = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.uint64, len(words))
    ids = (ids + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    ids ^= ids >> np.uint64(31)
    keys = np.zeros(n, np.uint64)
    for i in range(window):
        keys += ids[i:i + n] * _MIX[i]
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    cover = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + window, -1)
    return int((np.cumsum(cover)[:-1] > 0).sum())


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = text.encode("utf-8", "surrogatepass").split()
    word_chars = len(text) - sum(map(text.count, SPACES))
    seen: set[str] = set()
    dup = 0
    for line in text.split("\n"):
        if line.strip(SPACES):
            dup += line in seen
            seen.add(line)
    return len(words), word_chars, sum(map(text.count, SYMBOLS)), dup, repeat_words(words)


def line_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(features, words) of each line with a word."""
    rows, sizes = [], []
    seen: set[str] = set()
    for line in text.split("\n"):
        words = line.split()
        n = len(words)
        if not n:
            continue
        chars = max(1, len(line))
        letters = max(1, chars - n + 1)
        alike = sum(a == b for a, b in zip(words, words[1:]))
        rows.append((
            1.0, min(n, 40) / 40, n < 4, len(_SIGNS.findall(line)) / n, len(_UPPER.findall(line)) / letters,
            line.count("|") / n, alike / n, len(set(words)) / n, letters / n / 10, line.rstrip()[-1] in ".!?:;\"'",
            line in seen, sum(map(line.count, "0123456789")) / letters,
        ))
        seen.add(line)
        sizes.append(n)
    return np.array(rows, float).reshape(len(rows), FEATURES), np.array(sizes, float)


class Field:
    """Two-state linear-chain field: emissions (2, FEATURES), transitions (2, 2)."""

    def __init__(self, emit: np.ndarray | None = None, step: np.ndarray | None = None):
        self.emit = np.zeros((2, FEATURES)) if emit is None else emit
        self.step = np.zeros((2, 2)) if step is None else step

    def fit(self, sequences: list[np.ndarray], states: list[int], rounds: int = 150) -> Field:
        """Gradient ascent on the mean log likelihood; long sequences are cut into pieces."""
        pieces = [(s[i:i + PIECE], y) for s, y in zip(sequences, states) for i in range(0, len(s), PIECE)]
        if len({y for _, y in pieces}) < 2:
            return self
        n = len(pieces)
        x = np.zeros((n, PIECE, FEATURES))
        size = np.array([len(s) for s, _ in pieces])
        for i, (s, _) in enumerate(pieces):
            x[i, :len(s)] = s
        y = np.array([y for _, y in pieces])
        there = np.arange(PIECE)[None, :] < size[:, None]
        gold = np.zeros((n, PIECE, 2))
        gold[np.arange(n)[:, None], np.arange(PIECE)[None, :], y[:, None]] = there
        gold_step = np.zeros((2, 2))
        np.add.at(gold_step, (y, y), size - 1)
        params = [self.emit, self.step]
        m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        for t in range(1, rounds + 1):
            score = x @ params[0].T
            fwd, bwd = np.zeros((n, PIECE, 2)), np.zeros((n, PIECE, 2))
            fwd[:, 0] = score[:, 0]
            for k in range(1, PIECE):
                new = np.logaddexp(fwd[:, k - 1, :1] + params[1][0], fwd[:, k - 1, 1:] + params[1][1]) + score[:, k]
                fwd[:, k] = np.where(there[:, k, None], new, fwd[:, k - 1])
            for k in range(PIECE - 2, -1, -1):
                ahead = score[:, k + 1] + bwd[:, k + 1]
                new = np.logaddexp(ahead[:, :1] + params[1][:, 0], ahead[:, 1:] + params[1][:, 1])
                bwd[:, k] = np.where(there[:, k + 1, None], new, 0)
            total = np.logaddexp(fwd[:, -1, 0], fwd[:, -1, 1])
            node = np.exp(fwd + bwd - total[:, None, None]) * there[:, :, None]
            pair = fwd[:, :-1, :, None] + params[1] + (score[:, 1:] + bwd[:, 1:])[:, :, None, :] - total[:, None, None, None]
            pair = (np.exp(np.minimum(pair, 0)) * there[:, 1:, None, None]).sum((0, 1))
            grads = [((gold - node).transpose(2, 0, 1).reshape(2, -1) @ x.reshape(-1, FEATURES)) / n - 1e-3 * params[0],
                     (gold_step - pair) / n - 1e-2 * params[1]]
            for i, g in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                params[i] = params[i] + 0.1 * (m[i] / (1 - 0.9 ** t)) / (np.sqrt(v[i] / (1 - 0.999 ** t)) + 1e-8)
        return Field(*params)

    def viterbi(self, x: np.ndarray) -> np.ndarray:
        """The likeliest state of each line; content wins ties."""
        if not len(x):
            return np.empty(0, np.int64)
        (s00, s01), (s10, s11) = self.step.tolist()
        scores = (x @ self.emit.T).tolist()
        a, b = scores[0]
        back = []
        for e0, e1 in scores[1:]:
            f0, f1 = b + s10 >= a + s00, b + s11 >= a + s01
            back.append((f0, f1))
            a, b = (b + s10 if f0 else a + s00) + e0, (b + s11 if f1 else a + s01) + e1
        state = 1 if b >= a else 0
        out = [state]
        for f in reversed(back):
            state = int(f[state])
            out.append(state)
        return np.array(out[::-1])


def content_share(text: str, field: Field) -> float:
    """The share of the words that stand in content lines; 1 without words."""
    x, sizes = line_features(text)
    return float(sizes[field.viterbi(x) == CONTENT].sum() / sizes.sum()) if len(sizes) else 1.0


def sample_lines(x: np.ndarray, limit: int = MAX_LINES) -> np.ndarray:
    """All lines, or ``limit`` in pieces of ``PIECE`` spread evenly: what the driver gets of a document."""
    if len(x) <= limit:
        return x
    return np.concatenate([x[a:a + PIECE] for a in np.linspace(0, len(x) - PIECE, limit // PIECE).astype(int)])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        learn_from=None, max_sample: int = MAX_SAMPLE) -> Field:
    known = pick(labels, id_col, label_col).filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    if learn_from is not None:
        known = known.filter(learn_from(F.col(id_col)))
    known = known.groupBy(id_col).agg((F.avg(label_col) >= 0.5).cast("int").alias("y"))
    rows = pick(docs, id_col, text_col)
    sample = rows.select(id_col).join(known, id_col).select(id_col, "y", F.xxhash64(id_col).alias("order")).distinct()
    # half of the sample from each label, so that the rarer one is learnt too
    half = [sample.filter(F.col("y") == y).orderBy("order").limit(max_sample // 2) for y in (0, 1)]
    sample = half[0].unionAll(half[1])

    @F.pandas_udf("array<array<double>>")
    def lines(texts: pd.Series) -> pd.Series:
        return pd.Series([[list(map(float, r)) for r in sample_lines(line_features(t or "")[0])] for t in texts])

    got = rows.join(F.broadcast(sample), id_col).select("order", "y", lines(text_col).alias("x"))
    got = got.orderBy("order", F.xxhash64("x")).limit(max_sample).collect()
    return Field().fit([np.array(r["x"], float).reshape(-1, FEATURES) for r in got if r["x"]], [r["y"] for r in got if r["x"]])


def judge(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    content_share."""

    @F.pandas_udf("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, content_share double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame(
                [(*base_counts(t or ""), content_share(t or "", field)) for t in texts],
                columns=["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "content_share"])

    rows = pick(docs, id_col, text_col).select(F.col(id_col), run(F.col(text_col)).alias("r")).select(id_col, "r.*")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    rows = rows.withColumn("base_failed", failed)
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("content_share") >= MIN_SHARE))
