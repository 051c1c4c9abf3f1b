"""Quality classifier: random-indexing word vectors, pooled, then a small neural network.

Words (and runs of signs) are hashed, by shape, into a vocabulary of fixed size. Each vocabulary entry
has a sparse random index vector; its word vector is the sum of the index vectors of the entries found
up to two places away, over all documents. A document is the mean of its words' vectors. A two-layer
numpy network learns labels from these on a bounded sample of labelled rows (``MAX_SAMPLE``, the rows
of least hash); a temperature fitted on a part of the sample that training hasn't seen calibrates its
probabilities.

Null and empty texts are the zero vector and get whatever the network says of it. Where there are no
labels, or only one class, every score is the smoothed share of label 1 (a half without labels).
Labels that repeat an id count by their mean; null labels don't count. Repeated rows repeat.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.common import pick

WORDS = 4096  # by shape
SHAPES = 6  # lower, title, upper, other word, signs or digits, repeated word
VOCABULARY = WORDS * SHAPES
DIMENSIONS = 32
NONZERO = 2
REACH = 2
SLICE = 1024
MAX_SAMPLE = 20_000
HIDDEN = 16
STEPS = 500
THRESHOLD = 0.3
TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")
_AT_ONCE = 150_000


class Tokens:
    """Vocabulary entries of a text's words, with a bounded cache."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def entry(self, token: str) -> int:
        if token.isalpha():
            shape = 0 if token.islower() else 2 if len(token) > 1 and token.isupper() else 1 if token.istitle() else 3
        else:
            shape = 4
        got = shape * WORDS + zlib.crc32(token.lower().encode("utf-8", "surrogatepass")) % WORDS
        if len(self.known) > 50_000:
            self.known.clear()
        self.known[token] = got
        return got

    def __call__(self, text: str | None) -> np.ndarray:
        known, entry = self.known.get, self.entry
        found = TOKEN.findall(text or "")
        ids = [known(t, -1) for t in found]
        ids = np.array([i if i >= 0 else entry(t) for i, t in zip(ids, found)] if -1 in ids else ids, np.int64)
        if len(ids) > 1:
            again = np.concatenate([[False], (ids[1:] == ids[:-1]) & (ids[1:] < 4 * WORDS)])
            ids[again] = 5 * WORDS + ids[again] % WORDS
        return ids


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the nonzero parts of every entry's random index vector."""
    rng = np.random.default_rng(20)
    return rng.integers(0, DIMENSIONS, (VOCABULARY, NONZERO)), rng.choice([-1, 1], (VOCABULARY, NONZERO))


def _contexts(ids: np.ndarray, place: np.ndarray, sign: np.ndarray) -> np.ndarray:
    """Sums of neighbours' index vectors; -1 stands between documents."""
    total = np.zeros(VOCABULARY * DIMENSIONS)
    for d in range(1, REACH + 1):
        for one, other in ((ids[:-d], ids[d:]), (ids[d:], ids[:-d])):
            ok = (one >= 0) & (other >= 0)
            a, b = one[ok], other[ok]
            for k in range(NONZERO):
                total += np.bincount(a * DIMENSIONS + place[b, k], weights=sign[b, k], minlength=len(total))
    return total.astype(np.int64)


def word_vectors(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Word vectors from all documents. Each task sends its sums in slices; a slice is summed as a
    stream, so nothing grows with the number of tasks. The result has a fixed size."""

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, sign = index_vectors()
        tokens = Tokens()
        total = np.zeros(VOCABULARY * DIMENSIONS, np.int64)
        held, n, gap = [], 0, np.full(REACH, -1, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                ids = tokens(text)
                held += [ids, gap]
                n += len(ids)
                if n > _AT_ONCE:
                    total += _contexts(np.concatenate(held), place, sign)
                    held, n = [], 0
        if n:
            total += _contexts(np.concatenate(held), place, sign)
        yield from _slices(total)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = np.frombuffer(zlib.decompress(data), np.int64)
                sums[k] = sums[k] + part if k in sums else part
        for k, part in sums.items():
            yield _row(k, part)

    def _row(k: int, part: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([k], pa.int32()), pa.array([zlib.compress(part.tobytes(), 1)], pa.binary())], names=["slice", "data"])

    def _slices(total: np.ndarray) -> Iterator[pa.RecordBatch]:
        for k, part in enumerate(total.reshape(-1, SLICE * DIMENSIONS)):
            if part.any():
                yield _row(k, part)

    schema = "slice int, data binary"
    sums = pick(docs, text_col).mapInArrow(learn, schema).repartition("slice").mapInArrow(add, schema)
    vectors = np.zeros((VOCABULARY // SLICE, SLICE * DIMENSIONS))
    for row in sums.collect():  # VOCABULARY / SLICE rows
        vectors[row["slice"]] = np.frombuffer(zlib.decompress(bytes(row["data"])), np.int64)
    vectors = vectors.reshape(VOCABULARY, DIMENSIONS)
    return (vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1.0)).astype(np.float32)


def pool(ids: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    if not len(ids):
        return np.zeros(DIMENSIONS, np.float32)
    return np.bincount(ids, minlength=VOCABULARY).astype(np.float32) @ vectors / len(ids) if len(ids) > 4000 \
        else vectors[ids].mean(0)


class Network:
    """Two layers and a temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, check: np.ndarray):
        """``check`` marks the rows kept for the temperature."""
        self.prior = float((y.sum() + 1) / (len(y) + 2))
        self.fitted = bool(0 < y.sum() < len(y))
        if not self.fitted:
            return
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-6
        x = (x - self.mean) / self.scale
        use = ~check if 0 < y[~check].sum() < (~check).sum() else np.ones(len(y), bool)
        rng = np.random.default_rng(7)
        w = [rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN ** -0.5, HIDDEN), np.zeros(1)]
        m, v = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w]
        a, b = x[use], y[use]
        for t in range(1, STEPS + 1):
            h = np.tanh(a @ w[0] + w[1])
            p = 1 / (1 + np.exp(-np.clip(h @ w[2] + w[3], -30, 30)))
            e = (p - b) / len(b)
            back = np.outer(e, w[2]) * (1 - h * h)
            grads = [a.T @ back + 1e-4 * w[0], back.sum(0), h.T @ e + 1e-4 * w[2], np.array([e.sum()])]
            for i, g in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                w[i] = w[i] - 0.02 * (m[i] / (1 - 0.9 ** t)) / (np.sqrt(v[i] / (1 - 0.999 ** t)) + 1e-8)
        self.w, self.temperature = w, 1.0
        if check.any():
            z = self._logit(x[check])
            def loss(t):
                return np.mean(np.logaddexp(0, z / t) - y[check] * z / t)
            self.temperature = float(min(np.geomspace(0.25, 8, 60), key=loss))

    def _logit(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(x @ self.w[0] + self.w[1]) @ self.w[2] + self.w[3]

    def scores(self, x: np.ndarray) -> np.ndarray:
        if not self.fitted:
            return np.full(len(x), self.prior)
        return 1 / (1 + np.exp(-np.clip(self._logit((x - self.mean) / self.scale) / self.temperature, -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        learn_from=None, max_sample: int = MAX_SAMPLE) -> tuple[np.ndarray, Network]:
    """Word vectors from all of ``docs``; the network from at most ``max_sample`` labelled rows whose id
    passes ``learn_from`` (a function of the id column)."""
    vectors = word_vectors(docs, text_col)
    known = pick(labels, id_col, label_col).filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    if learn_from is not None:
        known = known.filter(learn_from(F.col(id_col)))
    known = known.groupBy(id_col).agg((F.avg(label_col) >= 0.5).cast("int").alias("y"))
    rows = pick(docs, id_col, text_col)
    sample = rows.select(id_col).join(known, id_col).select(id_col, "y", F.xxhash64(id_col).alias("order")).distinct()
    sample = sample.orderBy("order").limit(max_sample)

    @F.pandas_udf("array<float>")
    def pooled(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokens = Tokens()
        for texts in batches:
            yield pd.Series([pool(tokens(t), vectors) for t in texts])

    got = rows.join(F.broadcast(sample), id_col).select("order", "y", pooled(text_col).alias("x"))
    got = got.orderBy("order", F.xxhash64("x")).limit(max_sample).collect()  # bounded: max_sample short vectors
    x = np.array([r["x"] for r in got], float).reshape(len(got), DIMENSIONS)
    check = np.array([(r["order"] >> 7) % 5 == 0 for r in got], bool)
    return vectors, Network(x, np.array([r["y"] for r in got], float), check)


def score_column(text, model: tuple[np.ndarray, Network]):
    """Column: the probability of label 1 of each text."""
    vectors, network = model

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokens = Tokens()
        for texts in batches:
            x = np.array([pool(tokens(t), vectors) for t in texts], float).reshape(len(texts), DIMENSIONS)
            yield pd.Series(network.scores(x))

    return run(text)
