"""Language identification by multilingual mixtures.

A model holds, for each language of the training rows, the probabilities of hashed letter trigrams,
counted over all training rows. A document is a mixture: expectation-maximisation estimates how much
of it each language accounts for. Then the set of languages is chosen by penalised likelihood: each
language beyond the first must raise the log likelihood by ``penalty`` times the log of the number of
trigrams. A document whose best single language can't be beaten by any set is settled at once; for
the others the sets of the 2, 3, ... largest proportions are fitted. The largest language of the
chosen set is the prediction, its proportion in the full mixture the score.

Null and empty texts and texts without a letter are ``und`` with score 0, and so is everything where
there are no training rows. Ties go to the language first in the alphabet. Rows are handled one by
one; repeated rows repeat, extra columns are ignored. The model is languages x 16384 numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.common import pick

BUCKETS = 1 << 14
#: EM goes on while a round adds more than GAIN + FLAT * |log likelihood| to some document's log likelihood
GAIN, FLAT = 0.01, 1e-5
PENALTY = 3.0
SMOOTH = 0.5


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def trigram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, counts) of the trigrams of letters, with a space around words; empty without letters."""
    none = np.empty(0, np.int64), np.empty(0, np.int64)
    if not text:
        return none
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[points]
    if not letter.any():
        return none
    keep = letter | np.concatenate([[True], letter[:-1]])
    x = np.concatenate([[32], np.where(letter, points, 32)[keep], [32]]).astype(np.uint64)
    h = (x[:-2] * np.uint64(0x9E3779B97F4A7C15) + x[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + x[2:] * np.uint64(0x165667B19E3779F9))
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    counts = np.bincount((h >> np.uint64(50)).astype(np.int64), minlength=BUCKETS)
    at = np.flatnonzero(counts)
    return at, counts[at]


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """(languages, log probabilities by bucket and language) from all rows of ``docs`` with a language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                at, n = trigram_counts(text)
                if lang not in totals:
                    totals[lang] = np.zeros(BUCKETS, np.int64)
                totals[lang][at] += n
        for lang, total in totals.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(total[at])],
                names=["lang", "bucket", "n"])

    rows = pick(docs, text_col, lang_col).filter(F.col(lang_col).isNotNull())
    rows = rows.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    got = rows.toPandas()  # languages x buckets at most
    names = sorted(got["lang"].unique())
    table = np.full((BUCKETS, len(names)), SMOOTH)
    table[got["bucket"].to_numpy(np.int64), np.searchsorted(names, got["lang"].to_numpy()) if names else []] += got["n"].to_numpy(float)
    return names, np.log(table / table.sum(0)) if names else table


def _mixture(like: np.ndarray, n: np.ndarray, starts: np.ndarray, owner: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """EM for many documents at once: (proportions, log likelihoods) within the ``allowed`` languages."""
    share = allowed / allowed.sum(1, keepdims=True)  # a new array, changed below
    total = np.add.reduceat(n, starts)[:, None]
    part, fitted, active = like * share[owner], np.full(len(starts), -np.inf), np.ones(len(starts), bool)
    while active.any():  # each document for as long as it gains itself, whatever it is batched with
        part *= (n / np.maximum(part.sum(1), 1e-30))[:, None]
        share[active] = (np.add.reduceat(part, starts, axis=0) / total)[active]
        part = like * share[owner]
        now = np.add.reduceat(n * np.log(np.maximum(part.sum(1), 1e-30)), starts)
        gain = now - fitted
        fitted[active] = now[active]
        active &= gain > GAIN + FLAT * np.abs(now)
    return share, fitted


def predict(texts: list[str | None], names: list[str], logp: np.ndarray, penalty: float = PENALTY) -> tuple[list[str], list[float]]:
    """(language, score) of each text."""
    out_lang, out_score = ["und"] * len(texts), [0.0] * len(texts)
    if not names:
        return out_lang, out_score
    grams = [(i, *trigram_counts(t)) for i, t in enumerate(texts)]
    grams = [g for g in grams if len(g[1])]
    for k in range(0, len(grams), 256):
        some = grams[k:k + 256]
        sizes = np.array([len(g[1]) for g in some])
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        owner = np.repeat(np.arange(len(some)), sizes)
        n = np.concatenate([g[2] for g in some]).astype(float)
        logs = logp[np.concatenate([g[1] for g in some])]
        logs = logs - logs.max(1, keepdims=True)
        like = np.exp(logs)
        single = np.add.reduceat(logs * n[:, None], starts, axis=0)
        share, full = _mixture(like, n, starts, owner, np.ones((len(some), len(names))))
        price = penalty * np.log1p(np.add.reduceat(n, starts))
        chosen, best = single.argmax(1), single.max(1)
        open_ = np.flatnonzero(full - price > best)
        rank = np.argsort(-share, axis=1, kind="stable")
        for size in range(2, len(names) + 1):
            if not len(open_):
                break
            mine = np.isin(owner, open_)
            sub_sizes = sizes[open_]
            sub_starts = np.concatenate([[0], np.cumsum(sub_sizes)[:-1]])
            sub_owner = np.repeat(np.arange(len(open_)), sub_sizes)
            allowed = np.zeros((len(open_), len(names)))
            np.put_along_axis(allowed, rank[open_, :size], 1.0, axis=1)
            part, fitted = _mixture(like[mine], n[mine], sub_starts, sub_owner, allowed)
            value = fitted - price[open_] * (size - 1)
            better = value > best[open_]
            best[open_[better]] = value[better]
            chosen[open_[better]] = part[better].argmax(1)
            open_ = open_[full[open_] - price[open_] * size > best[open_]]
        for j, (i, *_) in enumerate(some):
            out_lang[i] = names[chosen[j]]
            out_score[i] = float(min(1.0, max(0.0, share[j, chosen[j]])))
    return out_lang, out_score


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray], id_col: str = "doc_id", text_col: str = "text",
             penalty: float = PENALTY) -> DataFrame:
    """Per row: id, lang_pred, score."""
    names, logp = model

    @F.pandas_udf("lang_pred string, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            lang, score = predict(list(texts), names, logp, penalty)
            yield pd.DataFrame({"lang_pred": lang, "score": score})

    return pick(docs, id_col, text_col).select(F.col(id_col), run(F.col(text_col)).alias("r")).select(id_col, "r.*")
