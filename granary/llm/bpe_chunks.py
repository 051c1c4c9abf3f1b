"""Byte-level BPE by content-defined chunks.

A text is cut where a rolling hash of its bytes says so, so that equal passages of different
documents give equal chunks. A chunk is encoded once for each task and kept in a bounded cache.
Chunks are cut without regard to word ends, so the tokens at a join may be wrong: the join is
repaired by encoding a stretch across it, widened until it starts and ends at places where the
pre-tokenizer must cut anyway and the chunk's own tokens have a boundary. Outside these stretches
the chunk's tokens are the text's tokens.

Why such a place is sure: the pre-tokenizer's pattern takes a space only at the start of a piece, so
between a character that isn't white space and a space followed by a letter there's always a cut, and
what comes after the cut doesn't depend on what came before.

Null and empty texts have no tokens and decode to the empty text. A text without any sure place is
encoded whole. Special tokens' strings get their ids, as in the tokenizers library. Repeated rows
give repeated results; extra columns are ignored.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.common import pick

CHUNK_BYTES = 2048  # mean size; a power of two
CACHE_BYTES = 4 << 20  # of chunk text; the cache starts anew beyond it
AT_ONCE = 200  # texts whose ids a task holds before it hands them on
WINDOW = 16
LETTERS_BELOW = chr(0x530)  # Latin, Greek and Cyrillic: letters in every version of Unicode

@lru_cache(maxsize=2)
def codec(path: str):
    """(encoder of ordinary text, bytes by id, special tokens by string) of a tokenizers file."""
    import json

    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    # the printable stand-ins that byte-level BPE files use for bytes
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    signs = {chr(b): b for b in plain}
    signs |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ranks = {bytes(signs[c] for c in k): v for k, v in spec["model"]["vocab"].items() if k not in special}
    #: the fixed pattern of the byte-level pre-tokenizer
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    enc = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    table = [b""] * (1 + max([*ranks.values(), *special.values()]))
    for k, v in ranks.items():
        table[v] = k
    for k, v in special.items():
        table[v] = k.encode()
    return enc, table, special


_GEAR = (np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)


def cuts(data: bytes, mean: int = CHUNK_BYTES) -> list[int]:
    """Ends of chunks: where the sum of the last WINDOW bytes' random values, mixed, is divisible by
    ``mean``; then moved to the next character's start."""
    if len(data) <= 2 * WINDOW:
        return [len(data)] if data else []
    raw = np.frombuffer(data, np.uint8)
    total = np.cumsum(_GEAR[raw], dtype=np.uint64)
    rolled = (total[WINDOW:] - total[:-WINDOW]) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(32)
    at = np.flatnonzero((rolled & np.uint64(mean - 1)) == 0) + WINDOW + 1
    out = []
    for p in at.tolist():
        while p < len(data) and data[p] & 0xC0 == 0x80:
            p += 1
        if p < len(data) and (not out or p > out[-1]):
            out.append(p)
    return [*out, len(data)]


def _sure(text: str, p: int) -> bool:
    after = text[p + 1:p + 2]
    return not text[p - 1].isspace() and after.isalpha() and after < LETTERS_BELOW


def _first_sure(text: str) -> int:
    p = text.find(" ", 1)
    while p > 0 and not _sure(text, p):
        p = text.find(" ", p + 1)
    return p


def _last_sure(text: str) -> int:
    p = text.rfind(" ", 1)
    while p > 0 and not _sure(text, p):
        p = text.rfind(" ", 1, p)
    return p


class ChunkEncoder:
    """Encodes ordinary text (no special tokens) by cached chunks."""

    def __init__(self, enc, table: list[bytes], mean: int = CHUNK_BYTES):
        self.enc, self.mean = enc, mean
        self.length = [len(b) for b in table]
        self.cache: dict[bytes, tuple] = {}
        self.held = 0

    def plain(self, text: str) -> np.ndarray:
        return np.array(self.enc.encode_ordinary(text), np.int32)

    def chunk(self, data: bytes) -> tuple:
        """(ids, first sure place, last sure place, tokens before each); the places are -1 if there are
        none, or if the chunk's own tokens have no boundary at them."""
        got = self.cache.get(data)
        if got is None:
            text = data.decode("utf-8")
            ids = self.plain(text)
            got = (ids, -1, -1, 0, 0)
            p, q = _first_sure(text), _last_sure(text)
            if p > 0:
                first = len(text[:p].encode("utf-8"))
                last = len(data) - len(text[q:].encode("utf-8"))
                k, at = 0, 0
                while at < first:
                    at, k = at + self.length[ids[k]], k + 1
                j, to = len(ids), len(data)
                while to > last:
                    j -= 1
                    to -= self.length[ids[j]]
                if at == first and to == last:
                    got = (ids, first, last, k, j)
            if self.held > CACHE_BYTES:
                self.cache, self.held = {}, 0
            self.cache[data] = got
            self.held += len(data)
        return got

    def encode(self, text: str) -> list[np.ndarray]:
        """The text's ids, in parts."""
        data = text.encode("utf-8")
        out: list[np.ndarray] = []
        start, done = 0, 0  # chunk's start; bytes whose tokens are in out
        for end in cuts(data, self.mean):
            ids, first, last, k_first, k_last = self.chunk(data[start:end])
            if first >= 0:  # else the open stretch runs on into the next chunk
                if start == 0:
                    out.append(ids[:k_last])
                else:
                    out.append(self.plain(data[done:start + first].decode("utf-8")))
                    out.append(ids[k_first:k_last])
                done = start + last
            start = end
        if done < len(data):
            out.append(self.plain(data[done:].decode("utf-8")))
        return out


def encoder(path: str, mean: int = CHUNK_BYTES):
    """text -> ids (int32), exactly as the tokenizers library without added special tokens."""
    enc, table, special = codec(path)
    chunks = ChunkEncoder(enc, table, mean)
    marks = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None

    def encode(text: str | None) -> np.ndarray:
        parts: list[np.ndarray] = [np.empty(0, np.int32)]
        if text and (marks is None or not any(s in text for s in special)):
            parts += chunks.encode(text)
        elif text:
            for part in marks.split(text):
                parts += [np.array([special[part]], np.int32)] if part in special else chunks.encode(part) if part else []
        return np.concatenate(parts)

    return encode


def encode_texts(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """Per row: id, n_tokens, ids (array<int>, if wanted), ids_sha256 (of the decimal ids joined by
    commas) and decoded_sha256 (of the ids' bytes joined, which is the decoded text in UTF-8).
    ``vocabulary`` is a byte-level BPE file of the tokenizers library, readable on every executor."""

    ids_type = "ids array<int>, " if with_ids else ""

    @F.pandas_udf(f"n_tokens long, {ids_type}ids_sha256 string, decoded_sha256 string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        from hashlib import sha256

        encode = encoder(vocabulary)
        table = codec(vocabulary)[1]
        names = [str(i) for i in range(len(table))]
        for batch in batches:
            for at in range(0, len(batch), AT_ONCE):
                out: dict[str, list] = {"n_tokens": [], **({"ids": []} if with_ids else {}), "ids_sha256": [], "decoded_sha256": []}
                for t in batch.iloc[at:at + AT_ONCE]:
                    ids = encode(t)
                    plain = ids.tolist()
                    out["n_tokens"].append(len(plain))
                    if with_ids:
                        out["ids"].append(ids)
                    out["ids_sha256"].append(sha256(",".join(map(names.__getitem__, plain)).encode()).hexdigest())
                    out["decoded_sha256"].append(sha256(b"".join(map(table.__getitem__, plain))).hexdigest())
                yield pd.DataFrame(out)

    return pick(docs, id_col, text_col).select(F.col(id_col), run(F.col(text_col)).alias("r")).select(id_col, "r.*")
