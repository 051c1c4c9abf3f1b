"""Byte-level BPE by tree reduction.

A text is encoded in halves, down to leaves, and neighbours are joined. The tokens of a half are those it has
on its own; at a join they may be wrong around the middle only. So a window around the middle grows on both
sides until it ends at places where tokens outside provably stay, and what lies inside is encoded anew. Ids
are decoded up the same kind of tree: each half to its bytes, neighbours joined.

Two proofs say where a window may end.

Between pieces of the pre-tokenizer. Its pattern takes white space only at the start of a piece or in a piece
of white space alone, and holds letters, numbers and other signs apart but for an apostrophe before letters. So
there is always a cut between a character that isn't white space and white space, and between letters, numbers
and other signs, unless the first is an apostrophe. No alternative looks behind, and the one that looks ahead
looks from white space only, so neither side of such a cut depends on the other. Characters count here only if
the oldest and the newest Unicode tables at hand agree on them: of others, nothing is assumed.

Inside a piece longer than a leaf, which is encoded by halves of its bytes. Merging takes the lowest rank
first, the leftmost among equals. If some merge crossed from a token into the next, the first of these would be
made as well if the two were encoded alone, since up to then each of them merges as it does alone. So a
sequence of tokens is a piece's encoding exactly if each two neighbours, encoded together, stay as they are;
and a window may end wherever this holds for the tokens on its two sides.

Null and empty texts have no tokens and decode to the empty text. Texts of any length are cut into leaves; a
leaf's work is bounded, a window's is the distance to the next sure place. No string is a special token. Repeated
rows give repeated results; extra columns are ignored.
"""

from __future__ import annotations

import base64
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.common import pick

LEAF = 1024  # characters of a text, or bytes of a piece, that are encoded without a cut
WINDOW = 8  # tokens on each side of a middle that a window inside a piece starts with
AT_ONCE = 200  # texts whose ids a task holds before it hands them on


@lru_cache(maxsize=1 << 16)
def kind(sign: str) -> str:
    """L letter, N number, S white space, O other, ? if the tables differ."""
    old, new = unicodedata.ucd_3_2_0.category(sign), unicodedata.category(sign)
    if old[0] != new[0] or old in ("Cn", "Cs", "Co"):
        return "?"
    if sign in "\t\n\x0b\x0c\r \x85" or new[0] == "Z":
        return "S" if sign != "᠎" else "?"
    if "\x1c" <= sign <= "\x1f":
        return "?"  # separators in some tables, white space in others
    return new[0] if new[0] in "LN" else "O"


def sure(text: str, p: int) -> bool:
    """Whether the pre-tokenizer cuts between characters p - 1 and p whatever stands around them."""
    before, after = kind(text[p - 1]), kind(text[p])
    if "?" in (before, after) or before == after or before == "S":
        return False
    return not (text[p - 1] == "'" and after == "L")


class TreeCoder:
    """Encodes and decodes by the ranks of a tiktoken file and its pattern."""

    def __init__(self, path: str, pattern: str, leaf: int = LEAF, window: int = WINDOW):
        import tiktoken

        self.ranks = ranks_of(path)
        self.enc = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=self.ranks, special_tokens={})
        self.bytes_of = {i: b for b, i in self.ranks.items()}
        self.pattern, self.leaf, self.window = pattern, max(leaf, 2), max(window, 1)
        self.stays = lru_cache(maxsize=1 << 16)(self._stays)

    # texts

    def encode(self, text: str) -> list[int]:
        if len(text) <= self.leaf:
            return self.enc.encode_ordinary(text)
        mid = len(text) // 2
        first, last = self._text_window(text, mid)
        if last - first > self.leaf:  # one piece, but for a few characters: nothing to gain from halves of it
            return self.encode(text[:first]) + self._long(text[first:last]) + self.encode(text[last:])
        left, right = self.encode(text[:mid]), self.encode(text[mid:])
        self._drop(left, len(text[first:mid].encode("utf-8", "surrogatepass")), -1)
        self._drop(right, len(text[mid:last].encode("utf-8", "surrogatepass")), 0)
        return left + self.enc.encode_ordinary(text[first:last]) + right

    def _text_window(self, text: str, mid: int) -> tuple[int, int]:
        """The nearest sure places around ``mid``, or the text's ends."""
        if sure(text, mid):
            return mid, mid
        first, last = mid, mid
        while first > 0 and not (first < mid and sure(text, first)):
            first -= 1
        while last < len(text) and not (last > mid and sure(text, last)):
            last += 1
        return first, last

    def _drop(self, ids: list[int], n_bytes: int, end: int) -> None:
        """Take tokens of ``n_bytes`` bytes off the end (-1) or the start (0) of ``ids``."""
        count = 0
        while n_bytes > 0:
            n_bytes -= len(self.bytes_of[ids[-1 - count if end else count]])
            count += 1
        if n_bytes:
            raise AssertionError("a sure place isn't a token's end")
        if count:
            del ids[len(ids) - count if end else 0:len(ids) if end else count]

    def _long(self, text: str) -> list[int]:
        """A stretch without sure places: its few pieces, the long ones by halves of their bytes."""
        out: list[int] = []
        for piece in _pieces(self.pattern, text):
            data = piece.encode("utf-8", "surrogatepass")
            out += self.enc.encode_ordinary(piece) if len(data) <= self.leaf else self.merge(data)
        return out

    # pieces

    def plain(self, data: bytes) -> list[int]:
        """Merged tokens of bytes inside a piece: unlike a piece that is a token, they get no short cut."""
        if data not in self.ranks:
            return self.enc._encode_single_piece(data)
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, i = min((self.ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == 1 << 60:
                break
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def _stays(self, a: int, b: int) -> bool:
        return self.plain(self.bytes_of[a] + self.bytes_of[b]) == [a, b]

    def merge(self, data: bytes) -> list[int]:
        """Tokens of the bytes of one piece."""
        if len(data) <= self.leaf:
            return self.plain(data)
        mid = len(data) // 2
        left, right = self.merge(data[:mid]), self.merge(data[mid:])
        if self.stays(left[-1], right[0]):
            return left + right
        w = self.window
        while True:
            a, b = max(len(left) - w, 0), min(w, len(right))
            inner = self.plain(b"".join(self.bytes_of[i] for i in left[a:] + right[:b]))
            holds_left = a == 0 or self.stays(left[a - 1], inner[0])
            holds_right = b == len(right) or self.stays(inner[-1], right[b])
            if holds_left and holds_right:
                return left[:a] + inner + right[b:]
            w *= 2

    # back

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= self.leaf:
            return b"".join([self.bytes_of[i] for i in ids])
        mid = len(ids) // 2
        return self.decode(ids[:mid]) + self.decode(ids[mid:])


@lru_cache(maxsize=2)
def ranks_of(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def _pieces(pattern: str, text: str) -> Iterator[str]:
    import regex

    for m in regex.finditer(pattern, text):
        yield m.group()


def encode_texts(
    docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True,
) -> DataFrame:
    """Per row: id, n_tokens, ids (array<int>, if wanted), ids_sha256 (of the decimal ids joined by one space)
    and decoded_sha256 (of the decoded bytes). ``ranks`` is a tiktoken file, readable on every executor; it
    holds each single byte. ``pattern`` is the byte-level pre-tokenizer's that the proofs above are about."""

    ids_type = "ids array<int>, " if with_ids else ""

    @F.pandas_udf(f"n_tokens long, {ids_type}ids_sha256 string, decoded_sha256 string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        from hashlib import sha256

        coder = TreeCoder(ranks, pattern)
        for batch in batches:
            for at in range(0, len(batch), AT_ONCE):
                out: list[tuple] = []
                for text in batch.iloc[at:at + AT_ONCE]:
                    ids = coder.encode(text or "")
                    digest = sha256(" ".join(map(str, ids)).encode()).hexdigest()
                    out.append((len(ids), *([ids] if with_ids else []), digest, sha256(coder.decode(ids)).hexdigest()))
                yield pd.DataFrame(out, columns=["n_tokens", *(["ids"] if with_ids else []), "ids_sha256", "decoded_sha256"])

    return pick(docs, id_col, text_col).select(F.col(id_col), run(F.col(text_col)).alias("r")).select(id_col, "r.*")
