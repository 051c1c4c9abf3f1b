"""Keys of 64-bit fingerprints from the perfect binary Golay code (23, 12, 7).

Every 23-bit word lies within 3 bits of exactly one codeword, so "decode" names one of 4096
codewords. ``near(v)`` is the set of codewords that v or any one-bit change of v decodes to: one
codeword when v lies within 2 bits of it, six when it lies 3 bits away.

* Words 1 bit apart: each one's own codeword is in the other's ``near`` set.
* Words 2 bits apart: the word between them decodes into both ``near`` sets.

A fingerprint is cut into segments of 23, 23 and 18 bits, and at most 4 bits differ in all:

* If a segment X is equal, another one, Y, differs in at most 2 bits. Keys: X itself with each of
  ``near(Y)``, for all six ordered pairs; about 32 keys of 30 or 35 bits.
* If all three differ, two of them differ in one bit and the third in one or two. Keys: a codeword of
  each segment, ``decode`` of one and ``near`` of the other two; about 69 keys of 36 bits. (Let X and Y
  differ in one bit: both sides have decode of one's X, decode of the other's Y and a codeword that is
  in both ``near`` sets of the third.)

So any two fingerprints within 4 bits share a key, and unrelated ones hardly ever do: among n random
fingerprints about 7e-8 n^2 pairs meet.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

MAX_BITS = 4
GENERATOR = 0xC75  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1, a fixed value of the code
SEGMENTS = ((0, 23), (23, 23), (46, 18))
PAIRS = ((0, 1), (0, 2), (1, 0), (1, 2), (2, 0), (2, 1))


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """parity by message; the error word by syndrome; by syndrome the six changes (of up to one bit,
    then decoded) that lead to the codewords nearby, repeated where there are fewer."""
    parity = np.zeros(4096, np.int64)
    for m in range(4096):
        rest = m << 11
        for bit in range(22, 10, -1):
            if rest >> bit & 1:
                rest ^= GENERATOR << (bit - 11)
        parity[m] = rest
    bits = [1 << i for i in range(23)]
    words = [0, *bits]
    words += [a | b for i, a in enumerate(bits) for b in bits[i + 1:]]
    words += [a | b | c for i, a in enumerate(bits) for j, b in enumerate(bits[i + 1:], i + 1)
              for c in bits[j + 1:]]
    words = np.array(words, np.int64)
    syndrome = parity[words >> 11] ^ (words & 0x7FF)
    error = np.zeros(2048, np.int64)
    error[syndrome] = words  # perfect code: each syndrome has one word of weight 3 or less
    ones = np.array([0, *bits], np.int64)
    changes = np.zeros((2048, 6), np.int64)
    for s in range(2048):
        found = list(dict.fromkeys((ones ^ error[s ^ (parity[ones >> 11] ^ (ones & 0x7FF))]).tolist()))
        changes[s] = (found * 6)[:6] if len(found) < 6 else found[:6]
        assert len(found) <= 6
    return parity, error, changes


def decode(v: np.ndarray) -> np.ndarray:
    """The index (0 to 4095) of the codeword nearest to each 23-bit word."""
    parity, error, _ = _tables()
    return (v ^ error[parity[v >> 11] ^ (v & 0x7FF)]) >> 11


def near(v: np.ndarray) -> np.ndarray:
    """(n, 6): the codewords that v and its one-bit changes decode to; some repeat."""
    parity, _, changes = _tables()
    return (v[:, None] ^ changes[parity[v >> 11] ^ (v & 0x7FF)]) >> 11


def keys(fingerprints: np.ndarray) -> np.ndarray:
    """(n, 144) keys of 39 bits (kind, then an equal segment and a codeword index, or three codeword
    indices); some repeat in a row.

    >>> a = np.array([0x0123456789ABCDEF], np.uint64); b = a ^ np.uint64(0x8000000100000201)
    >>> bool(set(keys(a)[0]) & set(keys(b)[0]))
    True
    """
    parts = [(fingerprints >> np.uint64(at)).astype(np.int64) & ((1 << n) - 1) for at, n in SEGMENTS]
    own = [decode(p)[:, None] for p in parts]
    around = [near(p) for p in parts]
    out = [k << 36 | parts[x][:, None] << 12 | around[y] for k, (x, y) in enumerate(PAIRS)]
    for one in range(3):
        a, b, c = (own[i] if i == one else around[i] for i in range(3))
        three = a[:, :, None, None] << 24 | b[:, None, :, None] << 12 | c[:, None, None, :]
        out.append(len(PAIRS) << 36 | three.reshape(len(fingerprints), -1))
    return np.concatenate(out, axis=1)
