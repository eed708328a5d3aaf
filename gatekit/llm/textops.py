"""Vectorised word and shingle hashing over the bytes of many texts at once.

A step works on the concatenated UTF-8 bytes of some documents: one prefix sum of
``table[byte] * base**position`` gives the hash of any byte range by a subtraction,
so no Python object is made per word.
"""
from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np

U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: every input bit reaches every output bit."""
    x = x.astype(U, copy=True)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def _flags(*codes: int) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(codes)] = True
    return out


#: Word separators of the documents' contracts: blank, tab to carriage return.
SPACE = _flags(0x20, *range(0x09, 0x0E))
#: Everything in ASCII but letters (for bags of words); bytes of longer code points are letters.
NOT_LETTER = _flags(*(c for c in range(128) if not chr(c).isalpha()))


@lru_cache(maxsize=4)
def _table(lower: bool) -> np.ndarray:
    t = mix(np.arange(1, 257, dtype=U) * U(0xD1342543DE82EF95))
    if lower:
        t[65:91] = t[97:123]
    return t


def _power_table(base: int, n: int) -> np.ndarray:
    p = np.full(n, U(base))
    p[0] = 1
    return np.multiply.accumulate(p)


_powers: dict[int, np.ndarray] = {}


def _pow(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is not None and len(have) >= n:
        return have[:n]
    made = _power_table(base, max(n, 1 << 21) + 1)
    if n <= 1 << 22:  # tables for very long texts are not kept
        _powers[base] = made
    return made[:n]


_INVERSE = pow(_BASE, -1, 1 << 64)


@dataclass
class Words:
    """Words of a step: hash, byte range, and where each document's words begin."""

    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray  # len(docs) + 1; document d has words first[d]:first[d + 1]

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = False, separators: np.ndarray = SPACE) -> Words:
    """Maximal runs of non-separators inside each document."""
    n = len(data)
    offsets = np.asarray(offsets, np.int64)
    if n == 0:
        z = np.zeros(0, np.int64)
        return Words(z.astype(U), z, z, np.zeros(len(offsets), np.int64))
    word = ~separators[data]
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    ends = word.copy()
    ends[:-1] &= ~word[1:]
    cut = offsets[:-1][offsets[:-1] < n]
    begins[cut] = word[cut]
    last = offsets[1:][offsets[1:] > 0] - 1
    ends[last] = word[last]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    h = ranges(data, lower)(start, end)
    return Words(h, start, end, np.searchsorted(start, offsets))


def ranges(data: np.ndarray, lower: bool = False):
    """A function (starts, ends) -> hashes of these byte ranges."""
    total = np.zeros(len(data) + 1, U)
    np.cumsum(_table(lower)[data] * _pow(_BASE, len(data)), out=total[1:])
    back = _pow(_INVERSE, len(data) + 1)
    return lambda s, e: mix((total[e] - total[s]) * back[s] + (e - s).astype(U) * U(0xA0761D6478BD642F))


_FOLD = U(0xE7037ED1A0B428DB)


def fold(parts: list[np.ndarray]) -> np.ndarray:
    """Order-dependent hash of parallel sequences."""
    h = np.full(len(parts[0]), U(len(parts)))
    for p in parts:
        h = mix(h * _FOLD + p)
    return h


def shingles(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document) of each k-word window; a document with fewer words (but one
    at least) gives its whole sequence as one shingle."""
    doc, n = w.doc, np.diff(w.first)
    left = np.repeat(w.first[1:], n) - np.arange(len(w.hash))  # words to the document's end
    at = np.flatnonzero(left >= k)
    h = fold([w.hash[at + i] for i in range(k)]) if len(at) else np.zeros(0, U)
    hs, ds = [h], [doc[at]]
    for short in range(1, k):
        d = np.flatnonzero(n == short)
        if len(d):
            hs.append(fold([w.hash[w.first[d] + i] for i in range(short)]))
            ds.append(d)
    return np.concatenate(hs), np.concatenate(ds)


#: A step for sets holds fewer documents than this, so document and hash share 64 bits.
SET_DOCS = 1 << 10


def distinct_sets(h: np.ndarray, doc: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 54-bit hashes of each document, and where each document's begin."""
    key = np.unique((doc.astype(U) << U(54)) | (h >> U(10)))
    first = np.searchsorted(key, np.arange(docs + 1, dtype=U) << U(54)) if docs < SET_DOCS else np.append(
        np.searchsorted(key, np.arange(docs, dtype=U) << U(54)), len(key))
    return key & U((1 << 54) - 1), first
