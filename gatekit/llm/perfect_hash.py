"""A minimal perfect hash over distinct integers, in vectorised steps.

Level by level, keys are hashed into an array of ``SPREAD`` bits a key; a key alone on its
bit is placed, the others go on to the next, smaller level. A key's number is the count
of set bits before its own, over all levels: 0 to n - 1 without gaps, about 3.7 bits a
key. A key outside the set can get any number, so the keys are kept in the order of their
numbers and each answer is verified.
"""
from __future__ import annotations

import numpy as np

from gatekit.llm.textops import U, mix

SPREAD = 2.0
LEVELS = 64


class PerfectHash:
    def __init__(self, levels: list[np.ndarray], keys: np.ndarray):
        """``levels``: bits as 64-bit words. ``keys``: int64, in the order of their numbers."""
        self.levels, self.keys = levels, keys
        words = np.concatenate(levels) if levels else np.zeros(0, U)
        ones = np.bitwise_count(words).astype(np.int64)
        before = np.cumsum(ones) - ones
        starts = np.cumsum([0] + [len(x) for x in levels])
        self.before = [before[a:b] for a, b in zip(starts, starts[1:])]

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """Over distinct ``keys``; raises ValueError if one occurs twice."""
        left, levels = np.asarray(keys, np.int64), []
        while len(left):
            if len(levels) == LEVELS:
                raise ValueError("keys are not distinct")
            words = int(len(left) * SPREAD) // 64 + 1
            at = _place(left, len(levels), words)
            alone = np.bincount(at, minlength=words * 64) == 1
            levels.append(np.packbits(alone, bitorder="little").view(U))
            left = left[~alone[at]]
        out = cls(levels, np.empty(len(keys), np.int64))
        out.keys[out._number(np.asarray(keys, np.int64))] = keys
        return out

    def _number(self, x: np.ndarray) -> np.ndarray:
        out, todo = np.full(len(x), -1, np.int64), np.arange(len(x))
        for k, words in enumerate(self.levels):
            if not len(todo):
                break
            at = _place(x[todo], k, len(words))
            word, bit = words[at >> 6], (at & 63).astype(U)
            hit = (word >> bit) & U(1) == U(1)
            below = np.bitwise_count(word & ((U(1) << bit) - U(1)))
            out[todo[hit]] = (self.before[k][at >> 6] + below)[hit]
            todo = todo[~hit]
        return out

    def find(self, x: np.ndarray) -> np.ndarray:
        """The number of each key, verified; -1 for keys outside the set."""
        x = np.asarray(x, np.int64)
        at = self._number(x)
        if len(self.keys):
            at[(at >= 0) & (self.keys[at] != x)] = -1
        return at

    def dump(self) -> bytes:
        """Level sizes, bits, keys."""
        head = np.array([len(self.levels), *map(len, self.levels), len(self.keys)], np.int64)
        return b"".join([head.tobytes(), *(x.tobytes() for x in self.levels), self.keys.tobytes()])

    @classmethod
    def load(cls, raw: bytes) -> PerfectHash:
        n = int(np.frombuffer(raw, np.int64, 1)[0])
        sizes = np.frombuffer(raw, np.int64, n + 1, 8)
        at, levels = 8 * (n + 2), []
        for size in sizes[:-1].tolist():
            levels.append(np.frombuffer(raw, U, size, at))
            at += 8 * size
        return cls(levels, np.frombuffer(raw, np.int64, int(sizes[-1]), at))


def _place(x: np.ndarray, level: int, words: int) -> np.ndarray:
    h = mix(x.astype(U) + U((level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
    return (h % U(words * 64)).astype(np.int64)
