"""A double-array trie over sequences of small integers.

A state's child by symbol c stands at ``base[state] + c`` if ``check`` says that this
state owns that place. State 0 is the root. ``depth``, ``order`` and the traversal work on
whole arrays; only packing goes node by node.
"""
from __future__ import annotations

import numpy as np

_FREE = -1


class DoubleArray:
    def __init__(self, base: np.ndarray, check: np.ndarray):
        self.base, self.check = base, check

    @classmethod
    def build(cls, sequences: list[list[int]]) -> DoubleArray:
        """Over sequences of symbols from 0 on; repeated ones and beginnings of others may occur."""
        rows = sorted(sequences)
        base, check = [0], [0]
        free = 1  # no place before it is free
        todo = [(0, 0, len(rows), 0)]
        while todo:
            state, lo, hi, depth = todo.pop()
            while lo < hi and len(rows[lo]) == depth:
                lo += 1
            if lo == hi:
                continue
            kids, at = [], lo
            while at < hi:
                c, start = rows[at][depth], at
                at += 1
                while at < hi and rows[at][depth] == c:
                    at += 1
                kids.append((c, start, at))
            while free < len(check) and check[free] != _FREE:
                free += 1
            symbols = [c for c, _, _ in kids]
            first, end = symbols[0], len(check)
            # many children: behind everything; few: the first place where all fit
            place = free if len(kids) <= 4 else end
            while any(place + c - first < end and check[place + c - first] != _FREE for c in symbols):
                place += 1
            if (need := place + symbols[-1] - first + 1) > end:
                base += [0] * (need - end)
                check += [_FREE] * (need - end)
            base[state] = place - first
            for c, start, stop in kids:
                check[place + c - first] = state
                todo.append((place + c - first, start, stop, depth + 1))
        check[0] = _FREE
        return cls(np.array(base, np.int64), np.array(check, np.int64))

    def step(self, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """The states behind ``states`` by ``symbols``; -1 where there is none."""
        to = self.base[states] + symbols
        there = (to > 0) & (to < len(self.check)) & (states >= 0)
        there[there] = self.check[to[there]] == states[there]
        return np.where(there, to, -1)
