"""An FM-index over a sequence of word ids: backward search and sampled locating."""

from __future__ import annotations

import numpy as np


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Start positions of the suffixes in order, by prefix doubling. Each 0 ends what stands before it and differs from every other 0."""
    n = len(text)
    ends = text == 0
    rank = np.where(ends, np.cumsum(ends) - 1, text.astype(np.int64) + int(ends.sum()))
    step = 1
    while True:
        ahead = np.zeros(n, dtype=np.int64)
        ahead[: n - step] = rank[step:] + 1
        key = rank * (int(rank.max()) + 2) + ahead
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        fresh = np.empty(n, dtype=np.int64)
        fresh[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        if fresh[order[-1]] == n - 1 or step >= n:
            return order
        rank, step = fresh, step * 2


class WaveletMatrix:
    """Ranks of symbols in prefixes of a sequence: a bit plane per level, the zeros of each moved ahead of its ones."""

    def __init__(self, values: np.ndarray, bits: int):
        self.bits, self.ones, self.zeros = bits, [], []
        rest = values
        for level in range(bits - 1, -1, -1):
            plane = (rest >> level) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(plane)]).astype(np.int32))
            self.zeros.append(int(len(rest) - plane.sum()))
            rest = np.concatenate([rest[plane == 0], rest[plane == 1]])

    def rank(self, symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """How often each symbol occurs in the first ``ends`` values."""
        low, high = np.zeros_like(ends), ends
        for i, level in enumerate(range(self.bits - 1, -1, -1)):
            one = (symbols >> level) & 1 == 1
            low1, high1 = self.ones[i][low], self.ones[i][high]
            low = np.where(one, self.zeros[i] + low1, low - low1)
            high = np.where(one, self.zeros[i] + high1, high - high1)
        return high - low


class FMIndex:
    """Finds phrases in ``text``: ids from 1, and 0 after each stretch (the last value is 0)."""

    def __init__(self, text: np.ndarray, rate: int = 8):
        n, top = len(text), int(text.max())
        order = suffix_order(text)
        self.last = text[order - 1]  # what stands before each suffix; before the first stands the final 0
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=top + 1))])
        self.tree = WaveletMatrix(self.last, max(1, top.bit_length()))
        first = np.concatenate([[True], text[:-1] == 0])
        sampled = (first | (np.arange(n) % rate == 0))[order]
        self.sampled, self.nth = sampled, np.cumsum(sampled) - 1
        self.samples = order[sampled]
        self.top = top

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffix range [low, high) of each phrase (rows padded with 0), read from its last word to its first."""
        low = np.zeros(len(phrases), dtype=np.int64)
        high = np.full(len(phrases), len(self.last), dtype=np.int64)
        high[(phrases > self.top).any(axis=1)] = 0
        for back in range(1, int(lengths.max(initial=0)) + 1):
            live = np.flatnonzero((lengths >= back) & (high > low))
            if not len(live):
                break
            word = phrases[live, lengths[live] - back]
            low[live] = self.before[word] + self.tree.rank(word, low[live])
            high[live] = self.before[word] + self.tree.rank(word, high[live])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows: step back to a sampled one and count the steps."""
        rows, out = rows.copy(), np.zeros(len(rows), dtype=np.int64)
        todo, steps = np.arange(len(rows)), 0
        while len(todo):
            found = self.sampled[rows[todo]]
            hit = todo[found]
            out[hit] = self.samples[self.nth[rows[hit]]] + steps
            todo = todo[~found]
            word = self.last[rows[todo]]
            rows[todo] = self.before[word] + self.tree.rank(word, rows[todo])
            steps += 1
        return out
