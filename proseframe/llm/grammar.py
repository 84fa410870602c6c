"""Re-Pair: a sequence of numbers as a grammar of pairs, many pairs a round.

Classic Re-Pair replaces the most frequent pair, one pair at a time. Here each
round ranks all pairs and replaces an occurrence wherever no better-ranked pair
overlaps it, so the work of a round is a few sorts of whole arrays and their
number grows with the depth of the grammar.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np


class Grammar(NamedTuple):
    """Symbols below ``first`` stand for themselves; symbol ``first + i`` derives ``left[i]`` then ``right[i]``.

    ``roots`` are the symbols that derive the texts, one for each text of at least one symbol.
    """

    first: int
    left: np.ndarray
    right: np.ndarray
    lengths: np.ndarray
    roots: np.ndarray


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0]+1, ... ``counts[0]`` times, then the same for the next."""
    return np.repeat(starts - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(int(counts.sum()))


def _occurrences(seq: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Where pairs start: inside one text, and of overlapping equal pairs (``aaa``) every second one."""
    inside = text[1:] == text[:-1]
    twin = inside & (seq[1:] == seq[:-1])
    at = np.arange(len(twin))
    before = np.maximum.accumulate(np.where(twin, -1, at)) if len(at) else at
    return np.flatnonzero(inside & (~twin | ((at - before) % 2 == 1)))


def _round(seq: np.ndarray, text: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray] | None:
    """Positions to replace and the number of each one's pair among the pairs replaced; None if no pair repeats."""
    at = _occurrences(seq, text)
    pairs, kind, counts = np.unique(seq[at] * base + seq[at + 1], return_inverse=True, return_counts=True)
    if not len(pairs) or counts.max() < 2:
        return None
    rank = np.empty(len(pairs), dtype=np.int64)
    rank[np.argsort(-counts, kind="stable")] = np.arange(len(pairs))
    never = len(pairs)
    mine = np.where(counts[kind] > 1, rank[kind], never)
    every = np.full(len(seq) + 2, never, dtype=np.int64)
    every[at + 1] = mine
    best = (mine < never) & (mine < every[at]) & (mine < every[at + 2])
    chosen = np.bincount(kind[best], minlength=len(pairs))
    best &= chosen[kind] > 1  # the best-ranked pair is chosen at each of its occurrences, so a round never stalls
    return at[best], np.unique(kind[best], return_inverse=True)[1]


def repair(seq: np.ndarray, text: np.ndarray) -> Grammar:
    """A grammar for ``seq``, whose places belong to the texts numbered in ``text`` (ascending).

    Pairs never cross texts; texts share the grammar's symbols. When no pair
    repeats, what is left of each text is halved into one tree.
    """
    seq, text = np.array(seq, dtype=np.int64), np.asarray(text, dtype=np.int64)
    first = base = int(seq.max()) + 1 if len(seq) else 0
    lefts, rights = [], []

    def replace(at: np.ndarray, which: np.ndarray) -> None:
        nonlocal seq, text, base
        some = np.zeros(int(which.max()) + 1, dtype=np.int64)
        some[which] = at
        lefts.append(seq[some])
        rights.append(seq[some + 1])
        seq[at] = base + which
        base += len(some)
        keep = np.ones(len(seq), dtype=bool)
        keep[at + 1] = False
        seq, text = seq[keep], text[keep]

    while (found := _round(seq, text, base)) is not None:
        replace(*found)
    while len(seq) and (text[1:] == text[:-1]).any():
        start = np.maximum.accumulate(np.where(np.concatenate([[True], text[1:] != text[:-1]]), np.arange(len(text)), 0))
        at = np.flatnonzero((text[1:] == text[:-1]) & ((np.arange(len(text) - 1) - start[:-1]) % 2 == 0))
        replace(at, np.arange(len(at)))
    left = np.concatenate(lefts) if lefts else np.zeros(0, dtype=np.int64)
    right = np.concatenate(rights) if rights else np.zeros(0, dtype=np.int64)
    lengths = np.ones(base, dtype=np.int64)
    low = first
    for a, b in zip(lefts, rights):
        lengths[low : low + len(a)] = lengths[a] + lengths[b]
        low += len(a)
    return Grammar(first, left, right, lengths, seq)


def derivations(grammar: Grammar, starts: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(symbol, position) of each place that derives at least ``least`` symbols, the roots standing at ``starts``."""
    symbols, places = grammar.roots, np.asarray(starts, dtype=np.int64)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    while True:
        large = (grammar.lengths[symbols] >= least) & (symbols >= grammar.first)
        symbols, places = symbols[large], places[large]
        if not len(symbols):
            break
        found.append((symbols, places))
        a, b = grammar.left[symbols - grammar.first], grammar.right[symbols - grammar.first]
        symbols, places = np.concatenate([a, b]), np.concatenate([places, places + grammar.lengths[a]])
    if not found:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return tuple(np.concatenate(x) for x in zip(*found))
