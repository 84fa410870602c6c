"""Counts over the tokens of one prediction and its references.

Both texts are in the row, so the counts need no shuffle. They are Arrow-batched
UDFs: as higher-order functions (sort and fold, or set intersections) the gram
counts measured two to three times slower, as exploded grams about three times
slower with a shuffle on top, and the subsequence length has no built-in form.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from proseframe.functions.stem import stemmed

#: tokens counted together; a row is never cut
TOKENS = 60_000
#: characters of texts that are tokenised together; a row is never cut
CHARS = 400_000


def _some_rows(*sides: pa.Array) -> Iterator[tuple[list, ...]]:
    """The values of some rows at a time, with about CHARS characters in all: no more than these are ever Python objects."""
    sizes = np.zeros(len(sides[0]), dtype=np.int64)
    for side in sides:
        if pa.types.is_list(side.type):  # of lines: their sum by row
            ends = np.concatenate([[0], np.cumsum(_lengths(side.flatten()))])
            at = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(side), 0).to_numpy(zero_copy_only=False))])
            sizes += ends[at[1:]] - ends[at[:-1]]
        else:
            sizes += _lengths(side)
    held = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        before = held[start - 1] if start else 0
        end = max(int(np.searchsorted(held, before + CHARS, side="right")), start + 1)
        yield tuple(side.slice(start, end - start).to_pylist() for side in sides)
        start = end


def _lengths(lines: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.binary_length(lines), 0).to_numpy(zero_copy_only=False)


def _together(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """[start, end) of rows with about TOKENS tokens."""
    start = held = 0
    for i, n in enumerate(sizes):
        held += n
        if held >= TOKENS:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(sizes):
        yield start, len(sizes)


def _overlaps(predictions: list[list[str]], references: list[list[list[str]]], order: int) -> np.ndarray:
    """See :func:`clipped_overlaps`, for some rows.

    Grams get numbers that tell rows apart: a gram's is that of the pair (gram
    one token shorter, last token), so every order is one sort of whole arrays.
    """
    rows = len(predictions)
    texts = [*predictions, *chain.from_iterable(references)]
    text_row = np.concatenate([np.arange(rows), np.repeat(np.arange(rows), [len(r) for r in references])])
    text_side = np.concatenate([np.full(rows, -1), *[np.arange(len(r)) for r in references]]).astype(np.int64)
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    known: defaultdict[str, int] = defaultdict(count().__next__)
    token = np.fromiter(map(known.__getitem__, chain.from_iterable(texts)), dtype=np.int64, count=int(sizes.sum()))
    text = np.repeat(np.arange(len(texts)), sizes)
    row, side = text_row[text], text_side[text]
    out = np.zeros((rows, order), dtype=np.int64)
    if not len(token):
        return out
    one = np.unique(row * len(known) + token, return_inverse=True)[1]
    width, at, gram = int(one.max()) + 1, np.arange(len(token)), one
    for n in range(order):
        if n:
            on = at + n < len(token)
            on[on] = text[at[on] + n] == text[at[on]]
            at = at[on]
            gram = np.unique(gram[on] * width + one[at + n], return_inverse=True)[1]
        grams = int(gram.max()) + 1 if len(gram) else 0
        given = np.zeros(grams, dtype=np.int64)
        for k in range(int(text_side.max()) + 1):
            given = np.maximum(given, np.bincount(gram[side[at] == k], minlength=grams))
        owner = np.zeros(grams, dtype=np.int64)
        owner[gram] = row[at]
        matched = np.minimum(np.bincount(gram[side[at] < 0], minlength=grams), given)
        out[:, n] = np.bincount(owner, weights=matched, minlength=rows)
    return out


def clipped_overlaps(predictions: list[list[str]], references: list[list[list[str]]], order: int) -> np.ndarray:
    """(rows, order): for grams of 1 to ``order`` tokens how many a prediction shares with its references.

    Each gram counts as often as in the prediction, at most as often as in the reference that holds it most.
    """
    sizes = [len(p) + sum(map(len, r)) for p, r in zip(predictions, references)]
    parts = [_overlaps(predictions[a:b], references[a:b], order) for a, b in _together(sizes)]
    return np.concatenate(parts) if parts else np.zeros((0, order), dtype=np.int64)


def lcs_length(a: list[str], b: list[str]) -> int:
    """Longest common subsequence, bit-parallel: one big-integer step per token of ``a``."""
    where: dict[str, int] = {}
    for i, token in enumerate(b):
        where[token] = where.get(token, 0) | (1 << i)
    full = (1 << len(b)) - 1
    free = full
    for token in a:
        hit = free & where.get(token, 0)
        if hit:
            free = ((free + hit) | (free - hit)) & full
    return len(b) - free.bit_count()


def closest_length(n: int, lengths: list[int]) -> int:
    """The length nearest to n; of two equally near the shorter."""
    return min(lengths, key=lambda k: (abs(k - n), k))


def rouge_counts_udf(orders: list[int], with_lcs: bool, use_stemmer: bool):
    """(prediction line, reference line) to [tokens, tokens, overlap per order, lcs]; null for a null text.

    A plain UDF like the one below: two of that kind share one Python step, iterators never do.
    """
    def counted(lefts: list, rights: list) -> list:
        sides = [[[] if line is None else line.split() for line in lines] for lines in (lefts, rights)]
        if use_stemmer:
            sides = [[stemmed(tokens) for tokens in side] for side in sides]
        shared = clipped_overlaps(sides[0], [[r] for r in sides[1]], max(orders, default=1))
        out = []
        for i, (left, right, p, r) in enumerate(zip(lefts, rights, *sides)):
            if left is None or right is None:
                out.append(None)
                continue
            found = [len(p), len(r)] + [int(shared[i, n - 1]) for n in orders]
            out.append(found + [lcs_length(p, r)] if with_lcs else found)
        return out

    @F.arrow_udf("array<int>")
    def counts(predictions: pa.Array, references: pa.Array) -> pa.Array:
        return pa.array(chain.from_iterable(counted(*some) for some in _some_rows(predictions, references)), type=pa.list_(pa.int32()))

    return counts


def bleu_counts_udf(max_order: int):
    """(prediction line, reference lines) to [tokens, closest reference length, matches per order]."""
    def counted(lines: list, references: list) -> list:
        given = [[] if given is None else [x.split() for x in given if x is not None] for given in references]
        mine = [[] if line is None else line.split() for line in lines]
        shared = clipped_overlaps(mine, given, max_order)
        out = []
        for line, p, refs, matches in zip(lines, mine, given, shared.tolist()):
            out.append(None if line is None or not refs else [len(p), closest_length(len(p), [len(r) for r in refs]), *matches])
        return out

    @F.arrow_udf("array<bigint>")
    def counts(predictions: pa.Array, references: pa.Array) -> pa.Array:
        return pa.array(chain.from_iterable(counted(*some) for some in _some_rows(predictions, references)), type=pa.list_(pa.int64()))

    return counts
