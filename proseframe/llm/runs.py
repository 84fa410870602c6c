"""Periodic runs of words, found in a grammar of each document's repeated stretches."""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Callable, Iterator, Sequence
from itertools import chain, count

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proseframe.llm.batches import small_batches
from proseframe.llm.grammar import derivations, repair, spread

#: a run has at least so many words, and so many periods
LEAST, TIMES = 24, 3

Run = tuple[int, int, int]


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def context(least: int) -> int:
    """How many words next to each cut of a run surely agree with those one period away (see crossing_runs); a power of two."""
    return 1 << (max(1, least // (2 * TIMES)).bit_length() - 1)


def _agree(a: np.ndarray, b: np.ndarray) -> int:
    """How many values agree from the start on; looked at in doubling pieces."""
    n, at, piece = min(len(a), len(b)), 0, 32
    while at < n:
        differ = a[at : at + piece] != b[at : at + piece]
        if len(differ) > n - at:
            differ = differ[: n - at]
        k = int(differ.argmax())
        if differ[k]:
            return at + k
        at += len(differ)
        piece *= 2
    return n


def _interval(ids: np.ndarray, at: int, q: int, low: int, high: int) -> tuple[int, int]:
    """The stretch within [low, high) around ``at`` whose values agree with those ``q`` further on."""
    ahead = _agree(ids[at : high - q], ids[at + q : high])
    back = _agree(ids[low:at][::-1], ids[low + q : at + q][::-1])
    return at - back, at + q + ahead


def _grams(ids: np.ndarray, text: np.ndarray, size: int) -> np.ndarray:
    """A number for the ``size`` values from each place on; places too near their text's end get numbers of their own."""
    n = len(ids)
    gram = np.unique(ids, return_inverse=True)[1].astype(np.int64)
    width = 1
    while width < size:
        pair = gram[: n - width] * n + gram[width:]
        gram = np.unique(pair, return_inverse=True)[1].astype(np.int64) if len(pair) else pair
        gram = np.concatenate([gram, np.zeros(n - len(gram), dtype=np.int64)])
        width *= 2
    short = np.ones(n, dtype=bool)
    short[: max(0, n - size + 1)] = text[size - 1 :] != text[: n - size + 1]
    return np.where(short, n + np.arange(n), gram)


def repeated_stretches(ids: np.ndarray, text: np.ndarray, least: int = LEAST) -> np.ndarray:
    """[start, end) rows: stretches of at least ``least`` words each of whose grams of context() words occurs again in its text.

    Every word of a run of three periods lies in such a gram, one period before or after its repetition.
    """
    n = len(ids)
    if n < least:
        return np.zeros((0, 2), dtype=np.int64)
    gram = _grams(ids, text, context(least))
    order = np.lexsort((text, gram))
    same = (gram[order][1:] == gram[order][:-1]) & (text[order][1:] == text[order][:-1])
    again = np.zeros(n, dtype=bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    joined = again[1:] & again[:-1] & (text[1:] == text[:-1])
    start = np.flatnonzero(again & ~np.concatenate([[False], joined]))
    end = np.flatnonzero(again & ~np.concatenate([joined, [False]])) + context(least)
    long = end - start >= least
    return np.stack([start[long], end[long]], axis=1)


def crossing_runs(ids: np.ndarray, gram_order: tuple[np.ndarray, np.ndarray, np.ndarray], low: int, cut: int, high: int, least: int) -> list[Run]:
    """(start, end, period) of the periodic stretches within [low, high) around the cut at ``cut``.

    A run of TIMES periods has at least one and a half of them, and half of
    ``least``, on one side of the cut. There the words next to the cut agree
    with those one period away, context() of them at least: so only places where
    the cut's gram of so many words occurs again say what periods can be.
    """
    gram, keys, places = gram_order
    n, reach, size = len(gram), (high - low) // TIMES, context(least)
    found: list[Run] = []

    def others(at: int, first: int, last: int) -> np.ndarray:
        """Places of the same gram from ``first`` to ``last``."""
        i, j = np.searchsorted(keys, [gram[at] * 2 * n + first, gram[at] * 2 * n + last + 1])
        return places[i:j]

    candidates = [(int(x) - cut, cut) for x in others(cut, cut + 1, min(cut + reach, high - size))] if cut + size <= high else []
    if cut - size >= low:
        at = cut - size
        candidates += [(at - int(x), int(x)) for x in others(at, max(low, at - reach), at - 1)]
    for q, at in sorted(candidates):
        if any(q % p == 0 and s <= at and at + q < e and TIMES * q <= e - s for s, e, p in found):
            continue  # a multiple of a period found here: the same stretch
        start, end = _interval(ids, at, q, low, high)
        if end - start >= max(least, TIMES * q):
            found.append((start, end, q))
    return found


def _maximal(runs: np.ndarray) -> np.ndarray:
    """Stretches of one period that overlap by a period or more, joined; of equal stretches the smallest period stays."""
    runs = runs[np.lexsort((runs[:, 1], runs[:, 0], runs[:, 2]))]
    out: list[list[int]] = []
    for start, end, q in runs.tolist():
        if out and out[-1][2] == q and start + q <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end, q])
    least: dict[tuple[int, int], int] = {}
    for start, end, q in out:
        key = (start, end)
        least[key] = min(q, least.get(key, q))
    return np.array(sorted((s, e, q) for (s, e), q in least.items()), dtype=np.int64).reshape(-1, 3)


def runs_of(ids: np.ndarray, text: np.ndarray, least: int = LEAST) -> np.ndarray:
    """(start, end, period) rows of all runs of the texts that ``text`` (ascending numbers) tells apart.

    A run is a stretch of smallest period q with at least ``least`` words and
    TIMES periods that no neighbouring word extends. The repeated stretches go
    through Re-Pair; a run lies across the cut between the two sides of the
    lowest nonterminal that derives it whole. Each nonterminal's crossing runs
    are computed once, at one of its places, and moved to all of them.
    """
    ids, text = np.asarray(ids, dtype=np.int64), np.asarray(text, dtype=np.int64)
    parts = repeated_stretches(ids, text, least)
    if not len(parts):
        return np.zeros((0, 3), dtype=np.int64)
    sizes = parts[:, 1] - parts[:, 0]
    where = spread(parts[:, 0], sizes)
    stretch = np.repeat(np.arange(len(parts)), sizes)
    short = np.unique(ids[where], return_inverse=True)[1].astype(np.int64)
    grammar = repair(short, stretch)
    symbols, places = derivations(grammar, np.concatenate([[0], np.cumsum(sizes)[:-1]]), least)
    gram = _grams(short, stretch, context(least))
    n = len(short)
    order = np.lexsort((np.arange(n), gram))
    index = (gram, gram[order] * 2 * n + order, order)
    distinct, first, which = np.unique(symbols, return_index=True, return_inverse=True)
    left = grammar.lengths[grammar.left[distinct - grammar.first]]
    found: list[tuple[int, int, int, int]] = []
    for i, (at, size, cut) in enumerate(zip(places[first].tolist(), grammar.lengths[distinct].tolist(), left.tolist())):
        found += [(i, s - at, e - at, q) for s, e, q in crossing_runs(short, index, at, at + cut, at + size, least)]
    if not found:
        return np.zeros((0, 3), dtype=np.int64)
    kinds = np.array(found, dtype=np.int64)
    by = np.argsort(which, kind="stable")
    begin = np.searchsorted(which[by], kinds[:, 0])
    times = np.searchsorted(which[by], kinds[:, 0], side="right") - begin
    moved = places[by[spread(begin, times)]]
    kinds = np.repeat(kinds, times, axis=0)
    start = where[moved + kinds[:, 1]]
    return _maximal(np.stack([start, start + kinds[:, 2] - kinds[:, 1], kinds[:, 3]], axis=1))


def kept_words(n: int, runs: Sequence[Run]) -> np.ndarray:
    """Which of ``n`` words stay when each run keeps only its first period."""
    change = np.zeros(n + 1, dtype=np.int64)
    for start, end, q in runs:
        change[start + q] += 1
        change[end] -= 1
    return np.cumsum(change[:-1]) == 0


def batch_runs(texts: list[list[bytes]], least: int = LEAST) -> list[np.ndarray]:
    """The (start, end, period) rows of each text, given as its words."""
    known: defaultdict[bytes, int] = defaultdict(count().__next__)
    sizes = np.array([len(w) for w in texts], dtype=np.int64)
    at = np.concatenate([[0], np.cumsum(sizes)])
    ids = np.fromiter(map(known.__getitem__, chain.from_iterable(texts)), dtype=np.int64, count=int(at[-1]))
    found = runs_of(ids, np.repeat(np.arange(len(texts)), sizes), least)
    edges = np.searchsorted(found[:, 0], at)
    return [found[a:b] - [o, o, 0] for a, b, o in zip(edges[:-1], edges[1:], at[:-1])]


SCHEMA = "n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"


def run_column(text_col: str | Column, id_col: str | Column | None = None, reword: Callable[[int | None, list[bytes]], list[bytes]] | None = None, least: int = LEAST, digest: bool = False) -> Column:
    """struct(n_words, runs, collapsed) of each text.

    ``collapsed`` is the text's kept words joined by one space: each run keeps
    only its first period (``digest``: its SHA-256 in place of the text).
    ``reword`` may change a text's words by its id before they are searched.
    """

    def rows(texts: pd.Series, ids: pd.Series) -> pd.DataFrame:
        words = [words_of(t) for t in texts]
        if reword:
            words = [reword(None if pd.isna(i) else i, w) for i, w in zip(ids, words)]
        found = batch_runs(words, least)
        left = []
        for own, runs in zip(words, found):
            if len(runs):
                stay = kept_words(len(own), runs.tolist())
                own = [w for w, s in zip(own, stay.tolist()) if s]
            text = b" ".join(own)
            left.append(hashlib.sha256(text).hexdigest() if digest else text.decode("utf-8", "surrogatepass"))
        listed = [[{"start": s, "length": e - s, "period": q} for s, e, q in runs.tolist()] for runs in found]
        return pd.DataFrame({"n_words": pd.Series([len(w) for w in words], dtype="int64"), "runs": pd.Series(listed, dtype=object), "collapsed": pd.Series(left, dtype=object)})

    @F.pandas_udf(SCHEMA)
    def found(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, ids in batches:
            yield rows(texts, ids)

    return found(text_col, F.lit(None).cast("bigint") if id_col is None else id_col)


def with_runs(docs: DataFrame, text_col: str = "text", id_col: str | None = None, name: str = "__runs", **options) -> DataFrame:
    """``docs`` with a column of runs (see :func:`run_column`).

    Map only: nothing is shuffled, a worker holds one Arrow batch of bounded
    bytes, or one text. Only stretches whose four-word sequences occur again in
    their text are compressed, which leaves out no run. A null or empty text
    has no words and no runs; repeated rows and ids count as they stand; the
    other columns stay. A column called ``name`` is an error.
    """
    if name in docs.columns:
        raise ValueError(f"the table already has a column {name!r}")
    small_batches(docs.sparkSession)
    return docs.withColumn(name, run_column(text_col, id_col, **options))


def longest(runs: Column) -> Column:
    """The run of greatest length / period (ties: smallest start, then period), compared exactly; null if there is none."""

    def better(best: Column, run: Column) -> Column:
        mine, other = run["length"].cast("decimal(19,0)") * best["period"].cast("decimal(19,0)"), best["length"].cast("decimal(19,0)") * run["period"].cast("decimal(19,0)")
        earlier = (run["start"] < best["start"]) | ((run["start"] == best["start"]) & (run["period"] < best["period"]))
        return F.when(best.isNull() | (mine > other) | ((mine == other) & earlier), run).otherwise(best)

    return F.aggregate(runs, F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>"), better)


def run_digest(runs: Column) -> Column:
    """SHA-256 of every run's "start,length,period" and a line break, by start, then period."""
    ordered = F.array_sort(F.transform(runs, lambda r: F.struct(r["start"].alias("start"), r["period"].alias("period"), r["length"].alias("length"))))
    lines = F.transform(ordered, lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return F.sha2(F.array_join(lines, ""), 256)
