"""Phrases whose words occur together more often than apart, from sorted streams of counts.

Each place of a text is counted once, as the window of up to ``MOST`` words that
begins there. Sorted by its words the stream of windows is in prefix order: all
windows that begin with a phrase lie side by side, so one walk along the merged
streams of all blocks of texts gives the counts of phrases of every length. The counts of a phrase's parts,
and of the phrases one word longer, come from lockstep merges of count streams
sorted by prefix and by suffix.
"""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from proseframe.llm.batches import small_batches
from proseframe.session import write_through

#: words of the longest phrase; words and bytes counted together before they leave a task
MOST, BLOCK_WORDS, BLOCK_BYTES = 4, 1_200_000, 16 << 20
#: A to Z lower-cased; what ends a piece is a full stop
_PIECES = bytes(b + 32 if 65 <= b <= 90 else 46 if b in b".,;:!?" or 10 <= b <= 13 else b for b in range(256))
#: texts whose windows make up a range, on average: what a task holds of the merged stream; least sample for the ranges
RANGE_CHARS, SAMPLE_CHARS = 8_000_000, 4_000_000
STREAM = "range int, lang string, words binary, codes binary, n binary"
STREAM_NAMES, ARROW = ["range", "lang", "words", "codes", "n"], [pa.int32(), pa.string(), pa.binary(), pa.binary(), pa.binary()]
#: groups in which each language's best are looked for before they meet
SALTS = 64


def words_and_breaks(text: str | None) -> list[bytes]:
    """The words of a text, with b"." between its pieces."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_PIECES).replace(b".", b" . ").split()


class Stream(NamedTuple):
    """Windows of one language in the order of their words, and how often each occurs.

    ``words`` are sorted, b"" for a word that is not there the first;
    ``codes`` has a row for each window: the places of its MOST words in them.
    """

    words: list[bytes]
    codes: np.ndarray
    n: np.ndarray


def _summed(words: list[bytes], columns: list[np.ndarray], n: np.ndarray | None = None) -> Stream:
    """The windows of ``columns`` in order, equal ones added up; ``words`` in any order, b"" among them."""
    order = sorted(range(len(words)), key=words.__getitem__)
    rank = np.empty(len(words), dtype=np.int64)
    rank[order] = np.arange(len(words))
    size = len(words)
    low, second = np.unique(rank[columns[2]] * size + rank[columns[3]], return_inverse=True)
    high, first = np.unique(rank[columns[0]] * size + rank[columns[1]], return_inverse=True)
    both = first * len(low) + second
    if n is None:
        found, total = np.unique(both, return_counts=True)
    else:
        by = np.argsort(both, kind="stable")
        start = np.flatnonzero(np.concatenate([[True], np.diff(both[by]) > 0])) if len(by) else by
        found, total = both[by][start], np.add.reduceat(n[by], start) if len(by) else n
    high, low = high[found // len(low)], low[found % len(low)]
    codes = np.stack([high // size, high % size, low // size, low % size], axis=1)
    return Stream([words[i] for i in order], codes, total)


def _block(words: list[bytes], ids: np.ndarray) -> Stream:
    """The stream of a block of texts; id 0 is a break."""
    columns = [ids, *[np.concatenate([ids[i:], np.zeros(min(i, len(ids)), dtype=np.int64)]) for i in range(1, MOST)]]
    for i in range(1, MOST):
        columns[i] = np.where(columns[i - 1] > 0, columns[i], 0)
    return _summed([b"", *words[1:]], [c[ids > 0] for c in columns])


def window_streams(docs: DataFrame, text_col: str, lang_col: str, cut: Callable[[str, Stream], Iterator[tuple[int, Stream]]]) -> DataFrame:
    """(range, lang, words, codes, n): the windows of all texts as streams of blocks, each cut into ranges by ``cut``.

    A word holds no space, so a stream's words are written with one after each.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, defaultdict[bytes, int]] = {}
        ids: dict[str, list[np.ndarray]] = {}
        size = held = 0

        def block() -> Iterator[pa.RecordBatch]:
            for lang, words in known.items():
                if len(words) == 1:
                    continue  # nothing but breaks
                for part, s in cut(lang, _block(list(words), np.concatenate(ids[lang]))):
                    row = [part, lang, b" ".join(s.words), s.codes.astype("<i4").tobytes(), s.n.astype("<i8").tobytes()]
                    yield pa.RecordBatch.from_arrays([pa.array([x], type=t) for x, t in zip(row, ARROW)], names=STREAM_NAMES)
            known.clear()
            ids.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                lang = "und" if lang is None else lang
                if lang not in known:
                    known[lang], ids[lang] = defaultdict(count().__next__), []
                    known[lang][b"."]  # breaks are number 0
                words = words_and_breaks(text)
                own = np.fromiter(map(known[lang].__getitem__, words), dtype=np.int64, count=len(words))
                ids[lang].append(np.append(own, 0))
                size, held = size + len(own), held + len(text or "")
                if size >= BLOCK_WORDS or held >= BLOCK_BYTES:
                    yield from block()
                    size = held = 0
        yield from block()

    return docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")).mapInArrow(counted, STREAM)


def _used(stream: Stream, low: int, high: int) -> Stream:
    """Rows ``low`` to ``high`` with the words that they use."""
    codes = stream.codes[low:high]
    used, places = np.unique(np.append(codes.ravel(), 0), return_inverse=True)
    return Stream([stream.words[i] for i in used.tolist()], places[:-1].reshape(codes.shape), stream.n[low:high])


Key = tuple[str, bytes, bytes, bytes, bytes]


def _cutter(bounds: list[Key]) -> Callable[[str, Stream], Iterator[tuple[int, Stream]]]:
    """Cuts a stream where the sorted ``bounds`` lie."""

    def cut(lang: str, stream: Stream) -> Iterator[tuple[int, Stream]]:
        def key(row: int) -> Key:
            return (lang, *[stream.words[x] for x in stream.codes[row].tolist()])

        rows, low, part = range(len(stream.n)), 0, 0
        while low < len(stream.n):
            part = bisect_right(bounds, key(low), part)
            high = bisect_left(rows, bounds[part], low, key=key) if part < len(bounds) else len(stream.n)
            yield part, _used(stream, low, high)
            low = high

    return cut


def range_bounds(docs: DataFrame, ranges: int, characters: float, text_col: str, lang_col: str, seed: int = 7) -> list[Key]:
    """Keys that cut the stream of windows into about equal ``ranges``, from a sample of the texts.

    Like the bounds of Spark's own range partitioning they only balance the
    tasks. The driver sees a hundred keys or so for each range, a block of the
    sample at a time.
    """

    def whole(lang: str, stream: Stream) -> Iterator[tuple[int, Stream]]:
        yield 0, stream

    if ranges < 2 or not characters:
        return []
    share = min(1.0, max(SAMPLE_CHARS, 3000.0 * ranges) / characters)
    step = max(1, int(share * characters / (600 * ranges)))
    found: list[Key] = []
    for row in window_streams(docs.sample(share, seed), text_col, lang_col, whole).toLocalIterator():
        stream = _read(row["words"], row["codes"], row["n"])
        found += [(row["lang"], *[stream.words[x] for x in codes]) for codes in stream.codes[step // 2 :: step].tolist()]
    found.sort()
    return sorted({found[len(found) * i // ranges] for i in range(1, ranges)}) if found else []


def _read(words: bytes, codes: bytes, n: bytes) -> Stream:
    return Stream(words.split(b" "), np.frombuffer(codes, dtype="<i4").reshape(-1, MOST).astype(np.int64), np.frombuffer(n, dtype="<i8"))


def _merged(streams: list[Stream]) -> Stream:
    known: defaultdict[bytes, int] = defaultdict(count().__next__)
    codes = [np.fromiter(map(known.__getitem__, s.words), dtype=np.int64, count=len(s.words))[s.codes] for s in streams]
    return _summed(list(known), list(np.concatenate(codes).T), np.concatenate([s.n for s in streams]))


def _walked(stream: Stream, least: int) -> Iterator[tuple[str, int, int]]:
    """(phrase, words, count) along one range of the sorted stream.

    Phrases that begin and end inside the range have their whole count here and
    are told from ``least`` on; the first and the last of each length may go on
    in the neighbouring ranges and are told in any case. The words of the range
    are told as a phrase of no words.
    """
    codes = stream.codes
    yield "", 0, int(stream.n.sum())
    new = np.logical_or.accumulate(codes[1:] != codes[:-1], axis=1)
    for words in range(1, MOST + 1):
        start = np.concatenate([[0], np.flatnonzero(new[:, words - 1]) + 1])
        sums = np.add.reduceat(stream.n, start)
        told = sums >= least
        told[[0, -1]] = True
        told &= codes[start, words - 1] > 0
        for row, total in zip(codes[start[told], :words].tolist(), sums[told].tolist()):
            yield b" ".join([stream.words[x] for x in row]).decode("utf-8", "surrogatepass"), words, total


def phrase_counts(docs: DataFrame, least: int = 30, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, phrase, words, n): phrases of up to MOST words that occur ``least`` times, and of no words: all words of the language.

    A task counts the windows of a block of texts into a sorted stream and cuts
    it at the bounds of the ranges; a range's pieces are merged in one task and
    walked once. There are at least as many ranges as shuffle partitions, and
    enough that one stays within RANGE_CHARS of text on average. A window that
    is very common arrives as a row a block.
    """

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces: defaultdict[str, list[Stream]] = defaultdict(list)
        for batch in batches:
            for _, lang, words, codes, n in zip(*[c.to_pylist() for c in batch.columns]):
                pieces[lang].append(_read(words, codes, n))
        for lang, streams in pieces.items():
            rows = [(lang, *row) for row in _walked(_merged(streams), least)]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows), (pa.string(), pa.string(), pa.int32(), pa.int64()))], names=["lang", "phrase", "words", "n"])

    spark = docs.sparkSession
    characters = docs.agg(F.sum(F.length(text_col).cast("double"))).first()[0] or 0.0
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(characters / RANGE_CHARS))
    streams = window_streams(docs, text_col, lang_col, _cutter(range_bounds(docs, ranges, characters, text_col, lang_col)))
    found = streams.repartitionById(ranges, F.col("range")).mapInArrow(walk, "lang string, phrase string, words int, n bigint")
    return found.groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n")).where((F.col("n") >= least) | (F.col("words") == 0))


def _part(words: Column, start: Column | int, size: Column | int) -> Column:
    return F.array_join(F.slice(words, start, size), " ")


def with_cuts(candidates: DataFrame, counts: DataFrame) -> DataFrame:
    """``candidates`` (lang, phrase, words, a) with the lowest-scoring cut: score, cut, l, r.

    Two merges: the cuts in the order of their first parts, then of their rests, along the counts in prefix order.
    """
    words = F.split("phrase", " ")
    cuts = candidates.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.withColumns({"first": _part(words, 1, F.col("cut")), "rest": _part(words, F.col("cut") + 1, F.col("words") - F.col("cut"))})
    first = counts.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l"))
    rest = counts.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    joined = cuts.join(first.hint("merge"), ["lang", "first"]).join(rest.hint("merge"), ["lang", "rest"])
    score = F.expr("cast(2000000 * cast(a as decimal(20, 0)) div (cast(l as decimal(20, 0)) + r) as bigint)")
    best = joined.groupBy("lang", "phrase", "words", "a").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("best"))
    return best.select("lang", "phrase", "words", "a", "best.*")


def without_parts(candidates: DataFrame, longer: DataFrame, share: int = 80) -> DataFrame:
    """Without the candidates that lie in a longer one occurring at least ``share`` percent as often.

    If any longer phrase is so frequent, so is one with one word more: it lies
    in the longer one. So the longer phrases in the order of all words but the
    last, and of all but the first, are merged along the candidates.
    """
    words = F.split("phrase", " ")
    ends = F.array(_part(words, 1, F.col("words") - 1), _part(words, 2, F.col("words") - 1))
    extended = longer.where("words > 2").select("lang", F.explode(ends).alias("phrase"), F.col("a").alias("more"))
    extended = extended.groupBy("lang", "phrase").agg(F.max("more").alias("more"))
    joined = candidates.join(extended.hint("merge"), ["lang", "phrase"], "left")
    whole = F.expr(f"100 * cast(more as decimal(20, 0)) >= {int(share)} * cast(a as decimal(20, 0))")
    return joined.where(F.col("more").isNull() | ~whole).drop("more")


def _best(rows: DataFrame, top: int, by: list[str]) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.desc("a"), "phrase")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def mine_phrases(docs: DataFrame, least: int = 30, share: int = 80, top: int = 2000, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases of 2 to MOST words.

    ``a`` is the phrase's count, ``l`` and ``r`` those of the parts of its
    lowest-scoring cut (ties: the first), ``n`` the language's words; the score
    is floor(2000000 a / (l + r)), in exact decimals. Order: score, then count
    descending, then the phrase's bytes.

    Scale: texts are not shuffled; a window is, once a block, as four numbers.
    Ranges are cut anywhere between two windows, so no language or word meets
    in one task. A task holds a range, RANGE_CHARS of text on average: with
    larger workers raise it and BLOCK_WORDS, for the bounds of all ranges go to
    every task. Everything after that concerns phrases that occur ``least``
    times. The best of a language are taken in SALTS groups first, and each
    task keeps no more than ``top`` of one before rows move.
    A null text is empty, a null language "und"; words between spaces and tabs,
    pieces between ``.,;:!?`` and line breaks; repeated rows count as they
    stand, other columns are ignored, an empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    counts = write_through(phrase_counts(docs, least, text_col, lang_col), "phrase-counts")
    candidates = counts.where("words > 1").withColumnRenamed("n", "a")
    rows = without_parts(with_cuts(candidates, counts.where("words > 0")), candidates, share)
    salted = _best(rows.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))), top, ["lang", "salt"])
    best = _best(salted.drop("rank", "salt"), top, ["lang"])
    totals = counts.where("words = 0").select("lang", "n")
    return best.join(totals, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
