"""Benchmark decontamination: an FM-index per shard of documents, searched for benchmark phrases."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType

from proseframe.functions.bind import computed_and_kept
from proseframe.llm.batches import small_batches
from proseframe.llm.fmindex import FMIndex
from proseframe.session import write_through

#: ASCII letters lower-cased, digits kept, other ASCII to a space, all else kept
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_WORD = re.compile(rb"[^ ]+")


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(WORD_BYTES).split() if text else []


class Phrases:
    """The distinct windows of a block of benchmark items, as rows of word ids."""

    def __init__(self, items: list[tuple[str, str | None]], window: int = 10):
        self.words: dict[bytes, int] = {}
        self.names = list(dict.fromkeys(name for name, _ in items))
        number = {name: i for i, name in enumerate(self.names)}
        owners: dict[tuple[int, ...], list[int]] = {}
        for name, text in items:
            nth = number[name]
            ids = [self.words.setdefault(w, len(self.words) + 1) for w in words_of(text)]
            for at in range(max(1, len(ids) - window + 1) if ids else 0):
                mine = owners.setdefault(tuple(ids[at : at + window]), [])
                if not mine or mine[-1] != nth:
                    mine.append(nth)
        self.lengths = np.array([len(p) for p in owners], dtype=np.int64)
        self.rows = np.zeros((len(owners), window), dtype=np.int64)
        for i, phrase in enumerate(owners):
            self.rows[i, : len(phrase)] = phrase
        self.owner_at = np.concatenate([[0], np.cumsum([len(x) for x in owners.values()])]).astype(np.int64)
        self.owners = np.array([o for x in owners.values() for o in x], dtype=np.int64)


def _spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0]+1, ... ``counts[0]`` times, then the same for the next."""
    return np.repeat(starts - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(int(counts.sum()))


def match_shard(texts: list[str | None], phrases: Phrases) -> tuple[list[int], list[list[int]], list[list[int]]]:
    """For each text of a shard: its words, its merged hit spans as [start, end, ...] in words, the numbers of items found.

    Stretches without a benchmark word in between, long enough for a window,
    are all that a window can lie in; the index holds those whole stretches.
    """
    get = phrases.words.get
    ids = [np.fromiter(map(get, words_of(t), repeat(0)), dtype=np.int32) for t in texts]
    n_words = [len(x) for x in ids]
    spans: list[list[int]] = [[] for _ in texts]
    items: list[list[int]] = [[] for _ in texts]
    if not len(phrases.rows) or not sum(n_words):
        return n_words, spans, items
    ends = np.zeros(1, dtype=np.int32)
    flat = np.concatenate([ends, *[part for x in ids for part in (x, ends)]])
    doc_at = 1 + np.concatenate([[0], np.cumsum(np.array(n_words[:-1], dtype=np.int64) + 1)]).astype(np.int64)
    known = flat > 0
    edge = np.diff(known.astype(np.int8))
    first, after = np.flatnonzero(edge == 1) + 1, np.flatnonzero(edge == -1) + 1
    long = after - first >= int(phrases.lengths.min())
    first, after = first[long], after[long]
    if not len(first):
        return n_words, spans, items
    where = _spread(first, after - first + 1)  # each stretch and the 0 after it
    index = FMIndex(flat[where].astype(np.int64))
    low, high = index.search(phrases.rows, phrases.lengths)
    seen = np.flatnonzero(high > low)
    if not len(seen):
        return n_words, spans, items
    times = (high - low)[seen]
    at = where[index.locate(_spread(low[seen], times))]
    which = np.repeat(seen, times)
    cover = np.zeros(len(flat) + 1, dtype=np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + phrases.lengths[which], -1)
    hit = np.concatenate([[False], np.cumsum(cover)[:-1] > 0, [False]])
    turn = np.flatnonzero(hit[1:] != hit[:-1])
    for start, end in turn.reshape(-1, 2):
        doc = int(np.searchsorted(doc_at, start, side="right")) - 1
        spans[doc] += [int(start - doc_at[doc]), int(end - doc_at[doc])]
    docs = np.searchsorted(doc_at, at, side="right") - 1
    pairs = np.unique(docs * len(phrases.lengths) + which)
    docs, which = pairs // len(phrases.lengths), pairs % len(phrases.lengths)
    owned = phrases.owner_at[which + 1] - phrases.owner_at[which]
    found = phrases.owners[_spread(phrases.owner_at[which], owned)]
    pairs = np.unique(np.repeat(docs, owned) * len(phrases.names) + found)
    for pair in pairs:
        items[int(pair // len(phrases.names))].append(int(pair % len(phrases.names)))
    return n_words, spans, items


def item_blocks(items: DataFrame, id_col: str, text_col: str, block_bytes: int) -> Iterator[list[tuple[str, str | None]]]:
    """The benchmark in blocks of at most ``block_bytes`` of text (or one item), one block at a time on the driver."""
    block: list[tuple[str, str | None]] = []
    size = 0
    rows = items.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text")).orderBy("id", "text")
    for row in rows.toLocalIterator():
        more = len((row["text"] or "").encode())
        if block and size + more > block_bytes:
            yield block
            block, size = [], 0
        block.append((row["id"], row["text"]))
        size += more
    yield block


def merged(spans: list[int]) -> list[int]:
    """The union of [start, end, ...] intervals, in order."""
    out: list[int] = []
    for start, end in sorted(zip(spans[::2], spans[1::2])):
        if out and start <= out[-1]:
            out[-1] = max(out[-1], end)
        else:
            out += [start, end]
    return out


def _matcher(shared, cut: bool):
    @F.pandas_udf("struct<n_words: bigint, spans: array<int>, items: array<string>, left: string>")
    def matches(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        phrases = shared.value
        for texts in batches:
            n_words, spans, items = match_shard(list(texts), phrases)
            left = [cut_words(t, s) if cut and s else None for t, s in zip(texts, spans)]
            yield pd.DataFrame({"n_words": n_words, "spans": spans, "items": [[phrases.names[i] for i in x] for x in items], "left": pd.Series(left, dtype=object)})

    return matches


@F.pandas_udf(ArrayType(IntegerType()))
def _merge(spans: pd.Series) -> pd.Series:
    return spans.map(lambda x: merged(list(x)))


def with_matches(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = 10, block_bytes: int = 8 << 20, cut: bool = False) -> DataFrame:
    """``docs`` with a column ``__hits``: struct(n_words, spans, items, left).

    ``spans`` are the merged stretches of words inside an occurrence of a
    window, ``items`` the ids of the items found, ``left`` (with ``cut``, where
    there are hits) the text without the spans. Documents are neither
    shuffled nor gathered: a shard is an Arrow batch of bounded bytes, indexed
    and searched where it lies. The benchmark goes out in blocks of
    ``block_bytes``; a larger one takes a pass per block, and what the passes
    found is merged per row. A null or empty text has no words and no hits, an
    item without words matches nothing; an item without an id is named "null";
    an item id counts once for a document, on however many rows it stands;
    repeated documents count as they stand; other columns stay.
    """
    spark = docs.sparkSession
    small_batches(spark)
    names: list[str] = []
    for block in item_blocks(items, item_id, item_text, block_bytes):
        if names:
            docs = write_through(docs, "matched")
        shared = spark.sparkContext.broadcast(Phrases([(name if name is not None else "null", text) for name, text in block], window))
        names.append(f"__hits{len(names)}")
        docs = docs.withColumn(names[-1], _matcher(shared, cut)(F.col(text_col)))
    if len(names) == 1:
        return docs.withColumnRenamed(names[0], "__hits")
    spans = _merge(F.concat(*[F.col(f"{n}.spans") for n in names]))
    found = F.array_distinct(F.concat(*[F.col(f"{n}.items") for n in names]))
    left = F.when(F.size(spans) > 0, _cut(F.col(text_col), spans)) if cut else F.lit(None).cast("string")
    return docs.withColumn("__hits", F.struct(F.col(f"{names[0]}.n_words").alias("n_words"), spans.alias("spans"), found.alias("items"), left.alias("left"))).drop(*names)


def hit_words(spans):
    """How many words the merged spans hold: with each boundary the running value becomes "boundary minus value"."""
    return F.aggregate(spans, F.lit(0).cast("bigint"), lambda a, x: x.cast("bigint") - a)


def cut_words(text: str, spans: list[int]) -> str:
    """``text`` without the words in ``spans`` and what stands between them; a line break marks each cut."""
    data = text.encode()
    places = [(m.start(), m.end()) for m in _WORD.finditer(data.translate(WORD_BYTES))]
    kept, at = [], 0
    for start, end in zip(spans[::2], spans[1::2]):
        kept.append(data[at : places[start][0]])
        at = places[end - 1][1]
    return b"\n".join([*kept, data[at:]]).decode()


@F.pandas_udf(StringType())
def _cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
    return pd.Series([cut_words(t or "", list(s)) for t, s in zip(texts, spans)], dtype=object)


def remove_matches(docs: DataFrame, items: DataFrame, text_col: str = "text", length_col: str | None = "n_chars", **options) -> DataFrame:
    """``docs`` with the hit spans cut out of the text; a document that is nothing but hits goes.

    Rows without hits stay as they are, also empty ones. ``length_col`` is set
    anew where the text changed, if there is such a column.
    """
    columns = docs.columns
    found = with_matches(docs, items, text_col, cut=True, **options)
    hit = F.size("__hits.spans") > 0

    def partial(hits):
        spans = hits["spans"]
        return ~((F.size(spans) == 2) & (F.get(spans, F.lit(0)) == 0) & (F.get(spans, F.lit(1)) == hits["n_words"]))

    # a filter over the matches would be pushed below them and match again
    found = found.withColumn("__hits", computed_and_kept(F.col("__hits"), partial))
    changed = {text_col: F.when(hit, F.col("__hits.left")).otherwise(F.col(text_col))}
    if length_col in columns:
        length = F.length("__hits.left").cast(docs.schema[length_col].dataType)
        changed[length_col] = F.when(hit, length).otherwise(F.col(length_col))
    return found.withColumns(changed).select(*columns)
