"""Fixed-length id arrays: vocabulary lookup, truncation, padding, masks."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proseframe.session import write_through

#: distinct words, and their characters, numbered together before a task starts anew
BLOCK_WORDS, BLOCK_CHARS = 200_000, 8_000_000
#: texts that share one row of the coded table, and their codes: a block's ids are copied once for each such row
GROUP_ROWS, GROUP_CODES = 1000, 200_000


def fixed_length(ids: Column, max_length: int, pad_id: int, padding_side: str = "right") -> tuple[Column, Column]:
    """(ids, attention mask), both exactly ``max_length`` long."""
    kept = F.slice(ids, 1, max_length)
    n_pad = F.lit(max_length) - F.size(kept)
    padding = F.array_repeat(F.lit(pad_id), n_pad)
    ones, zeros = F.array_repeat(F.lit(1), F.size(kept)), F.array_repeat(F.lit(0), n_pad)
    if padding_side == "right":
        return F.concat(kept, padding), F.concat(ones, zeros)
    if padding_side == "left":
        return F.concat(padding, kept), F.concat(zeros, ones)
    raise ValueError(f"padding_side must be 'right' or 'left', not {padding_side!r}")


def _coded(df: DataFrame, columns: list[str], most: int | None) -> DataFrame:
    """Rows of ``df`` with the texts in ``columns`` as arrays of codes, and what the codes of each block stand for.

    A block is what a task reads until its distinct words pass a bound. Rows
    with ``_words`` list the words of their ``_block`` by code; the others hold
    in ``_rows`` some rows of ``df``, bounded in number and codes. A text's
    codes stand for its first ``most`` words.
    """
    rest = [c for c in df.columns if c not in columns]
    own = "".join(f"`{f.name}`: {f.dataType.simpleString()}, " for f in df.select(*rest).schema)
    codes = ", ".join(f"`{c}`: array<int>" for c in columns)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: defaultdict[str, int] = defaultdict(count().__next__)
        names = ["_block", "_words", "_rows"]
        block, held, kind = TaskContext.get().partitionId() << 32, 0, None

        def numbers(text: str | None) -> list[int] | None:
            if text is None:
                return None
            words = text.split() if most is None else text.split(None, most)[:most]
            return list(map(known.__getitem__, words))

        def words() -> pa.RecordBatch:
            listed = [pa.array([block], type=pa.int64()), pa.array([list(known)], type=pa.list_(pa.string()))]
            return pa.RecordBatch.from_arrays([*listed, pa.nulls(1, kind)], names=names)

        def grouped(rows: pa.StructArray, sizes: np.ndarray) -> pa.RecordBatch:
            """Rows of a batch, some in each row of the result."""
            nth = np.maximum(np.arange(len(sizes)) // GROUP_ROWS, np.cumsum(sizes) // GROUP_CODES)
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(nth)) + 1, [len(sizes)]])
            lists = pa.ListArray.from_arrays(pa.array(cuts, type=pa.int32()), rows)
            return pa.RecordBatch.from_arrays([pa.array([block] * len(lists), type=pa.int64()), pa.nulls(len(lists), pa.list_(pa.string())), lists], names=names)

        for batch in batches:
            before = len(known)
            lists = [pa.array(list(map(numbers, batch.column(c).to_pylist())), type=pa.list_(pa.int32())) for c in columns]
            rows = pa.StructArray.from_arrays([batch.column(c) for c in rest] + lists, names=[*rest, *columns])
            kind = pa.list_(rows.type)
            if batch.num_rows:
                sizes = sum(pc.fill_null(pc.list_value_length(x), 0).to_numpy(zero_copy_only=False) for x in lists)
                yield grouped(rows, sizes)
            held += sum(map(len, islice(reversed(known), len(known) - before)))
            if len(known) >= BLOCK_WORDS or held >= BLOCK_CHARS:
                yield words()
                known.clear()
                known.default_factory = count().__next__
                block, held = block + 1, 0
        if known:
            yield words()

    return df.select(*rest, *columns).mapInArrow(coded, f"_block bigint, _words array<string>, _rows array<struct<{own}{codes}>>")


def lookup(df: DataFrame, columns: list[str], vocabulary: DataFrame, unk_id: int, most: int | None = None) -> DataFrame:
    """Replace the texts in ``columns`` by arrays of the ids of their (first ``most``) words.

    Each task numbers its distinct words as it reads and keeps its texts as
    arrays of these numbers, many texts a row; the result is written once to the shared folder.
    Only the distinct words of a block meet the vocabulary, whose ids then come
    back to the block's rows as one array: a word is shuffled once a block, not
    once a use, and no text is shuffled. A vocabulary of any size takes this
    plan; Catalyst broadcasts what is small enough. White space is that of
    ``str.split``. A null text stays null, a word that the vocabulary lacks gets
    ``unk_id``, one that it lists twice is an error. Rows may repeat in every
    column; columns named ``_block`` or ``_words`` are an error.
    """
    if {"_block", "_words"} & set(df.columns):
        raise ValueError("columns must not be named _block or _words")
    coded = write_through(_coded(df, columns, most), "coded")
    once = vocabulary.groupBy("token").agg(F.max("token_id").alias("token_id"), F.count(F.lit(1)).alias("_n"))
    repeated = F.raise_error(F.concat(F.lit("the vocabulary lists a token more than once: "), F.col("token")))
    once = once.select("token", F.when(F.col("_n") == 1, F.col("token_id")).otherwise(repeated.cast("int")).alias("token_id"))
    words = coded.where(F.col("_words").isNotNull()).select("_block", F.posexplode("_words").alias("_code", "token"))
    found = words.join(once, "token", "left").groupBy("_block").agg(F.sort_array(F.collect_list(F.struct("_code", F.coalesce("token_id", F.lit(unk_id)).alias("id")))).alias("_ids"))
    rows = coded.where(F.col("_words").isNull()).drop("_words")
    # a block's ids go along with many texts at once: beside each text they would be copied for each
    joined = rows.join(found.select("_block", F.col("_ids.id").alias("_ids")), "_block", "left")
    rest = [c for c in df.columns if c not in columns]

    def with_ids(row: Column) -> Column:
        ids = [F.transform(row[c], lambda x: F.get(F.col("_ids"), x)).alias(c) for c in columns]
        return F.struct(*[row[c].alias(c) for c in rest], *ids)

    return joined.select(F.inline(F.transform("_rows", with_ids)))


def encode_fixed_length(
    df: DataFrame,
    vocabulary: DataFrame | None = None,
    tokenizer: Callable[[Column], Column] | None = None,
    max_length: int = 512,
    pad_id: int = 0,
    unk_id: int = 1,
    padding_side: str = "right",
    keep_text: bool = False,
) -> DataFrame:
    """Add ``input_ids``, ``attention_mask`` and ``labels``.

    Give either a ``vocabulary`` (token string, token_id int; tokens are
    white-space words) or a ``tokenizer`` from a text column to an id-array
    column, for example a pandas UDF. With a vocabulary the texts themselves
    are left out of the result unless ``keep_text``, so that they never travel
    with the ids. ``labels`` are the ids of ``label`` where
    there is one, else a copy of ``input_ids``; padding is not masked in them.
    """
    if (vocabulary is None) == (tokenizer is None):
        raise ValueError("give a vocabulary or a tokenizer")
    has_label = "label" in df.columns
    columns = ["_text_ids"] + (["_label_ids"] if has_label else [])
    sources = {"_text_ids": "text", "_label_ids": "label"}
    work = df
    if tokenizer is not None:
        for c in columns:
            work = work.withColumn(c, tokenizer(F.col(sources[c])))
    else:
        work = work.withColumns({c: F.col(sources[c]) for c in columns})
        work = work if keep_text else work.drop(*sources.values())
        vocabulary = vocabulary.select("token", F.col("token_id").cast("int").alias("token_id"))
        work = lookup(work, columns, vocabulary, unk_id, max_length)
    ids, mask = fixed_length(F.col("_text_ids"), max_length, pad_id, padding_side)
    work = work.withColumn("input_ids", ids).withColumn("attention_mask", mask)
    labels = F.col("input_ids")
    if has_label:
        labels = F.coalesce(fixed_length(F.col("_label_ids"), max_length, pad_id, padding_side)[0], labels)
    return work.withColumn("labels", labels).drop(*columns)


def token_counts(df: DataFrame, pad_id: int = 0) -> DataFrame:
    """Add ``n_tokens``: ids other than padding."""
    return df.withColumn("n_tokens", F.size(F.filter("input_ids", lambda x: x != pad_id)))
