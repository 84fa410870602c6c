"""Running values per key that survive one key holding most of the rows.

A plain window partitioned by run puts a hot run in one task. Here a run is cut
into chunks; each chunk is reduced to one summary row, the summaries are
scanned, and the result is carried into a window over (run, chunk).

Chunks go by position: the rows are dealt out by ranges of (run, order) and
written once, and the number of the range is the chunk (``positioned``). There
are at most as many summaries as ranges plus runs, however dense or sparse the
order column is. A caller whose order column is a dense integer may instead
give the width of a chunk in that column, which saves the write.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from proseframe.session import write_through

#: by position
CHUNK: int | str | None = None
POSITION = "_position_chunk"
FIRST_CHUNK = -(2**62)


@dataclass(frozen=True)
class Running:
    """One running value: ``kind`` of ``expr`` over the earlier rows.

    kinds: min, max, count (non-null), last (non-null). ``inclusive`` adds the
    current row.
    """

    kind: str
    expr: Column
    inclusive: bool = True


def _reduce(kind: str, value: Column, order: Column) -> Column:
    if kind == "min":
        return F.min(value)
    if kind == "max":
        return F.max(value)
    if kind == "count":
        return F.count(value)
    return F.max_by(value, F.when(value.isNotNull(), order))


def _scan(kind: str, value: Column, window) -> Column:
    if kind == "min":
        return F.min(value).over(window)
    if kind == "max":
        return F.max(value).over(window)
    if kind == "count":
        return F.count(value).over(window)
    return F.last(value, ignorenulls=True).over(window)


def _combine(kind: str, carried: Column, inside: Column) -> Column:
    if kind == "min":
        return F.least(carried, inside)
    if kind == "max":
        return F.greatest(carried, inside)
    if kind == "count":
        return F.coalesce(carried, F.lit(0)) + inside
    return F.coalesce(inside, carried)


def positioned(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """``df`` in ranges of (keys, order), written once, with the number of its range in ``POSITION``."""
    dealt = df.repartitionByRange(*[F.col(k) for k in keys], F.col(order))
    return write_through(dealt.withColumn(POSITION, F.spark_partition_id().cast("bigint")), "ranges")


def in_chunks(df: DataFrame, keys: Sequence[str], order: str, chunk: int | str | None) -> DataFrame:
    """``df`` with ``_chunk``: from a column that has it, from a width of the order column, else by position."""
    if chunk is None:
        return positioned(df, keys, order).withColumnRenamed(POSITION, "_chunk")
    if isinstance(chunk, str):
        return df.withColumn("_chunk", F.col(chunk))
    return df.withColumn("_chunk", F.floor(F.col(order) / F.lit(chunk)))


def _named(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A null key is an error: it would not join with its summary."""
    message = F.raise_error(F.lit(f"a key of {list(keys)} is null"))
    return df.withColumns({k: F.coalesce(F.col(k), message.cast(df.schema[k].dataType)) for k in keys})


def running_values(
    df: DataFrame,
    values: dict[str, Running],
    keys: Sequence[str],
    order: str,
    chunk: int | str | None = CHUNK,
    initial: DataFrame | None = None,
) -> DataFrame:
    """Add one column per running value. A null key is an error.

    The rows are shuffled once, by (keys, chunk), which the join and the window
    share; the summaries are partially aggregated before their shuffle.
    ``initial`` (keys and one column per value) continues an earlier scan: it
    enters as a summary before every chunk.
    """
    for v in values.values():
        if v.kind not in ("min", "max", "count", "last"):
            raise ValueError(f"unknown running value: {v.kind!r}")
    chunked = in_chunks(_named(df, keys), keys, order, chunk)
    for name, v in values.items():
        chunked = chunked.withColumn(f"_in_{name}", v.expr)
    parts = [*keys, "_chunk"]

    summary = chunked.groupBy(*parts).agg(
        *[_reduce(v.kind, F.col(f"_in_{n}"), F.col(order)).alias(f"_in_{n}") for n, v in values.items()]
    )
    if initial is not None:
        before = initial.select(*keys, F.lit(FIRST_CHUNK).alias("_chunk"), *[F.col(n).alias(f"_in_{n}") for n in values])
        summary = summary.unionByName(before)
    earlier = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)

    def carry(name: str, v: Running) -> Column:
        # a count of chunks is the sum of their counts
        col = F.col(f"_in_{name}")
        scanned = F.sum(col).over(earlier) if v.kind == "count" else _scan(v.kind, col, earlier)
        return scanned.alias(f"_carry_{name}")

    carried = summary.select(*parts, *[carry(n, v) for n, v in values.items()])
    joined = chunked.join(carried, parts, "left")
    base = Window.partitionBy(*parts).orderBy(order)
    out = joined
    for name, v in values.items():
        frame = base.rowsBetween(Window.unboundedPreceding, 0 if v.inclusive else -1)
        inside = _scan(v.kind, F.col(f"_in_{name}"), frame)
        out = out.withColumn(name, _combine(v.kind, F.col(f"_carry_{name}"), inside))
    return out.select(*df.columns, *values)


def key_minimum(
    df: DataFrame, expr: Column, out: str, keys: Sequence[str], order: str, chunk: int | str | None = CHUNK
) -> DataFrame:
    """Add the minimum of ``expr`` over all rows of the key, joined per chunk for the same reason."""
    chunked = in_chunks(_named(df, keys[:1]), keys, order, chunk).withColumn("_v", expr)
    parts = [*keys, "_chunk"]
    summary = chunked.groupBy(*parts).agg(F.min("_v").alias("_v"))
    whole = summary.select(*parts, F.min("_v").over(Window.partitionBy(*keys)).alias(out))
    return chunked.join(whole, parts, "left").select(*df.columns, out)


def key_constants(
    df: DataFrame, constants: DataFrame, keys: Sequence[str], order: str, chunk: int | str | None = CHUNK
) -> DataFrame:
    """Add the columns of ``constants`` (one row per key), joined per chunk; null where a key is new."""
    parts = [*keys, "_chunk"]
    chunked = in_chunks(df, keys, order, chunk)
    table = chunked.select(*parts).distinct().join(constants, list(keys), "left")
    return chunked.join(table, parts, "left").drop("_chunk")
