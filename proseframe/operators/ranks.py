"""Global ranks and exact cut points without a global sort.

The order is that of ``md5(seed-id)``: a seeded shuffle that does not depend on
partitioning. Its first four hex digits spread any table evenly over 65,536
buckets, so bucket counts (a bounded table) locate a rank, and only the bucket
that holds it has to be sorted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from proseframe.operators.scans import POSITION, positioned

BUCKET_DIGITS = 4


def shuffle_key(id_col: str = "sample_id", seed: int = 42, ties: Sequence[str] = ()) -> Column:
    """The place of a row in the seeded order; a null id is an error.

    ``ties`` are further columns that tell rows with the same id apart.
    """
    missing = F.raise_error(F.lit(f"{id_col} is null: such a row has no place in an exact sample or split"))
    key = F.md5(F.concat(F.lit(f"{seed}-"), F.coalesce(F.col(id_col).cast("string"), missing.cast("string"))))
    if ties:
        key = F.concat(key, F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ties])))
    return key


def _bucket_counts(keys: DataFrame) -> DataFrame:
    """Rows per bucket with the rows before it and in total: at most 16**4 rows.

    The windows run in one task over this bounded table, never over the data.
    """
    counts = keys.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    ordered = Window.orderBy("bucket")
    return counts.select(
        "bucket",
        "n",
        (F.sum("n").over(ordered) - F.col("n")).alias("before"),
        F.sum("n").over(Window.partitionBy()).alias("total"),
    )


def keys_at_ranks(df: DataFrame, ranks: dict[str, Column], id_col: str = "sample_id", seed: int = 42, ties: Sequence[str] = ()) -> Column:
    """A struct-valued scalar: for each name the shuffle key at that 1-based rank.

    A rank is a Column over ``total`` (the row count); a rank outside 1..total
    gives null. Cost: two scans of the id column (and ``ties``). If rows with
    one key stand on both sides of a rank, no key can cut there: an error.
    """
    keys = df.select(shuffle_key(id_col, seed, ties).alias("key")).withColumn(
        "bucket", F.substring("key", 1, BUCKET_DIGITS)
    )
    wanted = F.explode(F.array(*[F.struct(F.lit(k).alias("name"), r.cast("bigint").alias("rank")) for k, r in ranks.items()]))
    cuts = (
        _bucket_counts(keys)
        .select("bucket", "before", "n", wanted.alias("w"))
        .where((F.col("w.rank") > F.col("before")) & (F.col("w.rank") <= F.col("before") + F.col("n")))
        .select("bucket", F.col("w.name").alias("name"), (F.col("w.rank") - F.col("before")).alias("nth"))
    )
    # one row per rank asked for, so the broadcast has a fixed size
    inside = keys.join(F.broadcast(cuts), "bucket")
    place = F.row_number().over(Window.partitionBy("name").orderBy("key"))
    upto = F.count(F.lit(1)).over(Window.partitionBy("name").orderBy("key").rangeBetween(Window.unboundedPreceding, Window.currentRow))
    found = inside.select("name", "key", "nth", place.alias("place"), upto.alias("upto")).where(F.col("place") == F.col("nth"))
    shared = F.raise_error(F.lit(f"rows with the same {id_col} stand at the cut; name columns in `ties` that tell them apart"))
    found = found.withColumn("key", F.when(F.col("upto") == F.col("nth"), F.col("key")).otherwise(shared.cast("string")))
    return found.agg(
        F.struct(*[F.max(F.when(F.col("name") == k, F.col("key"))).alias(k) for k in ranks]).alias("cut")
    ).scalar()


def global_rank(df: DataFrame, id_col: str = "sample_id", seed: int = 42, out: str = "rank") -> DataFrame:
    """Add the 1-based global rank in shuffle order.

    One shuffle by bucket; the bucket offsets are a bounded broadcast. No task
    sorts more than about 1/65,536 of the rows.
    """
    keyed = df.withColumn("_key", shuffle_key(id_col, seed)).withColumn(
        "_bucket", F.substring("_key", 1, BUCKET_DIGITS)
    )
    offsets = _bucket_counts(keyed.select(F.col("_bucket").alias("bucket"))).select(
        F.col("bucket").alias("_bucket"), F.col("before").alias("_before")
    )
    inside = F.row_number().over(Window.partitionBy("_bucket").orderBy("_key", id_col))
    return (
        keyed.join(F.broadcast(offsets), "_bucket")
        .withColumn(out, inside + F.col("_before"))
        .drop("_bucket", "_key", "_before")
    )


def numbered(df: DataFrame, order: str, out: str = "number") -> DataFrame:
    """Add the 1-based place in the order of a column: places within ranges, and the rows before each range."""
    ranges = positioned(df, [], order)
    sizes = ranges.groupBy(POSITION).agg(F.count(F.lit(1)).alias("_n"))
    # one row per task that wrote a range
    before = sizes.select(POSITION, (F.sum("_n").over(Window.orderBy(POSITION)) - F.col("_n")).alias("_before"))
    inside = F.row_number().over(Window.partitionBy(POSITION).orderBy(order))
    placed = ranges.withColumn("_place", inside).join(before, POSITION)
    return placed.withColumn(out, F.col("_place") + F.col("_before")).drop(POSITION, "_place", "_before")


def batch_number(df: DataFrame, batch_size: int, id_col: str = "sample_id", seed: int = 42) -> DataFrame:
    """Add ``batch``: rows in shuffle order, ``batch_size`` at a time, from 0."""
    ranked = global_rank(df, id_col, seed, out="_rank")
    return ranked.withColumn("batch", F.floor((F.col("_rank") - 1) / F.lit(batch_size)).cast("bigint")).drop("_rank")
