"""Exact samples, splits and heads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from proseframe.operators.ranks import keys_at_ranks, shuffle_key
from proseframe.schemas import SPLITS


def check_ratios(train: float, val: float, test: float) -> None:
    if abs(train + val + test - 1.0) > 1e-6:
        raise ValueError("split ratios must sum to 1.0")


def sample_exact(df: DataFrame, n: int | None, id_col: str = "sample_id", seed: int = 42, ties: Sequence[str] = ()) -> DataFrame:
    """Exactly ``n`` rows without replacement, or all rows if there are no more than n.

    Where ids repeat, ``ties`` names further columns that tell the rows apart.

    The n-th shuffle key is found first, then one filter keeps the rows up to
    it: no sort, and no limit that would gather n rows in one task.
    """
    if not n:
        return df
    cut = keys_at_ranks(df, {"last": F.lit(n)}, id_col, seed, ties).getField("last")
    return df.where(cut.isNull() | (shuffle_key(id_col, seed, ties) <= cut))


def split_exact(
    df: DataFrame, train: float = 0.8, val: float = 0.1, test: float = 0.1, seed: int = 42, id_col: str = "sample_id", ties: Sequence[str] = ()
) -> DataFrame:
    """Add ``split`` with exactly ``floor(n*train)`` and ``floor(n*val)`` rows, the rest test.

    Two cut keys decide every row, so the rows themselves are never moved.
    """
    check_ratios(train, val, test)
    total = F.col("total").cast("double")
    n_train, n_val = F.floor(total * F.lit(float(train))), F.floor(total * F.lit(float(val)))
    cut = keys_at_ranks(df, {"train": n_train, "validation": n_train + n_val}, id_col, seed, ties)
    key = shuffle_key(id_col, seed, ties)
    split = (
        F.when(key <= cut.getField("train"), SPLITS[0])
        .when(key <= cut.getField("validation"), SPLITS[1])
        .otherwise(SPLITS[2])
    )
    return df.withColumn("split", split)


def hash_split_column(
    id_col: str = "sample_id", train: float = 0.8, val: float = 0.1, test: float = 0.1, seed: int = 42
) -> Column:
    """The stateless split: a threshold on the first eight hex digits of the shuffle key.

    Shares hold only in expectation, but a row's split depends on nothing but
    its id, so this form also serves streams.
    """
    check_ratios(train, val, test)
    key = F.substring(shuffle_key(id_col, seed), 1, 8)
    top = [f"{min(int(r * 2**32), 2**32 - 1):08x}" for r in (train, train + val)]
    return F.when(key < top[0], SPLITS[0]).when(key < top[1], SPLITS[1]).otherwise(SPLITS[2])


def split_hash(
    df: DataFrame, train: float = 0.8, val: float = 0.1, test: float = 0.1, seed: int = 42, id_col: str = "sample_id"
) -> DataFrame:
    return df.withColumn("split", hash_split_column(id_col, train, val, test, seed))


def first_k(df: DataFrame, k: int = 10, by: str = "split", order: str = "sample_id") -> DataFrame:
    """The first ``k`` rows per group; each task keeps only k per group before the shuffle."""
    place = F.row_number().over(Window.partitionBy(by).orderBy(order))
    return df.withColumn("_place", place).where(F.col("_place") <= k).drop("_place")


def split_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))
