"""Prepared split sets, named tables and the evaluation-set resolver."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from proseframe.operators.cleaning import rename_columns
from proseframe.operators.splits import sample_exact
from proseframe.schemas import SPLITS
from proseframe.sources.samples import FORMATS, read_samples


def read_split(spark: SparkSession, path: str, split: str = "test") -> DataFrame:
    """One split of a prepared set; a missing one is replaced by the first there is.

    ``split`` is a partition column, so only that folder is scanned.
    """
    table = spark.read.parquet(path)
    wanted = table.where(F.col("split") == split)
    if not wanted.isEmpty():
        return wanted
    # the standard splits in their order, then others by name
    place = F.coalesce(F.array_position(F.array(*[F.lit(s) for s in SPLITS]), F.col("split")), F.lit(0))
    place = F.when(place == 0, len(SPLITS) + 1).otherwise(place)
    first = table.select("split").agg(F.min(F.struct(place.alias("place"), F.col("split").alias("split"))).alias("s")).first()["s"]
    return wanted if first is None else table.where(F.col("split") == first["split"])


def load_named(
    spark: SparkSession,
    name: str,
    subset: str | None = None,
    split: str | None = None,
    text_col: str = "text",
    label_col: str | None = None,
) -> DataFrame:
    """A catalog table, or Parquet under ``name/subset``, with standard column names."""
    in_catalog = "/" not in name and spark.catalog.tableExists(name)
    table = spark.table(name) if in_catalog else spark.read.parquet(name if in_catalog or not subset else os.path.join(name, subset))
    if subset and "subset" in table.columns:
        table = table.where(F.col("subset") == subset)
    if split:
        if "split" not in table.columns:
            raise ValueError(f"{name!r} has no split column")
        table = table.where(F.col("split") == split)
    return rename_columns(table, text_col, label_col)


def resolve_dataset(
    spark: SparkSession,
    source: str,
    text_col: str = "text",
    label_col: str | None = None,
    split: str = "test",
    sample_size: int | None = None,
    seed: int = 42,
    id_col: str = "sample_id",
) -> DataFrame:
    """A data file, a prepared directory or a table, then an exact seeded sample."""
    suffix = os.path.splitext(source.rstrip("/"))[1].lower().lstrip(".")
    if suffix in FORMATS:
        data, _ = read_samples(spark, source, text_col, label_col, id_col=None if id_col == "sample_id" else id_col)
        data = data if id_col == "sample_id" else data.withColumnRenamed("sample_id", id_col)
    elif "/" in source:
        data = rename_columns(read_split(spark, source, split), text_col, label_col)
    else:
        data = load_named(spark, source, None, split, text_col, label_col)
    return sample_exact(data, sample_size, id_col, seed)
