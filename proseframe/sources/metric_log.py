"""Metric logs as JSON Lines, in batch or as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from proseframe.schemas import METRIC_LOG


def read_metric_log(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """Log entries with a declared schema; a missing loss is null, not 0.

    A stream picks up new files, not lines appended to an old one.
    """
    reader = spark.readStream if stream else spark.read
    return reader.schema(METRIC_LOG).json(path)


def append_metric_log(log: DataFrame, path: str) -> None:
    log.write.mode("append").json(path)


def number_entries(log: DataFrame) -> DataFrame:
    """Fill ``run_id`` (from the file's folder) and ``log_seq`` (line order) where a log has neither."""
    folder = F.regexp_extract(F.col("_metadata.file_path"), "([^/]+)/[^/]+$", 1)
    return log.withColumn("run_id", F.coalesce("run_id", folder)).withColumn(
        "log_seq", F.coalesce("log_seq", F.monotonically_increasing_id())
    )
