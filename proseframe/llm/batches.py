"""Bounds on what a Python worker holds at a time."""

from __future__ import annotations

from pyspark.sql import SparkSession

BATCH_BYTES = 4 * 1024 * 1024


def small_batches(spark: SparkSession, most: int = BATCH_BYTES) -> None:
    """Let an Arrow batch hold at most ``most`` bytes or one row: texts may be very long.

    A session setting, because Spark reads it from there when it plans a query.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(most))
