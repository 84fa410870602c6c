"""Prompt lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from proseframe.functions.text import strip


def prompts_from_lines(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Strip the lines and drop the empty ones; ids follow the line order."""
    return lines.select(
        F.monotonically_increasing_id().alias("prompt_id"), strip(value_col).alias("prompt")
    ).where(F.col("prompt") != "")


def read_prompts(spark: SparkSession, path: str) -> DataFrame:
    return prompts_from_lines(spark.read.text(path))
