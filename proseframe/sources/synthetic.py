"""Synthetic samples: text and label drawn independently by a seeded hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The texts and labels to draw from.
CHOICES = {
    "completion": (
        (
            "The weather today is",
            "I like to eat",
            "My favorite color is",
            "In the future, I want to",
            "The best way to learn is",
        ),
        (
            "sunny and warm",
            "pizza and ice cream",
            "blue like the ocean",
            "travel around the world",
            "by practicing every day",
        ),
    ),
    "classification": (
        (
            "This movie is amazing!",
            "I hate waiting in long lines.",
            "The food was okay, nothing special.",
            "Best day ever!",
            "This is terrible.",
            "Pretty good experience overall.",
        ),
        ("positive", "negative", "neutral"),
    ),
    "summarization": (
        (
            "Scientists have discovered a new species of fish in the deep ocean. The fish has unique bioluminescent properties.",
            "The company announced record profits this quarter, exceeding analyst expectations by 15%.",
            "Local residents are concerned about the new construction project affecting traffic in the downtown area.",
        ),
        (
            "New bioluminescent fish species discovered",
            "Company reports record quarterly profits",
            "Construction project raises traffic concerns",
        ),
    ),
}


def pick(options: tuple[str, ...], id_col: str, seed: int, purpose: str) -> Column:
    """One option per row, from 28 bits of md5 over seed, id and purpose."""
    digest = F.md5(F.concat(F.lit(f"{seed}-"), F.col(id_col).cast("string"), F.lit(f"-{purpose}")))
    number = F.conv(F.substring(digest, 1, 7), 16, 10).cast("bigint")
    return F.element_at(F.array(*[F.lit(o) for o in options]), (number % len(options) + 1).cast("int"))


def draw_samples(ids: DataFrame, task_type: str, seed: int = 42, id_col: str = "sample_id") -> DataFrame:
    """A text and a label for every id; an unknown task gives no rows."""
    if task_type not in CHOICES:
        return ids.select(id_col, F.lit("").alias("text"), F.lit("").alias("label")).where(F.lit(False))
    texts, labels = CHOICES[task_type]
    return ids.select(
        id_col, pick(texts, id_col, seed, "text").alias("text"), pick(labels, id_col, seed, "label").alias("label")
    )


def synthetic_samples(spark: SparkSession, n: int = 100, task_type: str = "completion", seed: int = 42) -> DataFrame:
    return draw_samples(spark.range(n).withColumnRenamed("id", "sample_id"), task_type, seed)
