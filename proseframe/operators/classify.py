"""Classification metrics from a confusion table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def confusion(pairs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Row counts per (reference, prediction); the only step that reads the pairs."""
    return pairs.groupBy(*by, "reference", "prediction").agg(F.count(F.lit(1)).alias("n"))


def _or_zero(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def class_report(pairs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 and support of every class seen on either side."""
    n = F.col("n")
    hit = F.when(F.col("reference") == F.col("prediction"), n).otherwise(0)
    sides = F.explode(
        F.array(
            F.struct(F.col("reference").alias("class"), n.alias("support"), F.lit(0).cast("bigint").alias("predicted"), hit.alias("hit")),
            F.struct(F.col("prediction").alias("class"), F.lit(0).cast("bigint").alias("support"), n.alias("predicted"), F.lit(0).cast("bigint").alias("hit")),
        )
    )
    counts = (
        confusion(pairs, by)
        .select(*by, sides.alias("s"))
        .groupBy(*by, F.col("s.class").alias("class"))
        .agg(F.sum("s.support").alias("support"), F.sum("s.predicted").alias("predicted"), F.sum("s.hit").alias("hit"))
    )
    precision = _or_zero(F.col("hit"), F.col("predicted"))
    recall = _or_zero(F.col("hit"), F.col("support"))
    f1 = _or_zero(2 * F.col("hit"), F.col("predicted") + F.col("support"))
    return counts.select(
        *by, "class", precision.alias("precision"), recall.alias("recall"), f1.alias("f1"), "support", "hit"
    )


def weighted_report(pairs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1."""
    support = F.col("support")
    means = [
        _or_zero(F.sum(F.col(m) * support), F.sum(support)).alias(m) for m in ("precision", "recall", "f1")
    ]
    accuracy = _or_zero(F.sum("hit"), F.sum(support)).alias("accuracy")
    return class_report(pairs, by).groupBy(*by).agg(accuracy, *means)


def classification_report(pairs: DataFrame, labels: Sequence[str] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """The weighted metrics; with ``labels`` also ``precision_x``, ``recall_x``, ``f1_x`` per label.

    A label never seen gets 0, a seen class outside ``labels`` gets no column.
    """
    if not labels:
        return weighted_report(pairs, by)
    support = F.col("support")
    wide = [_or_zero(F.sum("hit"), F.sum(support)).alias("accuracy")]
    wide += [_or_zero(F.sum(F.col(m) * support), F.sum(support)).alias(m) for m in ("precision", "recall", "f1")]
    for label in labels:
        for m in ("precision", "recall", "f1"):
            value = F.max(F.when(F.col("class") == F.lit(label), F.col(m)))
            wide.append(F.coalesce(value, F.lit(0.0)).alias(f"{m}_{label}"))
    return class_report(pairs, by).groupBy(*by).agg(*wide)
