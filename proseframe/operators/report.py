"""Summaries and report documents as small tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proseframe.operators.ranks import numbered
from proseframe.operators.splits import first_k
from proseframe.schemas import SPLITS

RULE_WIDTH = 40
LISTING_RULE_WIDTH = 80


def _literal(value) -> Column:
    if isinstance(value, Mapping):
        return F.struct(*[_literal(v).alias(k) for k, v in value.items()])
    return F.lit(value)


def data_summary(df: DataFrame, options: Mapping) -> DataFrame:
    """One row: the given options (nested maps become structs) and rows per split."""
    sizes = [F.count_if(F.col("split") == s).alias(s) for s in SPLITS]
    counts = df.agg(*sizes)
    given = [_literal(v).alias(k) for k, v in options.items()]
    return counts.select(*given, F.struct(*SPLITS).alias("dataset_sizes"))


def inspection_samples(df: DataFrame, k: int = 10, order: str = "sample_id") -> DataFrame:
    return first_k(df, k, "split", order)


def evaluation_report(metrics: DataFrame, pairs: DataFrame, task_type: str, k: int = 10, order: str = "row_id") -> DataFrame:
    """One row: task, sample count, metric map and the first ``k`` predictions.

    ``metrics`` is a long table with one row per metric name, so its map stays small.
    """
    first = pairs.orderBy(order).limit(k).select(order, "input", "prediction", "reference")
    samples = first.agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct(order, "input", "prediction", "reference"))),
            lambda s: F.struct(s["input"].alias("input"), s["prediction"].alias("prediction"), s["reference"].alias("reference")),
        ).alias("samples")
    )
    table = metrics.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("metric", "value")))).alias("metrics"))
    return pairs.agg(F.count(F.lit(1)).alias("num_samples")).select(
        F.lit(task_type).alias("task_type"),
        "num_samples",
        table.scalar().alias("metrics"),
        samples.scalar().alias("sample_predictions"),
    )


def comparison_report(comparison: DataFrame, metric_values: DataFrame) -> DataFrame:
    """Per metric the best and worst model with every model's value.

    The map holds one entry per compared model.
    """
    values = metric_values.groupBy("metric").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("model", "value")))).alias("values")
    )
    return comparison.join(values, "metric")


def metric_lines(metrics: DataFrame, title: str, facts: Mapping[str, str]) -> DataFrame:
    """Text lines of the evaluation summary, values with four decimals."""
    head = [title, "=" * RULE_WIDTH, ""] + [f"{k}: {v}" for k, v in facts.items()] + ["", "Metrics:"]
    spark = metrics.sparkSession
    top = spark.createDataFrame([(i, "", line) for i, line in enumerate(head)], "line_no int, metric string, line string")
    body = metrics.select(
        F.lit(len(head)).alias("line_no"), "metric", F.format_string("  %s: %.4f", "metric", "value").alias("line")
    )
    lines = top.unionByName(body)
    return lines.select(F.concat(F.lpad(F.col("line_no").cast("string"), 6, "0"), "metric").alias("line_no"), "line")


def listing_lines(rows: DataFrame) -> DataFrame:
    """One text block per input with its outputs, numbered from 1 in the order of the ids."""
    rows = numbered(rows, "prompt_id")
    remote = F.when(F.col("remote_output").isNotNull(), F.concat(F.lit("\nRemote Output: "), F.col("remote_output")))
    return rows.select(
        "prompt_id",
        "number",
        F.concat(
            F.lit("Example "),
            F.col("number").cast("string"),
            F.lit(":\nInput: "),
            F.col("input"),
            F.lit("\nLocal Output: "),
            F.coalesce("local_output", F.lit("")),
            F.coalesce(remote, F.lit("")),
            F.lit("\n" + "-" * LISTING_RULE_WIDTH + "\n"),
        ).alias("line"),
    )
