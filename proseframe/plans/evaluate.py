"""Evaluation end to end: complete, pair, score, compare, report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proseframe.operators.cleaning import resolve_pair_columns
from proseframe.operators.compare import all_metrics, success_rate
from proseframe.operators.complete import Fn, complete
from proseframe.operators.pairs import with_prediction
from proseframe.operators.perplexity import perplexity_from_loss
from proseframe.operators.report import evaluation_report
from proseframe.session import write_through
from proseframe.sinks.writers import write_report


def predictions_for(dataset: DataFrame, fn: Fn, id_col: str = "sample_id", **settings) -> DataFrame:
    """``row_id, input, reference, prediction, error`` for a dataset and a completion function.

    Completions are written before use: they are read more than once and must
    not be asked for again.
    """
    rows = resolve_pair_columns(dataset).select(F.col(id_col).alias("row_id"), "input", "reference")
    prompts = rows.select(F.col("row_id").alias("prompt_id"), F.col("input").alias("prompt"), "input", "reference")
    done = write_through(complete(prompts, fn, carry=["input", "reference"], **settings), "completions")
    return done.select(F.col("prompt_id").alias("row_id"), "input", "reference", F.col("output").alias("prediction"), "error")


def evaluate_predictions(
    predictions: DataFrame,
    task_type: str = "generation",
    labels: Sequence[str] | None = None,
    losses: DataFrame | None = None,
    out: str | None = None,
    by: Sequence[str] = (),
    **settings,
) -> DataFrame:
    """Long metric rows, with perplexity and success rate among them; optionally a JSON report.

    ``by`` names columns (such as the model) for which each metric is computed apart.
    """
    pairs = with_prediction(predictions)
    metrics = all_metrics(pairs, task_type, labels, by=by, **settings)
    rate = success_rate(predictions.withColumn("output", F.col("prediction")), by)
    metrics = metrics.unionByName(rate.select(*by, F.lit("success_rate").alias("metric"), F.col("success_rate").alias("value")))
    if losses is not None:
        ppl = perplexity_from_loss(losses, by=by).select(*by, F.lit("perplexity").alias("metric"), F.col("perplexity").alias("value"))
        metrics = metrics.unionByName(ppl)
    if out:
        metrics = write_through(metrics, "metrics")
        write_report(evaluation_report(metrics, pairs, task_type), out)
    return metrics
