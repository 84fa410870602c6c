"""Metric dispatch, model comparison, success rates and length tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proseframe.functions.text import char_count, word_count
from proseframe.operators.classify import classification_report
from proseframe.operators.text_metrics import generation_metrics

TEXT_TASKS = ("generation", "summarization", "completion")

# The metric names ranked higher-is-better in the strict list.
STRICT_HIGHER = ("accuracy", "f1", "precision", "recall", "bleu", "exact_match")
# Natural directions: these families are better when higher, counts are no metric.
HIGHER_FAMILIES = "^(accuracy|bleu|exact_match|(rouge[^_]*|precision|recall|f1)(_.*)?)$"
COUNTS = ("total_examples", "correct_examples", "total_tokens", "num_samples")


def to_long(wide: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Metric columns to ``(*by, metric, value)`` rows."""
    names = [c for c in wide.columns if c not in by]
    cells = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in names])
    return wide.select(*by, F.inline(cells))


def all_metrics(
    pairs: DataFrame,
    task_type: str = "generation",
    labels: Sequence[str] | None = None,
    extra: Sequence[Callable[[DataFrame], DataFrame]] = (),
    by: Sequence[str] = (),
    use_stemmer: bool = True,
) -> DataFrame:
    """Every metric of the task as long rows; ``extra`` functions return such rows too."""
    if task_type in TEXT_TASKS:
        wide = generation_metrics(pairs, by, use_stemmer)
    elif task_type == "classification":
        wide = classification_report(pairs, labels, by=by)
    else:
        raise ValueError(f"unknown task type: {task_type!r}")
    rows = to_long(wide, by)
    for fn in extra:
        rows = rows.unionByName(fn(pairs))
    return rows


def higher_is_better(metric: Column, direction: str = "natural") -> Column:
    if direction == "natural":
        return metric.rlike(HIGHER_FAMILIES)
    if direction == "strict_list":
        return metric.isin(*STRICT_HIGHER)
    raise ValueError(f"unknown direction rule: {direction!r}")


def compare_models(
    metric_values: DataFrame, direction: str = "natural", order_col: str = "model", directions: DataFrame | None = None
) -> DataFrame:
    """Best and worst model of every metric that all models have a value for (null and NaN are none).

    Equal values go to the model first in ``order_col``. ``directions``
    (metric, higher) overrides the rule for the metrics it lists. Fewer than
    two models is an error. Everything is a partial aggregation: no window and
    no gathering of a metric's rows.
    """
    values = metric_values.where(F.col("value").isNotNull() & ~F.isnan(F.col("value").cast("double")))
    if direction == "natural":
        values = values.where(~F.col("metric").isin(*COUNTS))
    rule = higher_is_better(F.col("metric"), direction)
    if directions is not None:
        values = values.join(directions.select("metric", F.col("higher").alias("_higher")), "metric", "left")
        rule = F.coalesce(F.col("_higher"), rule)
    cell = F.struct(F.lit(0.0).alias("k"), F.col(order_col).alias("o"), F.col("model").alias("m"), F.col("value").alias("v"))
    keyed = values.withColumn("_k", F.when(rule, -F.col("value")).otherwise(F.col("value")))
    n_models = metric_values.agg(F.count_distinct("model").alias("n")).scalar()
    best = F.min(cell.withField("k", F.col("_k")))
    worst = F.min(cell.withField("k", -F.col("_k")))
    table = keyed.groupBy("metric").agg(
        F.count_distinct("model").alias("_n"), best.alias("_best"), worst.alias("_worst")
    )
    enough = F.when(n_models < 2, F.raise_error(F.lit("need at least 2 models to compare"))).otherwise(n_models)
    return table.where(F.col("_n") == enough).select(
        "metric",
        F.col("_best.m").alias("best_model"),
        F.col("_best.v").alias("best_value"),
        F.col("_worst.m").alias("worst_model"),
        F.col("_worst.v").alias("worst_value"),
    )


def success_rate(completions: DataFrame, by: Sequence[str] = (), failed_text: str | None = None) -> DataFrame:
    """Share of rows with an output; no rows give null.

    ``failed_text`` names a sentinel that also counts as a failure.
    """
    ok = F.col("output").isNotNull()
    if failed_text is not None:
        ok = ok & (F.col("output") != failed_text)
    return completions.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_prompts"),
        F.count_if(ok).alias("n_success"),
        F.avg(ok.cast("double")).alias("success_rate"),
    )


def length_table(completions: DataFrame, model_col: str = "provider") -> DataFrame:
    """Two rows per model: word count and character count, total and mean."""
    rows = completions.where(F.col("output").isNotNull()).select(
        model_col, word_count("output").alias("w"), char_count("output").alias("c")
    )
    sums = rows.groupBy(model_col).agg(
        F.sum("w").cast("bigint").alias("ws"), F.avg("w").alias("wa"), F.sum("c").cast("bigint").alias("cs"), F.avg("c").alias("ca")
    )
    cells = F.array(
        F.struct(F.lit("Word Count").alias("metric"), F.col("ws").alias("total"), F.col("wa").alias("mean")),
        F.struct(F.lit("Character Count").alias("metric"), F.col("cs").alias("total"), F.col("ca").alias("mean")),
    )
    return sums.select(model_col, F.inline(cells))


def direct_length_comparison(outputs: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The two-row layout per prompt: one column per model beside the metric name."""
    def row(name: str, fn) -> Column:
        return F.struct(F.lit(name).alias("metric"), *[fn(c).alias(c) for c in columns])

    return outputs.select("prompt_id", F.inline(F.array(row("Word Count", word_count), row("Character Count", char_count))))
