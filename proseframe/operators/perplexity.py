"""Perplexity from losses or from logits."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proseframe.functions.bind import bind

INFINITY = float("inf")


def perplexity_from_loss(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Token-weighted mean loss over ``loss`` / ``n_tokens`` rows and its exponential."""
    sums = df.groupBy(*by).agg(
        F.sum(F.col("loss") * F.col("n_tokens")).alias("_loss"),
        F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("total_tokens"),
    )
    avg_loss = F.when(F.col("total_tokens") > 0, F.try_divide(F.col("_loss"), F.col("total_tokens"))).otherwise(
        F.lit(INFINITY)
    )
    return sums.withColumn("avg_loss", avg_loss).select(
        *by, F.exp("avg_loss").alias("perplexity"), "avg_loss", "total_tokens"
    )


def cross_entropy(logits: Column, label: Column) -> Column:
    """``logsumexp(logits) - logits[label]``, shifted by the largest logit; one pass per step."""
    def shifted(w: Column, top: Column) -> Column:
        total = F.aggregate(w, F.lit(0.0), lambda acc, x: acc + F.exp(x - top))
        return top + F.ln(total) - F.get(w, label)

    wide = logits.cast("array<double>")
    return bind(wide, lambda w: bind(F.array_max(w), lambda top: shifted(w, top)))


def perplexity_from_logits(df: DataFrame, ignore_id: int = -100, by: Sequence[str] = ()) -> DataFrame:
    """``exp`` of the mean cross-entropy over labels other than ``ignore_id``; none left gives infinity.

    Labels are taken as given, not shifted. A label outside the logits is an
    error, as it is for the loss function itself.
    """
    label = F.col("label")
    bad = (label < 0) | (label >= F.size("logits"))
    ce = F.when(bad, F.raise_error(F.lit("label outside the logits"))).otherwise(cross_entropy(F.col("logits"), label))
    ce = F.when(label != ignore_id, ce)
    return df.groupBy(*by).agg(
        F.coalesce(F.exp(F.avg(ce)), F.lit(INFINITY)).alias("perplexity"), F.count(ce).alias("n_positions")
    )


def logit_chunks(df: DataFrame, row: str = "row_id", width: int = 4096) -> DataFrame:
    """(row, at, logits, label): rows of logits cut into pieces of ``width``, ``at`` the place of a piece's first logit."""
    starts = F.sequence(F.lit(0), F.greatest(F.size("logits") - 1, F.lit(0)), F.lit(width))
    pieces = df.select(row, "label", "logits", F.explode(starts).alias("at"))
    return pieces.select(row, "at", F.slice("logits", F.col("at") + 1, width).alias("logits"), "label")


def _top_and_total(logits: str) -> Column:
    """The largest value of an array and the sum of exp(value - largest)."""

    @F.pandas_udf("struct<top: double, total: double>")
    def found(batch: pd.Series) -> pd.DataFrame:
        arrays = [np.asarray(x, dtype=np.float64) if x is not None else np.zeros(0) for x in batch]
        tops = [x.max() if len(x) else -np.inf for x in arrays]
        return pd.DataFrame({"top": tops, "total": [np.exp(x - top).sum() if len(x) else 0.0 for x, top in zip(arrays, tops)]})

    return found(logits)


def perplexity_from_chunks(chunks: DataFrame, ignore_id: int = -100, by: Sequence[str] = (), row: str = "row_id") -> DataFrame:
    """The same from rows of logits in pieces (row, at, logits, label), in any order and on any tasks.

    A piece shrinks to its largest logit, the sum of exponentials below it, and
    the label's logit if it holds it. Such parts merge: a row's sum is that of
    its parts, each scaled by exp(part's largest - row's largest), so a row of
    any width needs no task of its own and no exponential overflows. A row's
    parts are few: its width over that of a piece. A label outside the pieces
    is an error.
    """
    label = F.col("label")
    kept = chunks.where(F.col("label") != ignore_id)
    inside = (label >= F.col("at")) & (label < F.col("at") + F.size("logits"))
    gold = F.when(inside, F.get("logits", (label - F.col("at")).cast("int")).cast("double"))
    parts = kept.select(row, *by, _top_and_total("logits").alias("p"), gold.alias("gold")).select(row, *by, "p.top", "p.total", "gold")
    merged = parts.groupBy(row, *by).agg(F.collect_list(F.struct("top", "total")).alias("parts"), F.max("top").alias("top"), F.max("gold").alias("gold"))
    total = F.aggregate("parts", F.lit(0.0), lambda acc, p: acc + p["total"] * F.exp(p["top"] - F.col("top")))
    known = F.when(F.col("gold").isNull(), F.raise_error(F.lit("label outside the logits")).cast("double")).otherwise(F.col("gold"))
    losses = merged.select(*by, (F.col("top") + F.ln(total) - known).alias("ce"))
    return losses.groupBy(*by).agg(F.coalesce(F.exp(F.avg("ce")), F.lit(INFINITY)).alias("perplexity"), F.count("ce").alias("n_positions"))
