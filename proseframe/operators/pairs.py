"""Joins that put predictions, references and outputs of several models side by side."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from proseframe.session import write_through


def pair(predictions: DataFrame, references: DataFrame, on: str = "row_id", strict: bool = False) -> DataFrame:
    """Join predictions to references by id.

    ``strict`` turns a row without a partner into an error when the plan runs,
    within the same join (no extra counting pass), and an id that either side
    repeats too. Without it, ids must be unique; see ``pairing_report``.
    """
    if not strict:
        return predictions.join(references, on)
    # a window on the join's own key needs no shuffle of its own
    per_id = Window.partitionBy(on)
    left = predictions.withColumn("_has_prediction", F.count(F.lit(1)).over(per_id))
    right = references.withColumn("_has_reference", F.count(F.lit(1)).over(per_id))
    joined = left.join(right, on, "full_outer")
    complete = (F.col("_has_prediction") == 1) & (F.col("_has_reference") == 1)
    message = F.concat(F.lit(f"{on} repeated or without a partner: "), F.col(on).cast("string"))
    checked = F.when(complete, F.col(on)).otherwise(F.raise_error(message))
    return joined.withColumn(on, checked).drop("_has_prediction", "_has_reference")


def positioned_rows(df: DataFrame, *order: str) -> DataFrame:
    """``df`` with ``position``: 0, 1, ... in the order of the columns, ties in any order.

    Rows are sorted in ranges and written once with their place in the range;
    only the ranges' row counts are added up.
    """
    ranges = df.repartitionByRange(*order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    written = write_through(ranges.withColumns({"_range": F.spark_partition_id(), "_place": place}), "positions")
    counts = written.groupBy("_range").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("_range", (F.sum("n").over(Window.orderBy("_range")) - F.col("n")).alias("_before"))
    return written.join(before, "_range").withColumn("position", F.col("_before") + F.col("_place")).drop("_range", "_place", "_before")


def pair_by_position(predictions: DataFrame, references: DataFrame, prediction_order: str | list[str], reference_order: str | list[str]) -> DataFrame:
    """(position, prediction, reference): the nth prediction beside the nth reference, each in its own order.

    Unequal numbers of rows are an error when the plan runs.
    """

    def side(df: DataFrame, order, column: str) -> DataFrame:
        order = [order] if isinstance(order, str) else order
        return positioned_rows(df.select(column, *[F.col(c).alias(f"_by{i}") for i, c in enumerate(order)]), *[f"_by{i}" for i in range(len(order))]).select(
            "position", column, F.lit(True).alias(f"_{column}")
        )

    joined = side(predictions, prediction_order, "prediction").join(side(references, reference_order, "reference"), "position", "full_outer")
    lone = F.col("_prediction").isNull() | F.col("_reference").isNull()
    message = F.raise_error(F.lit("as many predictions as references are needed")).cast("bigint")
    return joined.select(F.when(lone, message).otherwise(F.col("position")).alias("position"), "prediction", "reference")


def pairing_report(predictions: DataFrame, references: DataFrame, on: str = "row_id") -> DataFrame:
    """One row: ids on one side only and ids given more than once."""
    sides = predictions.select(on, F.lit(1).alias("p"), F.lit(0).alias("r")).unionByName(
        references.select(on, F.lit(0).alias("p"), F.lit(1).alias("r"))
    )
    per_id = sides.groupBy(on).agg(F.sum("p").alias("p"), F.sum("r").alias("r"))
    return per_id.agg(
        F.count_if((F.col("p") > 0) & (F.col("r") == 0)).alias("n_without_reference"),
        F.count_if((F.col("p") == 0) & (F.col("r") > 0)).alias("n_without_prediction"),
        F.count_if((F.col("p") > 1) | (F.col("r") > 1)).alias("n_repeated"),
        F.count_if((F.col("p") > 0) & (F.col("r") > 0)).alias("n_paired"),
    )


def with_prediction(pairs: DataFrame) -> DataFrame:
    """Rows that have a prediction; an empty string counts as one."""
    return pairs.where(F.col("prediction").isNotNull())


def side_by_side(completions: DataFrame, models: list[str] | None = None, key: str = "prompt_id", model_col: str = "provider") -> DataFrame:
    """One row per prompt and one output column per model (all that occur, if none are listed).

    Absent outputs are null. Two different outputs of one model for one prompt are an error.
    """
    wide = completions.groupBy(key)
    wide = wide.pivot(model_col, models) if models else wide.pivot(model_col)
    low, high = F.min("output"), F.max("output")
    message = F.concat(F.lit(f"{key} with several outputs of a {model_col}: "), F.first(F.col(key)).cast("string"))
    return wide.agg(F.when(low == high, low).when(low.isNull(), low).otherwise(F.raise_error(message)))


def beside_local(local: DataFrame, remote: DataFrame, on: str = "prompt_id") -> DataFrame:
    """Local outputs with the remote ones where there are any."""
    return local.join(remote.select(on, F.col("output").alias("remote_output")), on, "left")
