"""Analysis of training-metric logs, any number of runs at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proseframe.operators.scans import CHUNK, POSITION, Running, key_minimum, positioned, running_values


def better(value: Column, best: Column, greater_is_better: bool = False) -> Column:
    return value > best if greater_is_better else value < best


def _mark_best(rows: DataFrame, metric: str, greater_is_better: bool) -> DataFrame:
    prior, value = F.col("_prior"), F.col(metric)
    is_best = value.isNotNull() & (prior.isNull() | better(value, prior, greater_is_better))
    return rows.withColumn("is_best", F.coalesce(is_best, F.lit(False))).withColumn(
        "best_so_far", F.when(F.col("is_best"), value).otherwise(prior)
    )


def running_best(
    log: DataFrame,
    metric: str = "eval_loss",
    greater_is_better: bool = False,
    run: str = "run_id",
    order: str = "log_seq",
    chunk: int | str | None = CHUNK,
) -> DataFrame:
    """Add ``is_best`` and ``best_so_far``.

    A row is best if its metric is the first of its run or strictly better than
    every earlier one; rows without the metric never are.
    """
    kind = "max" if greater_is_better else "min"
    values = {"_prior": Running(kind, F.col(metric), inclusive=False)}
    return _mark_best(running_values(log, values, [run], order, chunk), metric, greater_is_better).drop("_prior")


def progress(
    log: DataFrame,
    metric: str = "eval_loss",
    threshold: float = 0.001,
    greater_is_better: bool = False,
    run: str = "run_id",
    order: str = "log_seq",
    chunk: int | str | None = CHUNK,
    initial: DataFrame | None = None,
) -> DataFrame:
    """``running_best`` plus ``strikes``, ``evals`` and ``last_reset``.

    A row is a strike if there is an earlier best and it does not beat that best
    by more than the threshold. The strikes in a row are the number of the
    evaluation less the number of the last one that was no strike: two scans.
    ``initial`` (run, best, evals, last_reset) continues from an earlier state.
    """
    kind = "max" if greater_is_better else "min"
    given = log.columns
    if chunk is None:  # both scans work on one table of ranges
        log, chunk = positioned(log, [run], order), POSITION
    state = state2 = None
    if initial is not None:
        state = initial.select(run, F.col("best").alias("_prior"), "evals")
        state2 = initial.select(run, "last_reset")
    first = running_values(
        log,
        {"_prior": Running(kind, F.col(metric), inclusive=False), "evals": Running("count", F.col(metric))},
        [run],
        order,
        chunk,
        state,
    )
    value, prior = F.col(metric), F.col("_prior")
    beats = better(value, prior, greater_is_better) & (F.abs(value - prior) > F.lit(threshold))
    reset = F.when(value.isNotNull() & (prior.isNull() | beats), F.col("evals"))
    second = running_values(first, {"last_reset": Running("max", reset)}, [run], order, chunk, state2)
    marked = _mark_best(second, metric, greater_is_better).drop("_prior")
    marked = marked.withColumn("strikes", F.coalesce(F.col("evals") - F.col("last_reset"), F.lit(0)))
    return marked if POSITION in given else marked.drop(POSITION)


def early_stop(
    log: DataFrame,
    metric: str = "eval_loss",
    patience: int = 3,
    threshold: float = 0.001,
    greater_is_better: bool = False,
    run: str = "run_id",
    order: str = "log_seq",
    chunk: int | str | None = CHUNK,
) -> DataFrame:
    """Per run the position at which training stops, null if it never does."""
    rows = progress(log, metric, threshold, greater_is_better, run, order, chunk)
    stop = F.when(F.col("strikes") >= patience, F.col(order))
    return rows.groupBy(run).agg(
        F.min(stop).alias("stop_at"),
        F.min_by(metric, stop).alias("stop_value"),
        F.count(metric).alias("n_evals"),
    )


def last_known(
    log: DataFrame, metric: str = "eval_loss", run: str = "run_id", order: str = "log_seq", chunk: int | str | None = CHUNK
) -> DataFrame:
    """Add ``last_value``: the latest non-null value of the metric up to each row."""
    return running_values(log, {"last_value": Running("last", F.col(metric))}, [run], order, chunk)


def elapsed(
    log: DataFrame, ts: str = "ts", run: str = "run_id", epoch: str | None = "epoch", order: str = "log_seq", chunk: int | str | None = CHUNK
) -> DataFrame:
    """Add seconds since the run started and, with ``epoch``, since the epoch started."""
    seconds = F.unix_micros(F.col(ts).cast("timestamp")) / F.lit(1e6)
    given = log.columns
    if chunk is None:
        log, chunk = positioned(log, [run], order), POSITION
    out = key_minimum(log.withColumn("_s", seconds), F.col("_s"), "_start", [run], order, chunk)
    out = out.withColumn("total_time", F.col("_s") - F.col("_start")).drop("_start")
    if epoch:
        out = key_minimum(out, F.col("_s"), "_start", [run, epoch], order, chunk)
        out = out.withColumn("epoch_time", F.col("_s") - F.col("_start")).drop("_start")
    return out.drop("_s") if POSITION in given else out.drop("_s", POSITION)


def training_summary(log: DataFrame, run: str = "run_id", order: str = "log_seq") -> DataFrame:
    """One row per run: entries, last step and losses, best loss, total time."""
    def last(c: str) -> Column:
        return F.max_by(c, order)

    return log.groupBy(run).agg(
        F.count(F.lit(1)).alias("n_entries"),
        last("step").alias("total_steps"),
        last("train_loss").alias("final_train_loss"),
        last("eval_loss").alias("final_eval_loss"),
        F.min("eval_loss").alias("best_eval_loss"),
        F.max("total_time").alias("total_time_seconds"),
    )


def checkpoint_name(path: Column) -> Column:
    return F.substring_index(F.rtrim(path, F.lit("/")), "/", -1)


def checkpoint_step(path: Column) -> Column:
    """The integer after the first ``-`` of the last path part; 0 if there is none."""
    number = F.split_part(checkpoint_name(path), F.lit("-"), F.lit(2))
    return F.coalesce(number.try_cast("bigint"), F.lit(0))


def latest_checkpoint(manifest: DataFrame, run: str = "run_id", path: str = "path") -> DataFrame:
    """The checkpoint with the highest step per run; equal steps go to the first path by name."""
    named = manifest.where(checkpoint_name(F.col(path)).startswith("checkpoint-"))
    return (
        named.groupBy(run)
        .agg(F.min(F.struct((-checkpoint_step(F.col(path))).alias("k"), F.col(path).alias("p"))).alias("_m"))
        .select(run, F.col("_m.p").alias("path"), (-F.col("_m.k")).alias("step"))
    )
