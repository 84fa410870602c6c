"""Structured Streaming jobs; each has a batch twin it must agree with."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from proseframe.operators.cleaning import clean_samples
from proseframe.operators.scans import CHUNK, POSITION, key_constants, positioned
from proseframe.operators.splits import hash_split_column
from proseframe.operators.training_log import progress
from proseframe.session import remove
from proseframe.sources.samples import parse_json_lines


def _start(writer, checkpoint: str, once: bool) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def clean_and_split(samples: DataFrame, id_col: str = "sample_id", seed: int = 42, **ratios) -> DataFrame:
    """The stateless part: clean the text, drop empty rows, add the hash split."""
    out = clean_samples(samples)
    return out.withColumn("split", hash_split_column(id_col, seed=seed, **ratios))


def samples_from_json_lines(lines: DataFrame, text_col: str, id_col: str, label_col: str | None = None) -> DataFrame:
    """Stream rows of JSON Lines text to samples; bad lines keep their reason and a null text."""
    rows = parse_json_lines(lines, text_col, label_col, id_col)
    return rows.select(
        F.col("_id").alias("sample_id"), F.col("_text").alias("text"), F.col("_label").alias("label"), F.col("_reason").alias("reason")
    )


def stream_clean_split(
    samples: DataFrame, out: str, checkpoint: str, id_col: str = "sample_id", once: bool = False, **options
) -> StreamingQuery:
    """Write cleaned samples as Parquet partitioned by split; no state, no shuffle."""
    rows = clean_and_split(samples, id_col, **options)
    writer = rows.writeStream.format("parquet").partitionBy("split").option("path", out).outputMode("append")
    return _start(writer, checkpoint, once)


def stream_json_lines(
    lines: DataFrame, out: str, quarantine: str, checkpoint: str, text_col: str, id_col: str, label_col: str | None = None, once: bool = False, **options
) -> StreamingQuery:
    """Clean and split JSON Lines; lines without usable text go to ``quarantine`` with their reason.

    Each micro-batch overwrites its own folder on both sides, so a repeated batch changes nothing.
    """
    parsed = parse_json_lines(lines, text_col, label_col, id_col)

    def publish(batch: DataFrame, batch_id: int) -> None:
        good = batch.where(F.col("_reason").isNull())
        good = good.select(F.col("_id").alias("sample_id"), F.col("_text").alias("text"), F.col("_label").alias("label"))
        clean_and_split(good, **options).write.mode("overwrite").partitionBy("split").parquet(f"{out}/batch={batch_id}")
        bad = batch.where(F.col("_reason").isNotNull()).select(F.col("value").alias("raw"), F.col("_reason").alias("reason"))
        bad.write.mode("overwrite").parquet(f"{quarantine}/batch={batch_id}")

    return _start(parsed.writeStream.outputMode("append").foreachBatch(publish), checkpoint, once)


def _newest(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row of each group, of its newest version."""
    values = [c for c in rows.columns if c not in by]
    newest = rows.groupBy(*by).agg(F.max_by(F.struct(*values), "version").alias("_newest"))
    return newest.select(*by, *[F.col("_newest")[c].alias(c) for c in values]).where(F.col("version").isNotNull())


def latest_groups(spark: SparkSession, path: str, by: Sequence[str] = ()) -> DataFrame:
    """The newest row of every group written by ``stream_metrics``, from at most log2(micro-batches) + 1 tables."""
    rows = spark.read.option("recursiveFileLookup", True).parquet(path)
    return _newest(rows, by).drop("version")


def _level(batch_id: int) -> int:
    """How many tables the micro-batch is merged with: the trailing zeros of its number from 1."""
    return ((batch_id + 1) & -(batch_id + 1)).bit_length() - 1


def _merged_with(batch_id: int) -> list[str]:
    """Tables that stand before this micro-batch and go into its own, one of each lower level."""
    return [f"level-{k}-batch-{batch_id - (1 << k)}" for k in range(_level(batch_id))]


def stream_metrics(
    rows: DataFrame,
    out: str,
    checkpoint: str,
    metrics: Sequence[Column],
    by: Sequence[str] = (),
    once: bool = False,
) -> StreamingQuery:
    """Running aggregates; a micro-batch writes only the groups it changed, with its number as ``version``.

    Tables are merged like the digits of a binary counter: the table of
    micro-batch n takes in one of each level below the trailing zeros of n+1 and
    keeps each group's newest row. So a row is rewritten at most log2(n) times
    and about log2(n) + 1 tables stand at any time. What was merged is removed
    when the next micro-batch begins: the tables that a micro-batch reads are
    there until it has ended, so a repeated one writes the same, and a reader
    has a micro-batch's time to finish.
    """
    table = rows.groupBy(*by).agg(*metrics)

    def publish(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        for name in _merged_with(batch_id - 1) if batch_id else []:
            remove(session, f"{out}/{name}")
        changed = batch.withColumn("version", F.lit(batch_id).cast("bigint"))
        before = [f"{out}/{name}" for name in _merged_with(batch_id)]
        if before:
            changed = _newest(session.read.schema(changed.schema).parquet(*before).unionByName(changed), by)
        changed.write.mode("overwrite").parquet(f"{out}/level-{_level(batch_id)}-batch-{batch_id}")

    return _start(table.writeStream.outputMode("update").foreachBatch(publish), checkpoint, once)


STATE_COLUMNS = ("best", "best_at", "evals", "last_reset", "last_seq", "stop_at")


def _state_schema(run: str) -> str:
    return f"{run} string, best double, best_at bigint, evals bigint, last_reset bigint, last_seq bigint, stop_at bigint"


def advance_runs(
    batch: DataFrame,
    state: DataFrame | None,
    metric: str = "eval_loss",
    greater_is_better: bool = False,
    patience: int = 3,
    threshold: float = 0.001,
    run: str = "run_id",
    order: str = "log_seq",
    chunk: int | str | None = CHUNK,
) -> DataFrame:
    """The rows of one micro-batch with running best and strikes, continued from ``state``.

    Rows not newer than the state of their run are marked late and left out of
    the scan. Runs are scanned in chunks, so one hot run does not land in one task.
    """
    settings = (metric, threshold, greater_is_better, run, order, chunk)
    stop = F.when(F.col("strikes") >= patience, F.col(order))
    if state is None:
        fresh = progress(batch, *settings)
        return fresh.withColumn("is_late", F.lit(False)).withColumn("stop_mark", stop)
    known = key_constants(batch, state.select(run, "last_seq", "stop_at"), [run], order, chunk)
    known = known.withColumn("is_late", F.coalesce(F.col(order) <= F.col("last_seq"), F.lit(False)))
    fresh = progress(known.where(~F.col("is_late")), *settings, initial=state)
    rows = fresh.unionByName(known.where(F.col("is_late")), allowMissingColumns=True)
    return rows.withColumn("stop_mark", F.coalesce("stop_at", stop)).drop("last_seq", "stop_at")


def merge_state(
    state: DataFrame | None, rows: DataFrame, metric: str, greater_is_better: bool, run: str, order: str
) -> DataFrame:
    """State after a micro-batch: every part is a min or max, so old and new rows just aggregate."""
    fresh = rows.where(~F.col("is_late"))
    new = fresh.select(
        run,
        F.col(metric).alias("best"),
        F.when(F.col(metric).isNotNull(), F.col(order)).alias("best_at"),
        "evals",
        "last_reset",
        F.col(order).alias("last_seq"),
        F.col("stop_mark").alias("stop_at"),
    )
    sign = -1.0 if greater_is_better else 1.0
    key = F.when(F.col("best").isNotNull(), F.struct((F.col("best") * sign).alias("v"), F.col("best_at").alias("a")))
    both = new if state is None else state.select(run, *STATE_COLUMNS).unionByName(new)
    return (
        both.groupBy(run)
        .agg(
            F.min_by("best", key).alias("best"),
            F.min_by("best_at", key).alias("best_at"),
            F.max("evals").alias("evals"),
            F.max("last_reset").alias("last_reset"),
            F.max("last_seq").alias("last_seq"),
            F.min("stop_at").alias("stop_at"),
        )
    )


def stream_running_best(
    log: DataFrame,
    out: str,
    state_dir: str,
    checkpoint: str,
    metric: str = "eval_loss",
    greater_is_better: bool = False,
    patience: int = 3,
    threshold: float = 0.001,
    run: str = "run_id",
    order: str = "log_seq",
    chunk: int | str | None = CHUNK,
    once: bool = False,
) -> StreamingQuery:
    """Running best and early stop over a log stream.

    The state is a table with one row per run and one version per micro-batch.
    A micro-batch reads version n-1 and overwrites its own output and version
    n, so a repeated batch gives the same tables. Versions before n-1 are
    removed. Bound a micro-batch at its source (``maxFilesPerTrigger``).
    """

    def advance(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        schema = _state_schema(run)
        state = None
        if batch_id > 0:
            state = session.read.schema(schema).parquet(f"{state_dir}/version={batch_id - 1}")
        path = f"{out}/batch={batch_id}"
        width = chunk
        if chunk is None:  # written once, read by each of the scans below; the batch is never held in memory
            batch, width = positioned(batch, [run], order), POSITION
        rows = advance_runs(batch, state, metric, greater_is_better, patience, threshold, run, order, width).drop(POSITION)
        rows.write.mode("overwrite").parquet(path)
        written = session.read.schema(rows.schema).parquet(path)
        merged = merge_state(state, written, metric, greater_is_better, run, order)
        merged.write.mode("overwrite").parquet(f"{state_dir}/version={batch_id}")
        if batch_id > 1:  # a repeated batch reads version n-1 at most
            remove(session, f"{state_dir}/version={batch_id - 2}")

    return _start(log.writeStream.outputMode("append").foreachBatch(advance), checkpoint, once)
