"""Running best and early stop of many runs in Spark's keyed state."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from proseframe.streaming.jobs import _start

STATE = "best double, evals bigint, last_reset bigint, last_seq bigint, stop_at bigint, last_ms bigint"


def _scanned(values: np.ndarray, best: float, evals: int, last_reset: int, threshold: float, greater_is_better: bool):
    """Running values after rows in order; NaN is a row without the metric, ``best`` NaN and ``last_reset`` -1 if there is none yet."""
    keep = np.fmax if greater_is_better else np.fmin
    after = keep.accumulate(np.append(best, values))
    prior, there = after[:-1], ~np.isnan(values)
    with np.errstate(invalid="ignore"):
        wins = values > prior if greater_is_better else values < prior
        far = np.abs(values - prior) > threshold
    is_best = there & (np.isnan(prior) | wins)
    count = evals + np.cumsum(there)
    reset = np.where(there & (np.isnan(prior) | wins & far), count, -1)
    last = np.maximum.accumulate(np.append(last_reset, reset))[1:]
    return is_best, after[1:], count, last


def run_states(
    log: DataFrame,
    metric: str = "eval_loss",
    greater_is_better: bool = False,
    patience: int = 3,
    threshold: float = 0.001,
    run: str = "run_id",
    order: str = "log_seq",
    ts: str | None = None,
    idle: str | None = None,
) -> DataFrame:
    """A stream of log rows with running best and strikes, each run's state kept by Spark.

    Columns: ``run``, ``order``, ``metric``, is_best, best_so_far, strikes,
    stop_at, is_late, is_closed. A row not newer than the last one of its run in
    an earlier micro-batch is late: it is marked and changes nothing. With
    ``idle`` (an interval) and ``ts`` a run whose last row is older than the
    watermark by that much is closed: a row with is_closed tells its last
    position, best and stop, and its state goes; rows before the watermark are
    dropped, and a run that comes back begins anew.

    A run's rows of one micro-batch are sorted in one task, so bound a
    micro-batch at its source; where one run holds most of a log,
    :func:`proseframe.streaming.jobs.stream_running_best` scans it in chunks. A
    null metric, and NaN, is a row without the metric. A null run is a run.
    """
    if (ts is None) != (idle is None):
        raise ValueError("give both ts and idle or neither")
    kind = dict(log.dtypes)[run]
    wanted = log.select(F.col(run), F.col(order).cast("bigint").alias(order), F.col(metric).cast("double").alias(metric), *([F.col(ts)] if ts else []))
    out = f"`{run}` {kind}, `{order}` bigint, `{metric}` double, is_best boolean, best_so_far double, strikes bigint, stop_at bigint, is_late boolean, is_closed boolean"
    wait = int(pd.Timedelta(idle).total_seconds() * 1000) if idle else 0

    names = [run, order, metric, "is_best", "best_so_far", "strikes", "stop_at", "is_late", "is_closed"]

    def frame(key, seq, *columns) -> pd.DataFrame:
        """Plain arrays, and one frame a call: most runs have few rows, so making frames is most of the work."""
        keys = np.full(len(seq), key[0], dtype=object)
        return pd.DataFrame(dict(zip(names, [keys, seq, *columns])), copy=False)

    def nothing(n: int) -> np.ndarray:
        return np.full(n, None, dtype=object)

    def advance(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        best, evals, last_reset, last_seq, stop_at, last_ms = state.get if state.exists else (None, 0, -1, None, None, 0)
        if state.hasTimedOut:
            state.remove()
            one = [[last_seq], [None], [None], [best], [evals - last_reset if last_reset >= 0 else 0], [stop_at], [False], [True]]
            yield frame(key, *[np.array(c, dtype=object) for c in one])
            return
        parts = list(batches)
        at = np.concatenate([p[order].to_numpy(dtype="int64") for p in parts])
        given = np.concatenate([p[metric].to_numpy(dtype="float64", na_value=np.nan) for p in parts])
        if ts:
            last_ms = max(last_ms, *[int(p[ts].max().timestamp() * 1000) for p in parts])
        sort = np.argsort(at, kind="stable")
        at, given = at[sort], given[sort]
        n_old = int(np.searchsorted(at, last_seq, side="right")) if last_seq is not None else 0
        is_best, running, strikes, marks = (nothing(len(at)) for _ in range(4))
        marks[:n_old] = stop_at
        if n_old < len(at):
            found, best_after, count, last = _scanned(given[n_old:], np.nan if best is None else best, evals, last_reset, threshold, greater_is_better)
            struck = np.where(last >= 0, count - last, 0)
            stops = np.flatnonzero(struck >= patience)
            marks[n_old:] = stop_at
            if stop_at is None and len(stops):
                stop_at = int(at[n_old + stops[0]])
                marks[n_old:][at[n_old:] >= stop_at] = stop_at
            is_best[n_old:], strikes[n_old:], running[n_old:] = found, struck, best_after
            best = None if np.isnan(best_after[-1]) else float(best_after[-1])
            evals, last_reset, last_seq = int(count[-1]), int(last[-1]), int(at[-1])
        yield frame(key, at, given, is_best, running.astype("float64"), strikes, marks, np.arange(len(at)) < n_old, np.zeros(len(at), dtype=bool))
        state.update((best, evals, last_reset, last_seq, stop_at, last_ms))
        if ts:
            state.setTimeoutTimestamp(max(last_ms + wait, state.getCurrentWatermarkMs() + 1))

    timeout = GroupStateTimeout.EventTimeTimeout if ts else GroupStateTimeout.NoTimeout
    return wanted.groupBy(run).applyInPandasWithState(advance, out, STATE, "append", timeout)


def stream_run_states(log: DataFrame, out: str, checkpoint: str, once: bool = False, **options) -> StreamingQuery:
    """:func:`run_states` as a Parquet folder; the state lies in the checkpoint, each input row is written once."""
    rows = run_states(log, **options)
    return _start(rows.writeStream.format("parquet").option("path", out).outputMode("append"), checkpoint, once)
