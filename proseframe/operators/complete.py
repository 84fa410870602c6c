"""Batch completion with retries, pacing and provider fallback.

The completion function is the caller's. It runs inside ``mapInPandas``: Spark
partitions the prompts, so the partition count bounds the number of calls in
flight. Spark may repeat a task, so a function with side effects must tolerate
repeats, and a result used twice should be written first.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proseframe.functions.text import first_filled
from proseframe.schemas import COMPLETION
from proseframe.session import exists, write_through

Fn = Callable[..., Sequence[str | None]]

# The provider order where the caller gives none.
PROVIDERS = ("openai", "openrouter", "local")


class RateLimited(Exception):
    """The service asks to slow down; the wait doubles with every attempt."""


class ServiceError(Exception):
    """The service answered with an error; the wait is one second."""


def call_with_retry(
    fn: Fn, prompts: list[str], options: dict, max_retries: int, sleep: Callable[[float], None]
) -> tuple[list[str | None], int, str | None]:
    """(outputs, attempts, error). All outputs are null after the last failure."""
    error = None
    for attempt in range(max_retries):
        try:
            outputs = list(fn(prompts, **options))
            if len(outputs) != len(prompts):
                raise ValueError(f"{len(prompts)} prompts but {len(outputs)} outputs")
            return [None if o is None else o.strip() for o in outputs], attempt + 1, None
        except Exception as exc:  # noqa: BLE001 - whatever the caller's function raises is retried
            error = f"{type(exc).__name__}: {exc}"
            if isinstance(exc, RateLimited):
                sleep(2**attempt)
            elif attempt < max_retries - 1:
                sleep(1 if isinstance(exc, ServiceError) else 2**attempt)
    return [None] * len(prompts), max_retries, error


class Bucket:
    """A token bucket: at most ``burst`` calls at once and ``rate`` a second on average."""

    def __init__(self, rate: float, burst: int = 1, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        if rate <= 0 or burst < 1:
            raise ValueError("rate and burst must be positive")
        self.rate, self.burst, self.clock, self.sleep = rate, burst, clock, sleep
        self.tokens, self.at = float(burst), clock()

    def take(self) -> None:
        """Wait until a call may go out."""
        now = self.clock()
        self.tokens, self.at = min(self.burst, self.tokens + (now - self.at) * self.rate), now
        if self.tokens < 1:
            self.sleep((1 - self.tokens) / self.rate)
            now = self.clock()
            self.tokens, self.at = max(1.0, self.tokens + (now - self.at) * self.rate), now
        self.tokens -= 1


def ordered_providers(names: Sequence[str], prefer: str | None) -> list[str]:
    """The preferred provider first, the others in their order."""
    return sorted(names, key=lambda n: n != prefer)


def complete_with_fallback(
    prompts: DataFrame,
    providers: Sequence[tuple[str, Fn]] | Mapping[str, Fn],
    prefer: str | None = None,
    batch_size: int = 8,
    max_retries: int = 3,
    delay: float = 0.5,
    options: dict | None = None,
    sleep: Callable[[float], None] = time.sleep,
    carry: Sequence[str] = (),
    max_parallel: int | None = None,
    rate: float | None = None,
    burst: int = 1,
) -> DataFrame:
    """Try the providers in order; the first non-empty output of a prompt wins.

    A list gives the order itself; a mapping is tried in the order of ``PROVIDERS``.
    One pass over the prompts: a later provider sees only the prompts of the
    batch that are still empty. ``attempts`` and ``error`` are those of the last
    provider tried. All fail: ``output`` and ``provider`` are null. Columns
    named in ``carry`` come along, so that nothing has to be joined back.

    At most ``max_parallel`` tasks call at the same time; the prompts are
    written first, so that this bounds the calls and not the work before them.
    ``delay`` waits between the batches of a task; ``rate`` instead bounds the
    calls a second of all those tasks together (it needs ``max_parallel``), each
    task having its share in a token bucket of ``burst``.
    """
    if rate and not max_parallel:
        raise ValueError("a rate for all tasks needs max_parallel")
    table = dict(providers)
    names = list(table)
    if isinstance(providers, Mapping):
        names.sort(key=lambda n: PROVIDERS.index(n) if n in PROVIDERS else len(PROVIDERS))
    order = ordered_providers(names, prefer)
    options = dict(options or {})

    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        started, bucket = False, Bucket(rate / max_parallel, burst, sleep=sleep) if rate else None
        for pdf in batches:
            ids, texts = pdf["prompt_id"].tolist(), pdf["prompt"].tolist()
            rows = []
            for at in range(0, len(ids), batch_size):
                part = list(range(at, min(at + batch_size, len(ids))))
                done = {i: (None, None, 0, None) for i in part}
                for name in order:
                    todo = [i for i in part if not done[i][1]]
                    if not todo:
                        break
                    if bucket:
                        bucket.take()
                    elif started and delay > 0:
                        sleep(delay)
                    started = True
                    outputs, attempts, error = call_with_retry(
                        table[name], [texts[i] for i in todo], options, max_retries, sleep
                    )
                    for i, output in zip(todo, outputs):
                        # a lone provider may return '' as its answer; a fallback moves on from it
                        won = output is not None and (output != "" or len(order) == 1)
                        done[i] = (name if won else None, output if won else None, attempts, error)
                rows += [(ids[i], *done[i]) for i in part]
            answered = pd.DataFrame(rows, columns=["prompt_id", "provider", "output", "attempts", "error"])
            yield answered.assign(**{c: pdf[c].array for c in carry})

    sent = prompts.select("prompt_id", "prompt", *carry)
    carried = "".join(f", `{c}` {sent.schema[c].dataType.simpleString()}" for c in carry)
    result = f"prompt_id {sent.schema['prompt_id'].dataType.simpleString()}, {COMPLETION}{carried}"
    if max_parallel:
        sent = write_through(sent, "prompts").coalesce(max_parallel)
    return sent.mapInPandas(run, result)


def complete(prompts: DataFrame, fn: Fn, provider: str = "local", **settings) -> DataFrame:
    """Completion by one function; settings as in ``complete_with_fallback``.

    Rows keep the provider's name even where the call failed.
    """
    done = complete_with_fallback(prompts, [(provider, fn)], **settings)
    return done.withColumn("provider", F.lit(provider))


LEDGER = "prompt_key string, provider string, output string, attempts int"


def complete_with_ledger(prompts: DataFrame, fn: Fn, ledger: str, model: str = "local", **settings) -> DataFrame:
    """(prompt_id, provider, output, attempts, error) for all prompts, each distinct one asked at most once over all runs.

    ``ledger`` is a folder to which every run adds what was answered, by a hash
    of the model and the prompt, before it returns. A later run, also one after
    a failure, asks only what is not there; prompts without an answer are tried
    again and have the error of this run. Prompts that repeat are asked once.
    The prompts meet the ledger in a join on the hash; texts go along only with
    those that are asked. A null prompt is asked as it stands, once. Runs on one
    ledger must follow each other.
    """
    spark = prompts.sparkSession
    key = F.sha2(F.concat_ws("\n", F.lit(model), F.coalesce(F.concat(F.lit("="), "prompt"), F.lit("-"))), 256)
    keyed = prompts.withColumn("prompt_key", key)

    def answers() -> DataFrame:
        return spark.read.schema(LEDGER).option("recursiveFileLookup", True).parquet(ledger)

    known = answers() if exists(spark, ledger) else spark.createDataFrame([], LEDGER)
    # of prompts that repeat the text is taken from any, after the join has thrown out the answered ones
    asked = keyed.join(known.select("prompt_key"), "prompt_key", "left_anti").groupBy("prompt_key").agg(F.first("prompt").alias("prompt"))
    done = complete(asked.select(F.col("prompt_key").alias("prompt_id"), "prompt"), fn, model, **settings)
    done = write_through(done.withColumnRenamed("prompt_id", "prompt_key"), "completions")
    won = done.where(F.col("error").isNull() & F.col("output").isNotNull())
    won.select("prompt_key", "provider", "output", "attempts").write.mode("append").parquet(ledger)
    failed = done.join(won.select("prompt_key"), "prompt_key", "left_anti").select("prompt_key", "provider", F.col("output"), "attempts", "error")
    told = answers().withColumn("error", F.lit(None).cast("string")).unionByName(failed)
    return keyed.select("prompt_id", "prompt_key").join(told, "prompt_key").drop("prompt_key")


def fallback_from_columns(df: DataFrame, providers: Sequence[str], prefer: str | None = None) -> DataFrame:
    """The same choice over provider columns that exist already."""
    order = ordered_providers(providers, prefer)
    winner = None
    for name in order:
        filled = F.col(name).isNotNull() & (F.col(name) != "")
        winner = F.when(filled, F.lit(name)) if winner is None else winner.when(filled, F.lit(name))
    return df.withColumn("output", first_filled(*order)).withColumn("winner", winner)
