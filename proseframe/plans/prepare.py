"""Preparation end to end: read, limit, clean, split, encode, write, summarise."""

from __future__ import annotations

import inspect
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession

from proseframe.operators.cleaning import clean_samples
from proseframe.operators.encode import encode_fixed_length
from proseframe.operators.report import data_summary, inspection_samples
from proseframe.operators.splits import sample_exact, split_exact
from proseframe.session import write_through
from proseframe.sinks.writers import write_report, write_samples_by_split, write_splits
from proseframe.sources.samples import read_samples


def prepared_splits(
    samples: DataFrame,
    train: float = 0.8,
    val: float = 0.1,
    test: float = 0.1,
    seed: int = 42,
    clean: bool = True,
    clean_options: Mapping | None = None,
    max_examples: int | None = None,
    id_col: str = "sample_id",
    durable: bool = True,
) -> DataFrame:
    """Limit, then clean, then split; the limit comes first, so fewer rows may remain.

    The cleaned table is written once, because finding the cut points and
    writing the result both read it.
    """
    data = sample_exact(samples, max_examples, id_col, seed)
    if clean:
        data = clean_samples(data, **dict(clean_options or {}))
    if durable:
        data = write_through(data, "cleaned")
    return split_exact(data, train, val, test, seed, id_col)


def prepare_dataset(
    spark: SparkSession,
    path: str,
    out: str,
    text_col: str = "text",
    label_col: str | None = None,
    fmt: str | None = None,
    vocabulary: DataFrame | None = None,
    tokenizer: Callable[[Column], Column] | None = None,
    max_length: int = 512,
    id_col: str | None = None,
    **options,
) -> DataFrame:
    """Prepare a file or directory into ``out``: splits, quarantine, summary, samples."""
    samples, quarantine = read_samples(spark, path, text_col, label_col, fmt, id_col=id_col)
    data = prepared_splits(samples, **options)
    if vocabulary is not None or tokenizer is not None:
        data = encode_fixed_length(data, vocabulary, tokenizer, max_length, keep_text=True)
    write_splits(data, f"{out}/data")
    quarantine.write.json(f"{out}/quarantine")
    result = spark.read.parquet(f"{out}/data")
    # all options at the values that took effect
    defaults = {n: p.default for n, p in inspect.signature(prepared_splits).parameters.items() if p.default is not p.empty}
    given = {**defaults, **options}
    plain = {k: v for k, v in given.items() if isinstance(v, (str, int, float, bool))}
    plain |= {f"clean_{k}": v for k, v in (given.get("clean_options") or {}).items()}
    facts = {"input_source": path, "processing": {**plain, "max_length": max_length}, "columns": {"text_column": text_col, "label_column": label_col}}
    write_report(data_summary(result, facts), f"{out}/summary")
    write_samples_by_split(inspection_samples(result), f"{out}/samples")
    return result
