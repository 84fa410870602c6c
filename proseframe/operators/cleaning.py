"""The cleaning pass and template projection over sample tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proseframe.functions.bind import computed_and_kept
from proseframe.functions.text import clean_text, template_column


def clean_samples(df: DataFrame, text_col: str = "text", label_col: str = "label", **options) -> DataFrame:
    """Clean the text, drop rows left empty, clean the label but keep its rows."""
    cleaned = computed_and_kept(clean_text(text_col, **options), lambda t: t != "")
    out = df.withColumn("_cleaned", cleaned).drop(text_col).withColumnRenamed("_cleaned", text_col)
    if label_col in df.columns:
        out = out.withColumn(label_col, clean_text(label_col))
    return out.select(*df.columns)


def cleaning_counts(df: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """Rows before and after cleaning, in one pass."""
    kept = F.count_if(clean_text(text_col, **options) != "")
    return df.agg(F.count(F.lit(1)).alias("n_before"), kept.alias("n_after"))


def render_template(df: DataFrame, template: str, out: str = "text") -> DataFrame:
    return df.withColumn(out, template_column(template))


def rename_columns(df: DataFrame, text_col: str = "text", label_col: str | None = None) -> DataFrame:
    """Rename to ``text`` / ``label`` where the source column exists."""
    for source, target in ((text_col, "text"), (label_col, "label")):
        if not source or source == target or source not in df.columns:
            continue
        if target in df.columns:
            raise ValueError(f"cannot rename {source!r}: a column {target!r} exists already")
        df = df.withColumnRenamed(source, target)
    return df


def resolve_pair_columns(df: DataFrame) -> DataFrame:
    """Add ``input`` and ``reference`` from the first known column that exists."""
    source = next((c for c in ("text", "input_text", "input") if c in df.columns), None)
    target = next((c for c in ("label", "target") if c in df.columns), None)
    if source is None:
        raise ValueError(f"no input column among {df.columns}")
    reference = F.col(target) if target else F.lit("")
    return df.withColumn("input", F.col(source)).withColumn("reference", reference)
