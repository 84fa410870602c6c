"""Readers of labelled text: CSV, TSV, JSON arrays and JSON Lines.

Every reader returns (samples, quarantine). A record without usable text is
quarantined with a reason instead of failing the job; nothing is dropped
silently.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from proseframe.functions.text import strip
from proseframe.sources.records import parsed_records, read_json_objects, read_records

# Formats in the order a directory is searched.
FORMATS = ("csv", "json", "jsonl", "tsv")

_CORRUPT = "_corrupt_record"


def detect_format(path: str) -> str:
    suffix = os.path.splitext(path.rstrip("/"))[1].lower().lstrip(".")
    if suffix not in FORMATS:
        raise ValueError(f"unsupported file format: {suffix or path!r}")
    return suffix


def _glob(fmt: str | None) -> str | None:
    """A case-insensitive suffix pattern for directory scans."""
    return None if fmt is None else "*." + "".join(f"[{c}{c.upper()}]" for c in fmt)


def _is_directory_scan(path: str) -> bool:
    return os.path.splitext(path.rstrip("/"))[1].lower().lstrip(".") not in FORMATS


def find_format(spark: SparkSession, path: str) -> str:
    """The first format that has files in the directory; none is an error."""
    for fmt in FORMATS:
        listing = spark.read.format("binaryFile").option("pathGlobFilter", _glob(fmt)).load(path)
        # only the listing is read, never the content
        if listing.select("path").limit(1).count():
            return fmt
    raise ValueError(f"no data files in {path!r}")


def _split(rows: DataFrame, reason: Column, text: Column, label: Column, raw: Column, sample_id: Column):
    """Rows without a reason become samples, the others quarantine."""
    tagged = rows.withColumn("_reason", reason)
    samples = tagged.where(F.col("_reason").isNull()).select(
        sample_id.alias("sample_id"), strip(text).alias("text"), strip(label).alias("label")
    )
    quarantine = tagged.where(F.col("_reason").isNotNull()).select(
        F.col("_file").alias("source_file"), raw.alias("raw"), F.col("_reason").alias("reason")
    )
    return samples, quarantine


def _sample_id(id_col: str | None) -> Column:
    """The caller's key as it stands in the file, else a number fixed by file order and split sizes."""
    return F.col(id_col) if id_col else F.col("_row")


def _needs_id(reason: Column, id_col: str | None, key: Column) -> Column:
    """A record without the key it should have is quarantined."""
    return F.coalesce(reason, F.when(key.isNull(), F.lit("id missing"))) if id_col else reason


def _read_delimited(spark, path, text_col, label_col, id_col, sep, encoding, multi_line, glob):
    def reader():
        r = spark.read.option("header", True).option("sep", sep).option("quote", '"').option("escape", '"')
        r = r.option("encoding", encoding).option("multiLine", multi_line)
        return r.option("pathGlobFilter", glob) if glob else r

    names = reader().csv(path).columns
    if text_col not in names:
        raise ValueError(f"text column {text_col!r} not found in {path!r}")
    schema = ", ".join(f"`{n}` string" for n in names) + f", `{_CORRUPT}` string"
    rows = (
        reader()
        .schema(schema)
        .option("enforceSchema", False)
        .option("columnNameOfCorruptRecord", _CORRUPT)
        .csv(path)
        .select("*", F.col("_metadata.file_path").alias("_file"), F.monotonically_increasing_id().alias("_row"))
    )
    # an empty field reads as null; only in a row of the wrong length can the field be absent
    absent = F.col(_CORRUPT).isNotNull()
    reason = F.when(F.col(text_col).isNull() & absent, F.lit("text field missing"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    label = F.lit(None).cast("string")
    if label_col and label_col in names:
        label = F.when(F.col(label_col).isNull() & absent, None).otherwise(F.coalesce(F.col(label_col), F.lit("")))
    raw = F.coalesce(F.col(_CORRUPT), F.to_json(F.struct(*[F.col(f"`{n}`") for n in names])))
    return _split(rows, _needs_id(reason, id_col, _sample_id(id_col)), text, label, raw, _sample_id(id_col))


def _read_delimited_blocks(spark, path, text_col, label_col, id_col, sep, glob):
    """The same by blocks: one large file is read by many tasks, and each file's own header counts."""
    records = read_records(spark, path, sep, glob)
    wanted = list(dict.fromkeys([text_col] + [c for c in (label_col, id_col) if c]))
    rows = parsed_records(records, wanted, sep, _CORRUPT).withColumn("_row", F.monotonically_increasing_id()).withColumnRenamed("file", "_file")
    absent = F.col(_CORRUPT).isNotNull()
    reason = F.when(~F.col("closed"), F.lit("quoted field never ends")).when(F.col(text_col).isNull() & absent, F.lit("text field missing"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    label = F.when(F.col(label_col).isNull() & absent, None).otherwise(F.coalesce(F.col(label_col), F.lit(""))) if label_col else F.lit(None).cast("string")
    return _split(rows, _needs_id(reason, id_col, _sample_id(id_col)), text, label, F.col("record"), _sample_id(id_col))


def _read_json_blocks(spark, path, text_col, label_col, id_col, glob):
    """The same by blocks: one large array is read by many tasks."""
    rows = read_json_objects(spark, path, glob).select(F.col("record").alias("value"), F.col("file").alias("_file"), F.monotonically_increasing_id().alias("_row"))
    parsed = parse_json_lines(rows, text_col, label_col, id_col)
    reason = F.when(F.col("_reason") == "not a JSON object", F.lit("not parsable")).when(F.col("_reason").isin("text is null", "text key missing"), F.lit("text missing or null"))
    return _split(parsed, F.coalesce(reason, F.col("_reason")), F.col("_text"), F.col("_label"), F.col("value"), F.col("_id" if id_col else "_row"))


def _first_characters(spark, path, encoding, glob) -> DataFrame:
    """Per file the first character that is not white space."""
    reader = spark.read.option("pathGlobFilter", glob) if glob else spark.read
    lines = reader.text(path).select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_at"),
        F.monotonically_increasing_id().alias("_line"),
        F.substring(strip("value"), 1, 1).alias("_ch"),
    )
    first = F.min(F.struct("_at", "_line", "_ch"))
    return lines.where(F.col("_ch") != "").groupBy("_file").agg(first["_ch"].alias("first"))


def _read_json(spark, path, text_col, label_col, id_col, encoding, glob):
    wrong = _first_characters(spark, path, encoding, glob).where(F.col("first") != "[").limit(5).collect()
    if wrong:
        raise ValueError(f"a JSON file must hold a list of objects: {[r['_file'] for r in wrong]}")
    names = [text_col] + [c for c in (label_col, id_col) if c]
    schema = ", ".join(f"`{n}` string" for n in dict.fromkeys(names)) + f", `{_CORRUPT}` string"
    reader = spark.read.schema(schema).option("multiLine", True).option("encoding", encoding)
    reader = reader.option("columnNameOfCorruptRecord", _CORRUPT)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    rows = reader.json(path).select(
        "*", F.col("_metadata.file_path").alias("_file"), F.monotonically_increasing_id().alias("_row")
    )
    reason = F.when(F.col(_CORRUPT).isNotNull(), F.lit("not parsable")).when(
        F.col(text_col).isNull(), F.lit("text missing or null")
    )
    label = F.col(label_col) if label_col else F.lit(None).cast("string")
    raw = F.coalesce(F.col(_CORRUPT), F.to_json(F.struct(*[F.col(f"`{n}`") for n in dict.fromkeys(names)])))
    return _split(rows, _needs_id(reason, id_col, _sample_id(id_col)), F.col(text_col), label, raw, _sample_id(id_col))


def parse_json_lines(
    lines: DataFrame, text_col: str, label_col: str | None = None, id_col: str | None = None, value_col: str = "value"
) -> DataFrame:
    """Add ``_reason`` (null for a good line), ``_text``, ``_label`` and ``_id``; also for streams."""
    value = F.col(value_col)
    names = dict.fromkeys([text_col] + [c for c in (label_col, id_col) if c])
    schema = ", ".join(f"`{n}` string" for n in names) + f", `{_CORRUPT}` string"
    parsed = F.from_json(value, schema, {"columnNameOfCorruptRecord": _CORRUPT, "mode": "PERMISSIVE"})
    # generated, so that each line is parsed once however often its fields are used
    out = lines.withColumn("_item", F.explode(F.array(parsed)))
    item = F.col("_item")
    # wrapped in brackets, a line with anything after its value is no longer valid
    single = F.coalesce(F.json_array_length(F.concat(F.lit("["), value, F.lit("]"))), F.lit(0)) == 1
    text = item.getField(text_col)
    has_key = F.array_contains(F.coalesce(F.json_object_keys(value), F.array().cast("array<string>")), text_col)
    reason = (
        F.when(item.getField(_CORRUPT).isNotNull() | ~single, F.lit("not a JSON object"))
        .when(text.isNotNull(), None)
        .when(has_key, F.lit("text is null"))
        .otherwise(F.lit("text key missing"))
    )
    label = item.getField(label_col) if label_col else F.lit(None).cast("string")
    key = item.getField(id_col) if id_col else F.lit(None).cast("string")
    reason = _needs_id(reason, id_col, key)
    columns = {"_reason": reason, "_text": text, "_label": label, "_id": key}
    return out.withColumns(columns).drop("_item")


def _read_jsonl(spark, path, text_col, label_col, id_col, encoding, glob):
    reader = spark.read.option("pathGlobFilter", glob) if glob else spark.read
    value = F.col("value")
    if encoding.lower().replace("_", "-") not in ("utf-8", "utf8"):
        value = F.decode(value.cast("binary"), encoding)
    rows = (
        reader.text(path)
        .select(
            value.alias("value"),
            F.col("_metadata.file_path").alias("_file"),
            F.monotonically_increasing_id().alias("_row"),
        )
        .where(strip("value") != "")
    )
    parsed = parse_json_lines(rows, text_col, label_col, id_col)
    sample_id = F.col("_id" if id_col else "_row")
    return _split(parsed, F.col("_reason"), F.col("_text"), F.col("_label"), F.col("value"), sample_id)


def read_samples(
    spark: SparkSession,
    path: str,
    text_col: str = "text",
    label_col: str | None = None,
    fmt: str | None = None,
    encoding: str = "utf-8",
    id_col: str | None = None,
    multi_line: bool = True,
    by_blocks: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Read a file, or all files of one format in a directory.

    A directory is searched by suffix; with ``fmt`` all its files are read.
    Without ``id_col`` the ids are unique and stay the same while the files and
    the split sizes do; with it, ids are kept as they stand (strings) and a
    record without one goes to quarantine. ``multi_line=False`` lets Spark split large CSV files;
    it is right only where no field holds a line break.
    ``by_blocks=True`` splits UTF-8 CSV files whose fields may hold line breaks
    and JSON arrays (see :mod:`proseframe.sources.records`): for very large
    files, or CSV files whose headers differ in order.
    """
    glob = None
    if fmt is None and _is_directory_scan(path):
        fmt = find_format(spark, path)
        glob = _glob(fmt)
    fmt = fmt or detect_format(path)
    if fmt in ("csv", "tsv"):
        sep = "," if fmt == "csv" else "\t"
        if by_blocks:
            return _read_delimited_blocks(spark, path, text_col, label_col, id_col, sep, glob)
        return _read_delimited(spark, path, text_col, label_col, id_col, sep, encoding, multi_line, glob)
    if fmt == "json" and by_blocks:
        return _read_json_blocks(spark, path, text_col, label_col, id_col, glob)
    if fmt == "json":
        return _read_json(spark, path, text_col, label_col, id_col, encoding, glob)
    if fmt == "jsonl":
        return _read_jsonl(spark, path, text_col, label_col, id_col, encoding, glob)
    raise ValueError(f"unsupported file format: {fmt!r}")
