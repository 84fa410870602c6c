"""Writers. They write one file per task, or one per row where asked to; none gathers rows."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from proseframe.functions.text import word_count


def write_splits(df: DataFrame, path: str, mode: str = "error") -> None:
    df.write.mode(mode).partitionBy("split").parquet(path)


def _json_arrays(df: DataFrame) -> DataFrame:
    """Lines that make every partition's file a JSON array of its own."""
    def bracket(batches: Iterator) -> Iterator:
        import pandas as pd

        held = None  # the last line is held back: only the end tells whether a comma follows
        for pdf in batches:
            lines = pdf["value"].tolist()
            if not lines:
                continue
            if held is not None:
                lines.insert(0, held)
            else:
                lines[0] = "[" + lines[0]
            held = lines.pop()
            if lines:
                yield pd.DataFrame({"value": [line + "," for line in lines]})
        if held is not None:
            yield pd.DataFrame({"value": [held + "]"]})

    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value")).mapInPandas(
        bracket, "value string"
    )


def write_samples(df: DataFrame, path: str, fmt: str = "csv", mode: str = "error") -> None:
    """Write as a directory of CSV, TSV, JSON-array or JSON Lines files; non-ASCII text is kept."""
    columns = [c for c in ("sample_id", "text", "label") if c in df.columns]
    out = df.select(*columns)
    writer = out.write.mode(mode)
    if fmt in ("csv", "tsv"):
        sep = "," if fmt == "csv" else "\t"
        writer.options(header=True, sep=sep, quote='"', escape='"', emptyValue="").option(
            "ignoreLeadingWhiteSpace", False
        ).option("ignoreTrailingWhiteSpace", False).csv(path)
    elif fmt == "jsonl":
        writer.json(path)
    elif fmt == "json":
        _json_arrays(out).write.mode(mode).text(path)
    else:
        raise ValueError(f"unsupported format: {fmt!r}")


def write_samples_by_split(samples: DataFrame, path: str, mode: str = "error") -> None:
    """Inspection samples, one JSON folder per split."""
    samples.write.mode(mode).partitionBy("split").json(path)


def write_report(df: DataFrame, path: str, fmt: str = "json", mode: str = "error") -> None:
    """A small report table: JSON documents, or text lines in ``line_no`` order."""
    if fmt == "json":
        df.coalesce(1).write.mode(mode).json(path)
    elif fmt == "text":
        # reports have a fixed number of lines, so one task may order them
        df.coalesce(1).sortWithinPartitions("line_no").select("line").write.mode(mode).text(path)
    else:
        raise ValueError(f"unsupported report format: {fmt!r}")


def write_listing(blocks: DataFrame, path: str, mode: str = "error") -> None:
    """The blocks of ``listing_lines`` as text files in the order of their numbers, any number of them."""
    blocks.repartitionByRange("number").sortWithinPartitions("number").select("line").write.mode(mode).text(path)


def inference_rows(outputs: DataFrame) -> DataFrame:
    """Input, output and word counts; the remote fields only where there is remote output."""
    remote = F.nullif(F.col("remote_output"), F.lit("")) if "remote_output" in outputs.columns else F.lit(None).cast("string")
    return outputs.select(
        "prompt_id",
        F.col("prompt").alias("input"),
        F.col("output").alias("local_output"),
        word_count("output").alias("local_output_length"),
        remote.alias("remote_output"),
        word_count(remote).alias("remote_output_length"),
    )


def write_inference(outputs: DataFrame, path: str, mode: str = "error") -> None:
    """JSON Lines; Spark leaves null fields out, so remote keys appear only when set."""
    inference_rows(outputs).write.mode(mode).json(path)


def write_files(files: DataFrame, root: str) -> None:
    """One small file per row (path below ``root``, text), written by the tasks; a repeated task writes the same again.

    ``root`` is a path or a URI that ``pyarrow.fs`` knows. Files are small and their making is what
    takes the time, so they are dealt out over all cores however few partitions the rows come in.
    """
    uri = root.replace("s3a://", "s3://", 1)
    uri = "file://" + uri.removeprefix("file:") if uri.startswith("file:/") and not uri.startswith("file://") else uri

    def written(rows: Iterator[Row]) -> None:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(uri)
        for row in rows:
            path = f"{base}/{row['path']}"
            store.create_dir(path.rsplit("/", 1)[0], recursive=True)
            with store.open_output_stream(path, compression=None) as out:
                out.write(row["text"].encode())

    files.select("path", "text").repartition(files.sparkSession.sparkContext.defaultParallelism).foreachPartition(written)
