"""Records of quoted delimited text and objects of JSON arrays, read by many tasks although any character may stand in a field.

Spark cuts a file into blocks of lines at any place. Whether a block begins
inside a quoted field depends on all blocks before it, so each block first tells
how it maps either state at its start to the state at its end; these maps are
composed along each file, and then every block knows where its records begin.
A record that crosses blocks is put together from its pieces, one or two a block.
"""

from __future__ import annotations

import csv
import re
from bisect import bisect_left
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from proseframe.session import write_through

#: distinct header lines of the files read together
MOST_HEADERS = 200


def ends_inside(line: str, inside: bool, sep: str) -> bool:
    """Whether a line that begins inside a quoted field (or at a record's start) ends inside one.

    A quote opens a field only as its first character; inside a field two
    quotes are one, and a single one closes it.
    """
    at = 0
    while True:
        if inside:
            at = line.find('"', at)
            while at >= 0 and line[at + 1 : at + 2] == '"':
                at = line.find('"', at + 2)
            if at < 0:
                return True
            at, inside = at + 1, False
        if not line.startswith('"', at) or at and line[at - 1] != sep:
            at = line.find(sep + '"', at)
            if at < 0:
                return False
            at += len(sep)
        at, inside = at + 1, True


class Block(NamedTuple):
    """How a block of lines maps the states outside (0) and inside (1), and whether a record ends in it if it begins inside."""

    to: tuple[bool, bool]
    ends: bool


def _lines(spark: SparkSession, path: str, glob: str | None, end: str = "\n") -> DataFrame:
    reader = spark.read.option("lineSep", end)
    reader = reader.option("pathGlobFilter", glob) if glob else reader
    return reader.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def _by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, Iterator[str]]]:
    """(file, block, its lines): rows of a block follow each other."""
    rows = ((f, b, v) for batch in batches for f, b, v in zip(*[c.to_pylist() for c in batch.columns]))
    row = next(rows, None)
    while row is not None:
        key = row[:2]

        def own() -> Iterator[str]:
            nonlocal row
            while row is not None and row[:2] == key:
                yield row[2]
                row = next(rows, None)

        lines = own()
        yield *key, lines
        for _ in lines:
            pass


def _file_numbers(spark: SparkSession, path: str, glob: str | None) -> dict[int, str]:
    """The files by a hash of their path, which stands for it beside each line."""
    reader = spark.read.format("binaryFile")
    reader = reader.option("pathGlobFilter", glob) if glob else reader
    name = F.col("_metadata.file_path")
    found = [(r["number"], r["file"]) for r in reader.load(path).select(F.xxhash64(name).alias("number"), name.alias("file")).distinct().collect()]
    if len(dict(found)) < len(found):
        raise ValueError(f"two files under {path!r} whose paths hash alike")
    return dict(found)


def _numbered_lines(lines: DataFrame) -> DataFrame:
    """Lines with their line break, so that those of an Arrow batch lie side by side as in the file."""
    return lines.select(F.xxhash64("file").alias("number"), "block", F.concat("value", F.lit("\n")).alias("value"))


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], pa.Array, np.ndarray]]:
    """((file's number, block), lines that follow each other, which of them hold a quote); a block's lines come in several."""
    for batch in batches:
        number, block = (batch.column(i).to_numpy() for i in (0, 1))
        lines = batch.column(2).cast(pa.string())
        cuts = np.flatnonzero((number[1:] != number[:-1]) | (block[1:] != block[:-1])) + 1
        for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            if end > start:
                own = lines.slice(start, end - start)
                quoted = pc.match_substring(own, '"').to_numpy(zero_copy_only=False)
                yield (int(number[start]), int(block[start])), own, np.flatnonzero(quoted)


def _block_maps(lines: DataFrame, sep: str) -> dict[tuple[int, int], Block]:
    """The map of each block that holds a quote, a few bits for each on the driver; others change no state."""

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told() -> pa.RecordBatch:
            columns = [[key[0]], [key[1]], [to[0]], [to[1]], [ends]]
            return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, [pa.int64(), pa.int64(), *[pa.bool_()] * 3])], names=["number", "block", "a", "b", "c"])

        key, to, ends = None, [False, True], False
        for now, own, _ in _stretches(batches):
            if now != key:
                if key is not None:
                    yield told()
                key, to, ends = now, [False, True], False
            for line in own.to_pylist():
                to = [ends_inside(line, to[0], sep)] * 2 if to[0] == to[1] else [ends_inside(line, s, sep) for s in to]
                ends |= not to[1]
        if key is not None:
            yield told()

    # lines without a quote stay in the JVM: handing a line over costs several times its reading
    quoted = lines.where(F.contains("value", F.lit('"')))
    found = quoted.mapInArrow(mapped, "number bigint, block bigint, a boolean, b boolean, c boolean").collect()
    return {(r["number"], r["block"]): Block((r["a"], r["b"]), r["c"]) for r in found}


#: by file: blocks in order, and what holds behind each: (inside, the block where the open record began)
Behind = dict[int, tuple[list[int], list[tuple[bool, int]]]]


def _entry(behind: Behind, file: int, block: int) -> tuple[bool, int]:
    """Whether a block begins inside a field, and the block where its first record begins; it need not be listed."""
    blocks, states = behind.get(file, ([], []))
    at = bisect_left(blocks, block)
    inside, begun = states[at - 1] if at else (False, block)
    return inside, begun if inside else block


def _composed(maps: dict[tuple[int, int], Block]) -> Behind:
    """The maps composed along each file."""
    out: Behind = {}
    for file, block in sorted(maps):
        inside, begun = _entry(out, file, block)
        m = maps[file, block]
        if m.to[inside]:
            # a record is open at the end: one that began here, unless none ended here and it began before
            begun = block if m.ends or not inside else begun
        blocks, states = out.setdefault(file, ([], []))
        blocks.append(block)
        states.append((m.to[inside], begun))
    return out


def read_records(spark: SparkSession, path: str, sep: str = ",", glob: str | None = None) -> DataFrame:
    """(file, block, nth, record, closed): the records of delimited UTF-8 files under ``path``, their line breaks kept.

    ``block`` and ``nth`` order a file's records. ``closed`` is false for one
    whose quoted field never ends: the rest of its file. Empty lines outside
    quotes are no records; a line break is LF or CR LF. Files are read twice,
    by as many tasks as Spark has blocks, and the records written once to the
    shared folder; the driver holds a few bits for each block.
    """
    lines = _numbered_lines(_lines(spark, path, glob))
    files = spark.sparkContext.broadcast(_file_numbers(spark, path, glob))
    behind = spark.sparkContext.broadcast(_composed(_block_maps(lines, sep)))

    def assembled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_()]

        def frame(columns: list) -> pa.RecordBatch:
            arrays = [c if isinstance(c, pa.Array) else pa.array(c, type=t) for c, t in zip(columns, kinds)]
            return pa.RecordBatch.from_arrays(arrays, names=["file", "block", "nth", "piece", "record", "closed"])

        def piece(closed: bool) -> pa.RecordBatch:
            """What is held: a record of this block, or a part of one that begins or ends in another."""
            crossing = nth < 0 or not closed
            return frame([[files.value[key[0]]], [start if nth < 0 else key[1]], [1 << 62 if crossing else nth], [key[1]], ["".join(held)], [closed]])

        key, inside, start, nth, held = None, False, 0, 0, []
        for now, own, quoted in _stretches(batches):
            if now != key:
                if held:
                    yield piece(False)
                key, held = now, []
                inside, start = _entry(behind.value, *key)
                nth = -1 if inside else 0
            then = [inside]
            for line in own.take(pa.array(quoted)).to_pylist():
                then.append(ends_inside(line, then[-1], sep))
            after = np.repeat(then, np.diff([0, *quoted.tolist(), len(own)]))
            inside = then[-1]
            # line after line the text is one stretch of bytes: records are cut out by new offsets
            ends = np.flatnonzero(~after) + 1
            begun = 0
            if len(ends) and (held or nth < 0):
                begun, ends = int(ends[0]), ends[1:]
                held.extend(own.slice(0, begun).to_pylist())
                yield piece(True)
                nth, held = max(nth, 0) + 1, []
            if len(ends):
                at = np.frombuffer(own.buffers()[1], dtype=np.int32)[own.offset : own.offset + len(own) + 1]
                n = len(ends)
                cut = np.concatenate([at[begun : begun + 1], at[ends]])
                text = pa.StringArray.from_buffers(n, pa.py_buffer(cut), own.buffers()[2])
                yield frame([pa.repeat(files.value[key[0]], n), pa.repeat(key[1], n), pa.array(np.arange(nth, nth + n)), pa.repeat(key[1], n), text, pa.repeat(True, n)])
                begun, nth = int(ends[-1]), nth + n
            held.extend(own.slice(begun).to_pylist())
        if held:
            yield piece(False)

    def ended(record: Column) -> Column:
        return F.regexp_replace(record, r"\r?\n\z", "")

    pieces = lines.mapInArrow(assembled, "file string, block bigint, nth bigint, piece bigint, record string, closed boolean")
    crosses = F.col("nth") == 1 << 62
    pieces = pieces.withColumn("record", F.when(crosses, F.col("record")).otherwise(ended(F.col("record"))))
    pieces = write_through(pieces.where("record <> ''"), "csv-records")
    whole = pieces.where(~crosses).select("file", "block", "nth", "record", "closed")
    parts = F.array_sort(F.collect_list(F.struct("piece", "record")))
    crossing = pieces.where(crosses).groupBy("file", "block", "nth")
    crossing = crossing.agg(F.array_join(F.transform(parts, lambda p: p["record"]), "").alias("record"), F.max("closed").alias("closed"))
    return whole.unionByName(crossing.withColumn("record", ended(F.col("record"))).where("record <> ''"))


def first_records(records: DataFrame) -> DataFrame:
    """(file, first, header): the place and the text of each file's first record."""
    first = records.groupBy("file").agg(F.min(F.struct("block", "nth")).alias("first"))
    here = first.select("file", "first", F.col("first.block").alias("block"), F.col("first.nth").alias("nth"))
    return records.join(here, ["file", "block", "nth"]).select("file", "first", F.col("record").alias("header"))


def headers(first: DataFrame, sep: str) -> dict[str, list[str]]:
    """The column names of each file's header record, which is its first; by the record's text."""
    found = [r["header"] for r in first.select("header").distinct().limit(MOST_HEADERS + 1).collect()]
    if len(found) > MOST_HEADERS:
        raise ValueError(f"files with more than {MOST_HEADERS} different headers")
    return {h: next(csv.reader([h.removeprefix("\ufeff")], delimiter=sep)) for h in found}


def parsed_records(records: DataFrame, wanted: list[str], sep: str, corrupt: str) -> DataFrame:
    """``records`` without the headers, the ``wanted`` columns found by each file's own header, and ``corrupt``.

    ``corrupt`` holds a record with too few or too many fields, as Spark's own reader marks them.
    """
    first = write_through(first_records(records), "csv-headers")
    names = headers(first, sep)
    for header, own in names.items():
        for name in wanted:
            if name not in own:
                raise ValueError(f"column {name!r} not found in header {header!r}")
    first = first.select("file", F.col("first").alias("__first"), F.col("header").alias("__header"))
    rows = records.join(first, "file").where(F.struct("block", "nth") > F.col("__first"))
    options = {"sep": sep, "quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt, "multiLine": "true"}

    def values(own: list[str]) -> Column:
        schema = ", ".join(f"`_{i}` string" for i in range(len(own))) + f", `{corrupt}` string"
        row = F.from_csv("record", schema, options)
        return F.transform(F.array(row), lambda r: F.struct(*[r[f"_{own.index(n)}"].alias(n) for n in wanted], r[corrupt].alias(corrupt)))[0]

    cases = [F.when(F.col("__header") == h, values(own)) for h, own in names.items()]
    return rows.withColumn("__row", F.coalesce(*cases)).select("file", "block", "nth", "record", "closed", "__row.*") if cases else rows.limit(0)


# --- objects of JSON arrays --------------------------------------------------------

_STRING = re.compile(r'"(?:[^"\\]|\\.)*"', re.S)
_REST = re.compile(r'(?:[^"\\]|\\.)*"', re.S)


def scan_json(piece: str, inside: bool) -> tuple[bool, int]:
    """(ends inside a string, change of depth) of what stands before a "}" and that "}", begun inside a string or not."""
    if inside:
        m = _REST.match(piece)
        if m is None:
            return True, 0
        piece = piece[m.end() :]
    if '"' in piece:
        piece = _STRING.sub("", piece)
        at = piece.find('"')
        if at >= 0:  # a string that goes on beyond the "}"
            piece, inside = piece[:at], True
        else:
            inside = False
    else:
        inside = False
    return inside, piece.count("{") + piece.count("[") - piece.count("]") - (not inside)


def _json_maps(pieces: DataFrame) -> dict[tuple[str, int], list[tuple[bool, int, int]]]:
    """Of each block, from outside and from inside a string: its end state, its change of depth, the least depth at a "}" on the way."""

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file, block, own in _by_block(batches):
            state, depth, low, first = [False, True], [0, 0], [1 << 40, 1 << 40], None
            for piece in own:
                first = piece.lstrip(" \t\r\n\ufeff")[:1] if first is None else first
                for s in (0, 1):
                    state[s], change = scan_json(piece, state[s])
                    depth[s] += change
                    if not state[s]:
                        low[s] = min(low[s], depth[s])
            row = [file, block, first, *state, *depth, *low]
            yield pa.RecordBatch.from_arrays([pa.array([x]) if x is not None else pa.array([""]) for x in row], names=["file", "block", "first", "a", "b", "c", "d", "e", "f"])

    found = pieces.mapInArrow(mapped, "file string, block bigint, first string, a boolean, b boolean, c bigint, d bigint, e bigint, f bigint").collect()
    wrong = sorted(r["file"] for r in found if r["block"] == 0 and r["first"] not in ("[", ""))
    if wrong:
        raise ValueError(f"a JSON file must hold a list of objects: {wrong[:5]}")
    return {(r["file"], r["block"]): [(r["a"], r["c"], r["e"]), (r["b"], r["d"], r["f"])] for r in found}


def _json_entries(maps) -> dict[tuple[str, int], tuple[bool, int, int]]:
    """Of each block: whether it begins inside a string, the depth there, and the block where its first object began."""
    out: dict[tuple[str, int], tuple[bool, int, int]] = {}
    last, inside, depth, begun = None, False, 0, 0
    for file, block in sorted(maps):
        if file != last:
            last, inside, depth, begun = file, False, 0, block
        out[file, block] = (inside, depth, begun if inside or depth > 1 else block)
        to, change, low = maps[file, block][inside]
        if depth + low <= 1 or not inside and depth <= 1:  # an object ends or begins here: what is open at the end began here
            begun = block
        inside, depth = to, depth + change
    return out


def read_json_objects(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """(file, block, nth, record): the text of each object of the JSON arrays in UTF-8 files under ``path``.

    A file is cut after any "}"; whether a block begins inside a string, and how
    deep, depends on all before it, so blocks first tell how they change either
    state. What stands between two objects and is no comma goes with the later
    one, what stands after the last one is a record of its own: neither is an
    object, which the caller finds. A file that is no list is an error.
    """
    pieces = _lines(spark, path, glob, "}")
    entries = spark.sparkContext.broadcast(_json_entries(_json_maps(pieces)))

    def assembled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def frame(rows) -> pa.RecordBatch:
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows), kinds)], names=["file", "block", "nth", "piece", "record"])

        for file, block, own in _by_block(batches):
            inside, depth, start = entries.value[file, block]
            nth, held, rows = (-1 if inside or depth > 1 else 0), [], []
            for piece in own:
                held.append(piece)
                inside, change = scan_json(piece, inside)
                depth += change
                if not inside and depth == 1:
                    # an object that began in an earlier block is that block's last
                    rows.append((file, start if nth < 0 else block, 1 << 62 if nth < 0 else nth, block, "}".join(held) + "}"))
                    nth, held = nth + 1, []
                    if len(rows) >= 2000:
                        yield frame(rows)
                        rows = []
            if held:
                rows.append((file, start if nth < 0 else block, 1 << 62, block, "}".join(held) + "}"))
            if rows:
                yield frame(rows)

    parts = write_through(pieces.mapInArrow(assembled, "file string, block bigint, nth bigint, piece bigint, record string"), "json-objects")
    whole = parts.where(f"nth < {1 << 62}").select("file", "block", "nth", "record")
    listed = F.array_sort(F.collect_list(F.struct("piece", "record")))
    crossing = parts.where(f"nth = {1 << 62}").groupBy("file", "block", "nth").agg(F.array_join(F.transform(listed, lambda p: p["record"]), "").alias("record"))
    records = whole.unionByName(crossing)
    # the reader adds a "}" at the end of a file, after the list's own end
    text = F.regexp_replace(F.regexp_replace("record", r"\A[\s\x{feff}]*\[?[\s,]*", ""), r"\A\s*\]\s*\}?\z|\A\}\z", "")
    return records.withColumn("record", text).where("record <> ''")
