"""SimHash near-duplicates by multi-index hashing.

Fingerprints are cut into segments. Two fingerprints that differ in at most
``distance`` bits have a segment in which they differ in at most
``distance // segments`` bits, so probing the small Hamming ball around each
segment in that segment's table finds every pair; the complete distance is
then verified inside the join.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from proseframe.llm.batches import small_batches
from proseframe.llm.components import connected
from proseframe.session import write_through

#: shingles hashed at a time, so that a very long text needs no more memory
PIECE = 1 << 15


def simhash(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """The 64-bit fingerprint as a signed integer; 0 for a text without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, PIECE):
        grams = (b" ".join(words[i : i + shingle]) for i in range(at, min(n, at + PIECE)))
        hashes = np.fromiter(map(xxh64_intdigest, grams, repeat(seed)), dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprint_column(text, shingle: int = 3, seed: int = 42):
    @F.pandas_udf("bigint")
    def fingerprint(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([simhash(t, shingle, seed) for t in batch], dtype="int64")

    return fingerprint(text)


def near_pairs(prints: DataFrame, distance: int = 3, segments: int = 2) -> DataFrame:
    """Pairs (u, v) of the distinct fingerprints in ``prints`` (fp) that differ in 1 to ``distance`` bits.

    Each fingerprint stores its segments once and probes each with itself and
    with every clear bit set: of two segments one bit apart, the one without
    the bit finds the other, so half a ball is enough. Spark sizes what an
    explode returns as if it had not added rows, and would send the probes, 66
    rows a fingerprint, through the driver: a merge join at every size.
    """
    if 64 % segments or distance // segments > 1:
        raise ValueError("segments must divide 64 and exceed half the distance")
    width, radius = 64 // segments, distance // segments
    mask = (1 << width) - 1
    bits = F.array(*[F.lit(1 << b) for b in range(width)])

    def part(i):
        return F.shiftrightunsigned("fp", i * width).bitwiseAND(F.lit(mask))

    def ball(i):
        own = part(i)
        return F.array_distinct(F.concat(F.array(own), F.transform(bits, lambda b: own.bitwiseOR(b)))) if radius else F.array(own)

    def rows(keys, name):
        entries = F.array(*[F.struct(F.lit(i).alias("seg"), keys(i).alias("keys")) for i in range(segments)])
        return prints.select(F.col("fp").alias(name), F.explode(entries).alias("e"))

    probes = rows(ball, "u").select("u", F.col("e.seg").alias("seg"), F.explode("e.keys").alias("key"))
    table = rows(lambda i: F.array(part(i)), "v").select("v", F.col("e.seg").alias("seg"), F.col("e.keys")[0].alias("key"))
    differ = F.bit_count(F.col("u").bitwiseXOR(F.col("v")))
    return probes.join(table.hint("merge"), (probes.seg == table.seg) & (probes.key == table.key) & differ.between(1, distance)).select("u", "v")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = 3, shingle: int = 3, seed: int = 42) -> DataFrame:
    """(id, key, fp, component_id, group) per row: component_id is the smallest id reachable over links.

    ``group`` is a fingerprint that names the component, ``key`` a hash of id and text.

    Texts are read once and never shuffled: rows shrink to (id, fp), equal
    fingerprints to one row, and only those are indexed. Rows get their group
    in a merge join, so that neither side, which both grow with the corpus, is
    broadcast. A null or empty text, or one without words, has fingerprint 0; a
    repeated row appears as often as in the input; a row without an id gets its
    group's smallest id, or null if none of the group has one. Other columns
    are ignored. No rows give no rows.
    """
    small_batches(docs.sparkSession)
    rows = write_through(docs.select(F.col(id_col).alias("id"), row_key(id_col, text_col).alias("key"), fingerprint_column(F.col(text_col), shingle, seed).alias("fp")), "fingerprints")
    prints = write_through(rows.groupBy("fp").agg(F.min("id").alias("first_id")), "prints")
    roots = connected(near_pairs(prints.select("fp"), distance)).select(F.col("node").alias("fp"), "root")
    grouped = prints.join(roots, "fp", "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    lowest = grouped.groupBy("root").agg(F.min("first_id").alias("component_id"))
    told = grouped.join(lowest, "root").select("fp", "component_id", F.col("root").alias("group"))
    return rows.join(told.hint("merge"), "fp").select("id", "key", "fp", "component_id", "group")


def row_key(id_col: str, text_col: str):
    return F.xxhash64(id_col, text_col)


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = 3) -> DataFrame:
    """``docs`` without near-duplicates: one row of each group stays, one with the smallest id.

    Of rows that repeat an id, the one that lies in the group is found by a
    hash of id and text; rows that repeat both are one. Where no row of a group
    has an id, one of them stays. The row chosen for each group and what goes
    are narrow tables that grow with the corpus, so they are never broadcast:
    texts are shuffled once to meet the latter, in a merge join that may split
    hot keys. Rows that repeat id and text and stay are shuffled once more, to
    become one.
    """
    groups = simhash_groups(docs, id_col, text_col, distance)
    first = F.col("id").eqNullSafe(F.col("component_id"))
    rows = write_through(groups.select("group", "key", "id", first.alias("first")), "simhash-rows")
    firsts = rows.where("first")
    chosen = firsts.groupBy("group").agg(F.min(F.struct("key", "id")).alias("row")).select("group", F.col("row.key").alias("__key"), F.col("row.id").alias("__id"))
    others = firsts.join(chosen.hint("merge"), "group").where((F.col("key") != F.col("__key")) | ~F.col("id").eqNullSafe(F.col("__id")))
    gone = rows.where("not first").select("key", "id").unionByName(others.select("key", "id")).distinct()
    gone = write_through(gone.select(F.col("key").alias("__key"), F.col("id").alias("__id")), "simhash-gone")
    repeated = firsts.groupBy(F.col("key").alias("__key"), F.col("id").alias("__id")).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1")
    repeated = write_through(repeated.select("__key", "__id"), "simhash-repeated")

    def met(rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
        own = row_key(id_col, text_col)
        return rows.join(keys, (own == keys["__key"]) & rows[id_col].eqNullSafe(keys["__id"]), how)

    kept = met(docs, gone.hint("merge"), "left_anti")
    if repeated.isEmpty():
        return kept
    once = met(kept, repeated, "left_semi").withColumn("__own", row_key(id_col, text_col)).dropDuplicates(["__own", id_col]).drop("__own")
    return met(kept, repeated, "left_anti").unionByName(once)
