"""Files of token ids: documents in id order, ids coded in independent blocks.

A file set is a folder of Parquet files whose rows are segments. A segment holds
whole documents, in order, and can be read by itself:

    "PFS1", uint32 documents, uint32 blocks, uint32 length of the index, the
    index (zlib: int64 ids, uint8 "has an id" flags, uint32 token counts),
    uint32 length of each block, the blocks (see ``coder``)

A long document spans several blocks, each coded from scratch with checksums of
its own. Parquet is only the carrier: Spark commits such files as a whole, can
read them from any store, and a lost executor costs its own segments.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from proseframe.llm.batches import small_batches
from proseframe.llm.coder import BLOCK, CorruptBlock, decode_block, encode_block
from proseframe.llm.tokens import encoder

MAGIC = b"PFS1"


def pack_segment(names: list[int | None], docs: list[bytes]) -> bytes:
    counts = np.array([len(d) // 4 for d in docs], dtype="<u4")
    known = np.array([n is not None for n in names], dtype=np.uint8)
    index = zlib.compress(np.array([n or 0 for n in names], dtype="<i8").tobytes() + known.tobytes() + counts.tobytes(), 1)
    ids = np.frombuffer(b"".join(docs), dtype="<u4").astype(np.int64)
    blocks = [encode_block(ids[at : at + BLOCK]) for at in range(0, len(ids), BLOCK)]
    sizes = np.array([len(b) for b in blocks], dtype="<u4")
    head = np.array([len(docs), len(blocks), len(index)], dtype="<u4")
    return b"".join([MAGIC, head.tobytes(), index, sizes.tobytes(), *blocks])


def unpack_segment(data: bytes) -> tuple[list[int | None], list[bytes]]:
    """Document ids and their tokens (little-endian uint32); :class:`CorruptBlock` if the bytes do not fit together."""
    if data[:4] != MAGIC or len(data) < 16:
        raise CorruptBlock("no segment here")
    n, blocks, size = map(int, np.frombuffer(data, "<u4", 3, 4))
    try:
        index = zlib.decompress(data[16 : 16 + size])
    except zlib.error as e:
        raise CorruptBlock("the index of the segment is damaged") from e
    names, known = np.frombuffer(index, "<i8", n), np.frombuffer(index, np.uint8, n, 8 * n)
    counts = np.frombuffer(index, "<u4", n, 9 * n).astype(np.int64)
    begin = 16 + size + 4 * blocks
    ids = []
    for length in np.frombuffer(data, "<u4", blocks, 16 + size).tolist():
        ids.append(decode_block(data[begin : begin + length]))
        begin += length
    tokens = (np.concatenate(ids) if ids else np.zeros(0, dtype=np.int64)).astype("<u4").tobytes()
    if len(tokens) != 4 * int(counts.sum()) or begin != len(data):
        raise CorruptBlock("the segment does not hold what its index says")
    ends = 4 * np.cumsum(counts)
    docs = [tokens[e - 4 * c : e] for e, c in zip(ends.tolist(), counts.tolist())]
    return [int(v) if k else None for v, k in zip(names, known)], docs


def write_token_files(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1, segment_tokens: int = BLOCK, tokenizer: str | None = None) -> None:
    """Encode each text, append ``end_id`` and write the ids to ``path`` in ascending order of the document ids.

    Texts are dealt out by ranges of the id; a tie-breaker keeps an id that
    many rows repeat from filling one task. Each task streams through its
    range and holds one segment at a time. A null or empty text is the end id
    alone; rows without an id come first; rows that repeat an id stay in the
    order of their texts; other columns are ignored; no rows give no segments.
    """
    small_batches(docs.sparkSession)

    def coded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, end, part = encoder(tokenizer), int(end_id).to_bytes(4, "little"), TaskContext.get().partitionId()
        names: list = []
        held: list[bytes] = []
        tokens = segment = 0

        def flush() -> pd.DataFrame:
            nonlocal tokens, segment
            row = {"part": part, "segment": segment, "documents": len(held), "tokens": tokens, "data": pack_segment(names, held)}
            names.clear()
            held.clear()
            tokens, segment = 0, segment + 1
            return pd.DataFrame([row])

        for batch in batches:
            ids = [None if pd.isna(v) else int(v) for v in batch["id"].astype("Int64")]
            for at in range(0, len(ids), 64):
                for name, tok in zip(ids[at : at + 64], words.encode(batch["text"].iloc[at : at + 64])):
                    names.append(name)
                    held.append(tok + end)
                    tokens += len(tok) // 4 + 1
                    if tokens >= segment_tokens:
                        yield flush()
        if held:
            yield flush()

    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"), F.monotonically_increasing_id().alias("row"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(parts, "id", "row").sortWithinPartitions("id", "row").select("id", "text")
    dealt.mapInPandas(coded, SEGMENTS).write.option("compression", "none").parquet(path)


SEGMENTS = "part int, segment int, documents bigint, tokens bigint, data binary"


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(part, segment, place, inside, doc_id, n_tokens, ids) of each document in a file set.

    ``inside`` counts the ids before it in its segment. A damaged segment
    raises :class:`CorruptBlock`.
    """
    small_batches(spark)

    def decoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part, segment, data in zip(batch["part"], batch["segment"], batch["data"]):
                names, docs = unpack_segment(data)
                counts = np.array([len(d) // 4 for d in docs], dtype=np.int64)
                for at in range(0, len(docs), 1000):
                    yield pd.DataFrame(
                        {
                            "part": part,
                            "segment": segment,
                            "place": np.arange(at, min(at + 1000, len(docs))),
                            "inside": (np.cumsum(counts) - counts)[at : at + 1000],
                            "doc_id": pd.array(names[at : at + 1000], dtype="Int64"),
                            "n_tokens": counts[at : at + 1000],
                            "ids": docs[at : at + 1000],
                        }
                    )

    segments = spark.read.schema(SEGMENTS).parquet(path).select("part", "segment", "data")
    return segments.mapInPandas(decoded, "part int, segment int, place bigint, inside bigint, doc_id bigint, n_tokens bigint, ids binary")


def segment_starts(spark: SparkSession, path: str) -> DataFrame:
    """(part, segment, segment_start): the number of ids before each segment.

    Only counts are read. One number per task that wrote goes through a single
    window, then each task's segments through a window of their own.
    """
    counts = spark.read.schema(SEGMENTS).parquet(path).select("part", "segment", "tokens")
    totals = counts.groupBy("part").agg(F.sum("tokens").alias("n"))
    before = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("part_start"))
    within = F.sum("tokens").over(Window.partitionBy("part").orderBy("segment")) - F.col("tokens")
    return counts.withColumn("within", within).join(before, "part").select("part", "segment", (F.col("part_start") + F.col("within")).alias("segment_start"))


def with_starts(found: DataFrame, starts: DataFrame) -> DataFrame:
    """Documents as read (drop ``ids`` first where they aren't needed) with ``start``, the number of ids before each."""
    return found.join(starts, ["part", "segment"]).withColumn("start", F.col("segment_start") + F.col("inside"))
