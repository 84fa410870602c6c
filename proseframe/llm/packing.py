"""Cost-balanced packing of documents into training sequences."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proseframe.llm.batches import small_batches
from proseframe.llm.tokens import encoder

LINEAR, QUADRATIC = 1.0, 1.0 / 1024


def attention_cost(n, linear: float = LINEAR, quadratic: float = QUADRATIC):
    """Estimated cost of ``n`` tokens that attend to each other: projections are linear, scores quadratic."""
    return linear * n + quadratic * n * n


def room_for(total: int, capacity: int) -> np.ndarray:
    """Sequence lengths that hold ``total`` tokens without padding: full ones, then powers of two."""
    rest = total % capacity
    tail = [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
    return np.array([capacity] * (total // capacity) + tail, dtype=np.int64)


def pack_block(lengths: np.ndarray, capacity: int = 4096, linear: float = LINEAR, quadratic: float = QUADRATIC) -> np.ndarray:
    """Pieces (document, start, length, sequence, offset) that put each token in one place.

    Whole capacities are cut off long documents first, each a sequence of its
    own. The rest goes in descending length to the sequence of lowest cost so
    far that still has room. What fits nowhere whole is cut over the remaining
    room, lowest cost first; as room and tokens are equal, all sequences fill.
    """
    lengths = np.asarray(lengths, dtype=np.int64)
    room = room_for(int(lengths.sum()), capacity)
    used = np.zeros(len(room), dtype=np.int64)
    cost = np.zeros(len(room))
    pieces: list[tuple[int, int, int, int, int]] = []
    taken = np.zeros(len(lengths), dtype=np.int64)
    full = 0
    for doc in np.flatnonzero(lengths >= capacity):
        for _ in range(int(lengths[doc] // capacity)):
            pieces.append((int(doc), int(taken[doc]), capacity, full, 0))
            taken[doc] += capacity
            room[full], used[full] = 0, capacity
            full += 1
    left = lengths - taken
    order = np.argsort(-left, kind="stable")
    over = []

    def put(doc: int, n: int, to: int) -> None:
        pieces.append((doc, int(taken[doc]), n, to, int(used[to])))
        taken[doc] += n
        used[to] += n
        room[to] -= n
        cost[to] += attention_cost(n, linear, quadratic)

    for doc in order[left[order] > 0]:
        n = int(left[doc])
        open_cost = np.where(room >= n, cost, np.inf)
        to = int(np.argmin(open_cost)) if len(open_cost) else 0
        if np.isinf(open_cost[to]):
            over.append(int(doc))
        else:
            put(int(doc), n, to)
    for doc in over:
        n = int(left[doc])
        while n:
            to = int(np.argmin(np.where(room > 0, cost, np.inf)))
            part = min(n, int(room[to]))
            put(doc, part, to)
            n -= part
    return np.array(pieces, dtype=np.int64).reshape(-1, 5)


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2, capacity: int = 4096, block_tokens: int = 1_000_000, tokenizer: str | None = None) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids (little-endian uint32), doc_tokens, sequence_id, offset, sequence_tokens.

    A map over the table as it is dealt: each task tokenises its rows and packs
    them in blocks of about ``block_tokens`` ids (a longer document is a block
    of its own), so no text is shuffled and memory does not grow with the
    table. Each block is filled without padding: its last ``tokens % capacity``
    ids make sequences whose lengths are powers of two. A null or empty text is
    the end id alone; rows that repeat an id are separate documents; other
    columns are ignored; no rows give no pieces.
    """
    small_batches(docs.sparkSession)

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, end = encoder(tokenizer), int(end_id).to_bytes(4, "little")
        next_id = TaskContext.get().partitionId() << 40
        held_ids: list = []
        held: list[bytes] = []
        tokens = 0

        def flush() -> Iterator[pd.DataFrame]:
            nonlocal next_id, tokens
            lengths = np.array([len(x) // 4 for x in held], dtype=np.int64)
            pieces = pack_block(lengths, capacity)
            sizes = room_for(int(lengths.sum()), capacity)
            for at in range(0, len(pieces), 2000):
                doc, start, n, seq, offset = pieces[at : at + 2000].T
                yield pd.DataFrame(
                    {
                        "doc_id": pd.array([held_ids[d] for d in doc], dtype="Int64"),
                        "start": start,
                        "length": n,
                        "ids": [held[d][4 * s : 4 * (s + k)] for d, s, k in zip(doc, start, n)],
                        "doc_tokens": lengths[doc],
                        "sequence_id": seq + next_id,
                        "offset": offset,
                        "sequence_tokens": sizes[seq],
                    }
                )
            next_id += len(sizes)
            held_ids.clear()
            held.clear()
            tokens = 0

        for batch in batches:
            names = batch["id"].astype("Int64").tolist()
            for at in range(0, len(batch), 64):
                for name, ids in zip(names[at : at + 64], words.encode(batch["text"].iloc[at : at + 64])):
                    held_ids.append(name)
                    held.append(ids + end)
                    tokens += len(held[-1]) // 4
                    if tokens >= block_tokens:
                        yield from flush()
        if held:
            yield from flush()

    schema = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint, sequence_tokens bigint"
    return docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")).mapInPandas(packed, schema)


def sequences(pieces: DataFrame) -> DataFrame:
    """One row per sequence: its ids and the offsets at which pieces begin (for the attention mask)."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    grouped = pieces.groupBy("sequence_id").agg(F.first("sequence_tokens").alias("tokens"), parts.alias("parts"))
    joined = F.aggregate("parts", F.lit(b"").cast("binary"), lambda a, p: F.concat(a, p["ids"]))
    return grouped.select("sequence_id", "tokens", joined.alias("ids"), F.transform("parts", lambda p: p["offset"]).alias("piece_offsets"))
