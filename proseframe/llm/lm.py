"""Language-model scores of whole documents, with the unigram score beside them.

Words are counted over all training documents. The commonest are modelled one
by one, the others through classes of their endings: the recurrent net gives
P(class | what came before), and within a class a word has its smoothed share of
the class's count. All probabilities of a text's words and its end multiply to
the text's.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proseframe.llm.batches import small_batches
from proseframe.llm.gru import HELD, Net, Trainer, new_net, score_texts
from proseframe.session import write_through

#: words modelled one by one; classes of other words; words whose counts go to every task
WORDS, OTHERS, HEAD = 2048, 48, 150_000
ALPHA = 0.1
#: rates of the rounds of training, each on its share of the documents; documents learned from at a time
RATES, LANES = (0.02, 0.008, 0.003), 256
BLOCK = 4_000_000
#: bytes of words that are counted at a time
COUNTED = 1 << 24


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words between ASCII white space, A to Z lower-cased, of all texts in a row, and how many each text has. A null has none."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words, ends = lists.flatten(), lists.offsets.to_numpy()
    real = pc.not_equal(words, "")  # beside leading and trailing white space
    before = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])[ends - ends[0]]
    return words.filter(real), np.diff(before)


#: crc32 of each two bytes (of one: behind those), modulo the classes
_CLASSES = np.array([zlib.crc32(bytes([n >> 8, n & 255])) % OTHERS for n in range(1 << 16)] + [zlib.crc32(bytes([n])) % OTHERS for n in range(256)], dtype=np.int32)


def word_classes(words: pa.Array) -> np.ndarray:
    """The class of words that aren't modelled by themselves: by the last two bytes of each."""
    if not len(words):
        return np.zeros(0, dtype=np.int32)
    ends = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2], np.uint8)
    last = data[ends[1:] - 1].astype(np.int32)
    return _CLASSES[np.where(np.diff(ends) == 1, (1 << 16) + last, data[np.maximum(ends[1:] - 2, 0)].astype(np.int32) << 8 | last)]


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, c) over all rows, the end of each text counted as word "". Added up in each task first."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Array] = []
        texts = size = 0

        def table() -> pa.RecordBatch:
            found = pa.concat_arrays(held).value_counts()
            held.clear()
            return pa.RecordBatch.from_arrays([found.field("values"), found.field("counts")], ["word", "n"])

        for batch in batches:
            texts += len(batch)
            words = words_of(batch["text"])[0]
            held.append(words)
            size += words.nbytes
            if size > COUNTED:
                yield table()
                size = 0
        if held:
            yield table()
        if texts:
            yield pa.RecordBatch.from_pydict({"word": pa.array([""]), "n": pa.array([texts], pa.int64())})

    small_batches(docs.sparkSession)
    parts = docs.select(F.col(text_col).alias("text")).mapInArrow(counted, "word string, n bigint")
    return parts.groupBy("word").agg(F.sum("n").alias("c"))


class Vocabulary(NamedTuple):
    """What every task needs of the counts: bounded by ``HEAD`` words and ``OTHERS`` classes."""

    words: pa.Array  # head words by their numbers, in order of count; 0 is the end
    logs: np.ndarray  # log10(c + ALPHA) of head words
    inputs: np.ndarray  # number of a head word for the net
    class_logs: np.ndarray  # log10 of each class's smoothed total
    total: int
    distinct: int
    net: Net

    def numbers(self, words: pa.Array) -> np.ndarray:
        """Head numbers of words; -1 - class for words that aren't in the head."""
        found = pc.index_in(words, value_set=self.words)
        out = pc.fill_null(found, -1).to_numpy(zero_copy_only=False).copy()
        others = pc.is_null(found)
        out[others.to_numpy(zero_copy_only=False)] = -1 - word_classes(words.filter(others))
        return out

    def read_all(self, words: pa.Array, sizes: np.ndarray) -> np.ndarray:
        """The numbers of the words of texts of these sizes, with the end after each text."""
        out = np.zeros(len(words) + len(sizes), dtype=np.int32)
        inside = np.ones(len(out), dtype=bool)
        inside[np.cumsum(sizes + 1) - 1] = False
        out[inside] = self.numbers(words)
        return out

    def read(self, words: list[bytes]) -> np.ndarray:
        """The numbers of a text's words and its end."""
        return self.read_all(pa.array([w.decode() for w in words], pa.string()), np.array([len(words)]))

    def for_net(self, numbers: np.ndarray) -> np.ndarray:
        return np.where(numbers >= 0, self.inputs[np.maximum(numbers, 0)], self.net.words - 1 - numbers)


def vocabulary(counts: DataFrame) -> Vocabulary:
    """From the written counts: totals, the head and what is left in each class.

    The head are all words from a count on (a step of a logarithmic histogram)
    that leaves at most ``HEAD`` of them.
    """
    whole = counts.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
    step = F.floor(F.log2("c") * 32)
    steps = sorted(((r["step"], r["n"]) for r in counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True)
    least, held = None, 0
    for at, n in steps:
        held += n
        if held > HEAD:
            break
        least = at
    head = counts.where((F.col("word") == "") | (step >= least if least is not None else F.lit(False))).select("word", "c").collect()
    head.sort(key=lambda r: (r["word"] != "", -r["c"], r["word"]))
    data = F.col("word").cast("binary")
    ending = F.crc32(F.substr(data, F.greatest(F.length(data) - 1, F.lit(1)), F.lit(2))) % OTHERS  # as word_classes
    per_class = {r["class"]: (r["n"], r["v"]) for r in counts.where("word <> ''").groupBy(ending.alias("class")).agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).collect()}
    sizes = np.array([per_class.get(k, (0, 0)) for k in range(OTHERS)], dtype=np.float64)
    words = pa.array([r["word"] for r in head] or [""], pa.string())
    c = np.array([r["c"] for r in head] or [0], dtype=np.int64)
    own = min(WORDS, len(words))
    np.subtract.at(sizes, word_classes(words[1:own]), np.stack([c[1:own], np.ones(own - 1)], axis=1))
    inputs = np.concatenate([np.arange(own), own + word_classes(words[own:])])
    class_logs = np.log10(sizes[:, 0] + ALPHA * (sizes[:, 1] + 1))
    net = new_net(c[:own], sizes[:, 0])
    return Vocabulary(words, np.log10(c + ALPHA), inputs, class_logs, int(whole["n"] or 0), int(whole["v"] or 0), net)


def training_texts(docs: DataFrame, vocab, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per document: the round that learns from it, drawn from its id, and all its words and the end as the net's numbers."""

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v: Vocabulary = vocab.value
        for batch in batches:
            rounds = [zlib.crc32(f"round:{name}".encode()) % len(RATES) for name in batch["id"].to_pylist()]
            words, sizes = words_of(batch["text"])
            data = v.for_net(v.read_all(words, sizes)).astype("<u2").tobytes()
            ends = np.concatenate([[0], 2 * np.cumsum(sizes + 1)]).astype(np.int32)
            ids = pa.Array.from_buffers(pa.binary(), len(batch), [None, pa.py_buffer(ends), pa.py_buffer(data)])
            yield pa.RecordBatch.from_arrays([pa.array(rounds, pa.int32()), ids], ["round", "ids"])

    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(texts, "round int, ids binary")


def train(texts: DataFrame, net: Net, words: int, shards: int = 16) -> Net:
    """Rounds of training, together once on every word of all documents, each task from the same net on its own rows.

    A task has up to the ``HELD`` of all ``words`` that a trainer lays side by
    side: with less the longest text leaves it fewer lanes.

    After a round comes the mean of the nets weighted by words. Nets are
    averaged in ``shards`` groups before the driver sees them, so what it
    receives doesn't grow with the number of tasks.
    """
    spark = texts.sparkSession

    def learned(shared, k: int):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            trainer = Trainer(shared.value, RATES[k])
            seen, _ = trainer.learn(([np.frombuffer(bytes(x), "<u2") for x in batch["ids"]] for batch in batches), LANES)
            if seen:
                part = TaskContext.get().partitionId()
                yield pd.DataFrame({"shard": [part % shards], "part": [part], "seen": [seen], "net": [trainer.net.to_bytes()]})

        return run

    def averaged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, seen = None, 0
        for batch in batches:
            for n, data in zip(batch["seen"], batch["net"]):
                more = np.frombuffer(data, "<f4").astype(np.float64) * n
                total = more if total is None else total + more
                seen += int(n)
        if seen:
            yield pd.DataFrame({"seen": [seen], "net": [(total / seen).astype("<f4").tobytes()]})

    cores = spark.sparkContext.defaultParallelism
    tasks = cores * max(1, -(-words // (len(RATES) * HELD * cores)))
    for k in range(len(RATES)):
        shared = spark.sparkContext.broadcast(net)
        nets = texts.where(F.col("round") == k).select("ids").coalesce(tasks).mapInPandas(learned(shared, k), "shard int, part int, seen bigint, net binary")
        means = nets.repartition(shards, "shard").sortWithinPartitions("part").select("seen", "net").mapInPandas(averaged, "seen bigint, net binary")
        found = sorted(means.collect(), key=lambda r: bytes(r["net"]))
        seen = sum(r["seen"] for r in found)
        if not seen:
            continue
        flat = sum(np.frombuffer(bytes(r["net"]), "<f4").astype(np.float64) * (r["seen"] / seen) for r in found)
        net = net.like(flat.astype("<f4").tobytes())
        shared.unpersist()
    return net


SCORED = {
    "row": "bigint", "doc_id": "bigint", "held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint",
    "base": "double", "score": "double", "words": "array<string>", "times": "array<bigint>",
}


def _tails(words: pa.Array, sizes: np.ndarray, read: np.ndarray) -> dict[str, pa.Array]:
    """The words of each text that aren't in the head, once each, and how often it has them. ``read``: numbers of the words and ends."""
    doc = np.repeat(np.arange(len(sizes)), sizes + 1)[read < 0]
    inside = np.ones(len(read), dtype=bool)
    inside[np.cumsum(sizes + 1) - 1] = False
    coded = words.filter(pa.array(read[inside] < 0)).dictionary_encode()
    n = max(1, len(coded.dictionary))
    pairs, times = np.unique(doc * n + coded.indices.to_numpy(), return_counts=True)
    ends = pa.array(np.searchsorted(pairs, np.arange(len(sizes) + 1) * n), pa.int32())
    return {
        "words": pa.ListArray.from_arrays(ends, coded.dictionary.take(pa.array(pairs % n))),
        "times": pa.ListArray.from_arrays(ends, pa.array(times, pa.int64())),
    }


def _scorer(vocab, known_end: bool):
    """Rows of documents with what the head and the net tell; the words that only the counts know go on."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v: Vocabulary = vocab.value
        row = TaskContext.get().partitionId() << 40
        held: list[tuple] = []
        tokens = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal tokens
            texts = [text for *_, texts in held for text in texts]
            nets = score_texts(v.net, texts) / np.log(10)
            at = 0
            for columns, score, own in held:
                columns["score"] = pa.array(score + nets[at : at + len(own)])
                yield pa.RecordBatch.from_arrays([columns[name] for name in SCORED], list(SCORED))
                at += len(own)
            held.clear()
            tokens = 0

        for batch in batches:
            words, sizes = words_of(batch["text"])
            flat = v.read_all(words, sizes)
            columns = {n: batch[n] for n in ("doc_id", "held_out")} | _tails(words, sizes, flat)
            doc, sizes = np.repeat(np.arange(len(sizes)), sizes + 1), sizes + 1
            inputs, head = v.for_net(flat), flat >= 0
            other = inputs >= v.net.words
            logs = np.where(head, v.logs[np.maximum(flat, 0)], 0.0)
            base = np.bincount(doc, weights=logs, minlength=len(sizes))
            score = np.bincount(doc[other], weights=logs[other] - v.class_logs[inputs[other] - v.net.words], minlength=len(sizes))
            known = np.bincount(doc[head], minlength=len(sizes)) - (not known_end)
            numbers = {"row": np.arange(row, row + len(sizes)), "n_tokens": sizes, "n_known": known, "base": base}
            held.append((columns | {n: pa.array(x) for n, x in numbers.items()}, score, np.split(inputs.astype(np.uint16), np.cumsum(sizes)[:-1])))
            row, tokens = row + len(sizes), tokens + len(flat)
            if tokens >= BLOCK:
                yield from flush()
        if held:
            yield from flush()

    return scored


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 10) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) per row, scores as log10 probabilities.

    Learns from rows whose crc32 of the id as text isn't 0 modulo ``folds``
    (without an id: held out). Counts come from every word of every such
    document, and the net learns once from each of them. Each text is read to its end in one go with the net's state
    carried along; texts are never shuffled. Counts of the commonest words
    go to all tasks; the rarer words of each document, once each, are joined
    with the whole table of counts and summed per row, so no count is missed.
    A null or empty text is its end alone; with no training rows all words are
    unknown and scores come from the smoothing; repeated rows are scored as
    they stand; other columns are ignored; no rows give no rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    held = F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == 0, F.lit(True))
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"), held.alias("held_out"))
    learned_from = rows.where("not held_out")
    counts = write_through(word_counts(learned_from), "word-counts")
    vocab = vocabulary(counts)
    shared = spark.sparkContext.broadcast(vocab)
    texts = write_through(training_texts(learned_from, shared), "training-texts")
    net = train(texts, vocab.net, vocab.total)
    shared.unpersist()
    shared = spark.sparkContext.broadcast(vocab._replace(net=net))

    schema = ", ".join(f"{name} {kind}" for name, kind in SCORED.items())
    told = write_through(rows.mapInArrow(_scorer(shared, vocab.total > 0), schema), "document-scores")
    tail = told.where(F.size("words") > 0).select("row", F.explode(F.arrays_zip(F.col("words").alias("word"), F.col("times").alias("m"))).alias("t"))
    tail = tail.select("row", "t.word", "t.m").join(counts.select("word", "c"), "word", "left")
    log = F.col("m") * F.log10(F.coalesce("c", F.lit(0)) + F.lit(ALPHA))
    known = F.when(F.col("c").isNotNull(), F.col("m")).otherwise(0)
    nothing = {"doc_id": "bigint", "held_out": "boolean", "n_tokens": "bigint"}
    tail = tail.select("row", *[F.lit(None).cast(t).alias(n) for n, t in nothing.items()], known.alias("n_known"), log.alias("base"), log.alias("score"))
    summed = told.select(*tail.columns).unionByName(tail).groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"), F.max("n_tokens").alias("n_tokens"),
        F.sum("n_known").alias("n_known"), F.sum("base").alias("base"), F.sum("score").alias("score"),
    )
    smoothed = float(np.log10(vocab.total + ALPHA * (vocab.distinct + 1)))
    return summed.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(vocab.total).cast("bigint").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * smoothed).alias("base_score"), "score",
    )
