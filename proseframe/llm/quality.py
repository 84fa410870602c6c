"""Quality classifier: naive Bayes support vectors.

A text is a set of n-gram indicators. Each indicator is scaled by its
class log-count ratio; a linear hinge-loss model on the scaled, length-normalised
vectors is fitted by dual coordinate descent, and its margin is calibrated to a
probability on labelled rows kept out of the fit.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proseframe.llm.batches import small_batches

#: buckets of byte trigrams, of shape trigrams, of repetition levels
GRAMS, SHAPES, LEVELS = 1 << 16, 1 << 14, 64
SIZE = GRAMS + SHAPES + LEVELS
PIECE = 1 << 20
#: shape of a byte: upper case, lower case or beyond ASCII, digit, space; each other ASCII byte is its own shape
_SHAPE = np.array([1 if 65 <= b <= 90 else 2 if 97 <= b <= 122 or b >= 128 else 3 if 48 <= b <= 57 else 4 if b == 32 else b + 5 for b in range(256)], dtype=np.uint32)


def _mark(seen: np.ndarray, values: np.ndarray, offset: int, bits: int) -> None:
    """Set the buckets of all runs of three values."""
    if len(values) >= 3:
        mixed = (values[:-2] * np.uint32(0x9E3779B1)) ^ (values[1:-1] * np.uint32(0x85EBCA6B)) ^ (values[2:] * np.uint32(0xC2B2AE35))
        mixed ^= mixed >> np.uint32(15)
        mixed *= np.uint32(0x27D4EB2F)
        seen[offset + (mixed >> np.uint32(32 - bits)).astype(np.int64)] = True


def _level(part: int, whole: int) -> int:
    """0 for nothing, else 1 to 15: the share of ``whole`` in halvings, 15 for all."""
    return max(1, 15 - int(np.log2(whole / part))) if part else 0


def indicators(text: str | None, seen: np.ndarray) -> np.ndarray:
    """The features of a whole text, ascending. ``seen`` is a cleared boolean scratch of ``SIZE``, cleared again on return.

    Byte trigrams; trigrams of shapes, in which runs of one shape are one
    symbol that tells single bytes from longer runs; and how much of the text
    repeats the word or a line just before.
    """
    data = (text or "").encode()
    if not data:
        return np.zeros(0, dtype=np.int64)
    for at in range(0, len(data), PIECE):
        values = np.frombuffer(data[max(0, at - 2) : at + PIECE], dtype=np.uint8).astype(np.uint32)
        _mark(seen, values, 0, 16)
        shape = _SHAPE[values]
        edges = np.flatnonzero(np.concatenate([[True], shape[1:] != shape[:-1], [True]]))
        symbols = shape[edges[:-1]] * np.uint32(2) + (np.diff(edges) > 1)
        _mark(seen, symbols.astype(np.uint32), GRAMS, 14)
    words = data.split()
    seen[GRAMS + SHAPES + _level(sum(map(eq, words, words[1:])), len(words))] = True
    lines = [line for line in data.split(b"\n") if line.strip()]
    seen[GRAMS + SHAPES + 16 + _level(len(lines) - len(set(lines)), len(lines))] = True
    if words:
        seen[GRAMS + SHAPES + 32 + _level(len(set(words)), len(words))] = True
    found = np.flatnonzero(seen)
    seen[found] = False
    return found


class Model(NamedTuple):
    """Scores a text: sigmoid(slope * margin + intercept), margin = weights . scaled / |scaled| + bias."""

    weights: np.ndarray
    ratios: np.ndarray
    bias: float
    slope: float
    intercept: float

    def score(self, found: np.ndarray) -> float:
        scale = self.ratios[found]
        length = float(np.sqrt(scale @ scale)) or 1.0
        z = self.slope * (float(self.weights[found] @ scale) / length + self.bias) + self.intercept
        return float(1.0 / (1.0 + np.exp(-min(max(z, -40.0), 40.0))))


def log_count_ratios(rows: list[np.ndarray], labels: np.ndarray, alpha: float = 1.0) -> np.ndarray:
    """log of (share of the indicator among class 1's) / (share among class 0's), smoothed."""
    sums = np.full((2, SIZE), alpha)
    for found, y in zip(rows, labels):
        sums[int(y), found] += 1
    return np.log(sums[1] / sums[1].sum()) - np.log(sums[0] / sums[0].sum())


def dual_descent(rows: list[np.ndarray], values: list[np.ndarray], signs: np.ndarray, bounds: np.ndarray, rounds: int = 30, seed: int = 7) -> tuple[np.ndarray, float]:
    """Weights and bias of the hinge-loss model, by coordinate descent on its dual (box [0, bound] for each row)."""
    weights, bias = np.zeros(SIZE), 0.0
    alpha = np.zeros(len(rows))
    square = np.array([float(v @ v) + 1.0 for v in values])
    order = np.arange(len(rows))
    rng = np.random.default_rng(seed)
    for _ in range(rounds):
        rng.shuffle(order)
        worst = 0.0
        for i in order:
            gradient = signs[i] * (float(weights[rows[i]] @ values[i]) + bias) - 1.0
            move = min(max(alpha[i] - gradient / square[i], 0.0), bounds[i]) - alpha[i]
            if move:
                worst = max(worst, abs(move) * square[i])
                alpha[i] += move
                weights[rows[i]] += move * signs[i] * values[i]
                bias += move * signs[i]
        if worst < 0.01:
            break
    return weights, bias


def calibrate(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a logistic curve over margins, by Newton steps with a small ridge."""
    beta = np.array([1.0, 0.0])
    x = np.column_stack([margins, np.ones(len(margins))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (labels - p) - 1e-2 * (beta - [1.0, 0.0])
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-2 * np.eye(2), gradient)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])


def fit(rows: list[np.ndarray], labels: np.ndarray, cost: float = 1.0) -> Model:
    """The model of labelled indicator rows. Every fourth row calibrates; the others are fitted, both classes weighing alike.

    With no rows of one class nothing can be told apart: the score is the share of class 1, or 1 with no rows.
    """
    labels = np.asarray(labels, dtype=np.int64)
    fitted = np.arange(len(labels)) % 4 != 3
    if min(((labels == y) & part).sum() for y in (0, 1) for part in (fitted, ~fitted)) == 0:
        share = min(max(float(labels.mean()), 0.01), 0.99) if len(labels) else 0.99
        return Model(np.zeros(SIZE), np.zeros(SIZE), 0.0, 1.0, float(np.log(share / (1 - share))))
    train = [r for r, keep in zip(rows, fitted) if keep]
    y = labels[fitted]
    ratios = log_count_ratios(train, y)
    scaled = [ratios[r] / (np.sqrt(ratios[r] @ ratios[r]) or 1.0) for r in train]
    bounds = cost * len(y) / (2.0 * np.array([(y == 0).sum(), (y == 1).sum()]))[y]
    weights, bias = dual_descent(train, scaled, 2.0 * y - 1, bounds)
    plain = Model(weights, ratios, bias, 1.0, 0.0)

    def margin(found: np.ndarray) -> float:
        scale = ratios[found]
        return float(weights[found] @ scale) / (float(np.sqrt(scale @ scale)) or 1.0) + bias

    kept = [r for r, keep in zip(rows, fitted) if not keep]
    slope, intercept = calibrate(np.array([margin(r) for r in kept]), labels[~fitted])
    return plain._replace(slope=slope, intercept=intercept)


def fold(id_col: str, folds: int):
    """crc32 of the id as text, modulo ``folds``; null ids are in fold 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds, F.lit(0))


def labelled_sample(docs: DataFrame, labels: DataFrame, most: int, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", folds: int = 5) -> DataFrame:
    """At most ``most`` labelled texts (text, label) outside fold 0, chosen by a hash of the id.

    The sample of ids is bounded and goes out to the documents, which aren't
    shuffled; of documents that share an id one is taken, before the shuffle.
    """
    usable = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & (fold(id_col, folds) != 0))
    usable = usable.groupBy(id_col).agg(F.max(label_col).alias("label"))
    chosen = usable.orderBy(F.xxhash64(F.lit(11), F.col(id_col)), id_col).limit(most).withColumnRenamed(id_col, "__id")
    texts = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).join(F.broadcast(chosen), "__id")
    return texts.groupBy("__id").agg(F.min("text").alias("text"), F.max("label").alias("label"))


def fit_quality(docs: DataFrame, labels: DataFrame, max_labelled: int = 8000, **columns) -> Model:
    """Fit on a bounded sample of labelled rows; ``max_labelled`` bounds what reaches the driver (their indicator numbers)."""
    small_batches(docs.sparkSession)

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = np.zeros(SIZE, dtype=bool)
        for batch in batches:
            found = [indicators(t, seen).astype("<u4").tobytes() for t in batch["text"]]
            yield pd.DataFrame({"id": batch["__id"], "label": batch["label"], "found": found})

    sample = labelled_sample(docs, labels, max_labelled, **columns)
    rows = sorted(sample.mapInPandas(features, "id bigint, label int, found binary").toLocalIterator(), key=lambda r: r["id"])
    rng = np.random.default_rng(3)
    order = rng.permutation(len(rows))
    return fit([np.frombuffer(rows[i]["found"], dtype="<u4").astype(np.int64) for i in order], np.array([rows[i]["label"] for i in order], dtype=np.int64))


def score_column(model: Model, docs: DataFrame, text_col: str = "text"):
    """The score of each whole text as a column of ``docs``; a null or empty text has no indicators and gets the bias's score."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        seen = np.zeros(SIZE, dtype=bool)
        for texts in batches:
            yield pd.Series([shared.value.score(indicators(t, seen)) for t in texts], dtype="float64")

    return score(F.col(text_col))


def keep_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **options) -> DataFrame:
    """``docs`` without those that score below ``threshold``. Ids, languages, sources and labels aren't looked at; other columns stay."""
    model = fit_quality(docs, labels, **options)
    return docs.where(score_column(model, docs) >= threshold)
