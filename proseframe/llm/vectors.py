"""Near-duplicate embeddings by an inverted multi-index.

Two codebooks, one for each half of the vectors, span a grid of cells. Each
vector is stored in its nearest cell and searches the cells nearest to it in
order of distance (multi-sequence traversal) up to a margin that reaches the
target recall on the links of a query sample compared with all rows, and on
neighbours planted at the threshold around sampled vectors. Every candidate is
verified by its cosine in double precision.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from proseframe.llm.batches import small_batches
from proseframe.llm.components import connected
from proseframe.session import write_through

#: rows of a cell or of its searchers in one comparison
CHUNK = 2000
#: width of a step of the margin's histogram
STEP = 1 / 128
SAMPLE, QUERIES = 8192, 256
#: queries compared with all rows at most, where few of them have links; vectors around which neighbours are planted
MOST, PLANTED = 2048, 4096
#: lengths of vectors in one table at most
LENGTHS = 100


class Grid(NamedTuple):
    """The codebooks of the two halves and the margin up to which cells are visited."""

    first: np.ndarray
    second: np.ndarray
    margin: float

    def distances(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared distances of the halves of unit vectors to their centres."""
        cut = self.first.shape[1]
        return _squares(units[:, :cut], self.first), _squares(units[:, cut:], self.second)


def _squares(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (x * x).sum(axis=1)[:, None] - 2 * (x @ centres.T) + (centres * centres).sum(axis=1)[None, :]


def unit_rows(raw, kind: str) -> np.ndarray:
    """Vectors from their bytes, in double precision, scaled to length 1 (scaled down first, lest squares overflow)."""
    x = np.frombuffer(b"".join(raw), dtype=kind).astype(np.float64).reshape(len(raw), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def k_means(x: np.ndarray, k: int, rounds: int = 12, seed: int = 5) -> np.ndarray:
    """``k`` centres (fewer if there are fewer points); a centre that loses all its points moves to the farthest point."""
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        squares = _squares(x, centres)
        nearest = squares.argmin(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, x)
        sizes = np.bincount(nearest, minlength=len(centres))
        centres = sums / np.maximum(sizes, 1)[:, None]
        for gone in np.flatnonzero(sizes == 0):
            centres[gone] = x[squares.min(axis=1).argmax()]
    return centres


def multi_sequence(first: np.ndarray, second: np.ndarray, margin: float) -> Iterator[tuple[int, int]]:
    """Cells (i, j) in ascending order of first[i] + second[j], while within ``margin`` of the nearest.

    The frontier holds a cell once its left and lower neighbours in the sorted
    grid have been visited.
    """
    a, b = np.argsort(first, kind="stable").tolist(), np.argsort(second, kind="stable").tolist()
    da, db = first[a].tolist(), second[b].tolist()
    limit = da[0] + db[0] + margin
    front = [(da[0] + db[0], 0, 0)]
    reached = [0] * len(a)  # how many cells of each row have been visited
    while front:
        distance, i, j = heapq.heappop(front)
        if distance > limit:
            return
        yield a[i], b[j]
        reached[i] = j + 1
        if j + 1 < len(b) and (i == 0 or reached[i - 1] > j + 1):
            heapq.heappush(front, (da[i] + db[j + 1], i, j + 1))
        if i + 1 < len(a) and reached[i + 1] == j:
            heapq.heappush(front, (da[i + 1] + db[j], i + 1, j))


def _local_labels(linked: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest id that each row and column reaches over the links of one comparison."""
    rows, columns = rows.copy(), columns.copy()
    far = np.iinfo(np.int64).max
    while True:
        to_columns = np.minimum(columns, np.where(linked, rows[:, None], far).min(axis=0))
        to_rows = np.minimum(rows, np.where(linked, to_columns[None, :], far).min(axis=1))
        if (to_rows == rows).all() and (to_columns == columns).all():
            return rows, columns
        rows, columns = to_rows, to_columns


def _raw(column, kind: str):
    @F.pandas_udf("binary")
    def raw(vectors: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in vectors:
            out = []
            for v in batch:
                x = np.array([] if v is None else v, dtype=np.float64)
                out.append(x.astype(kind).tobytes() if len(x) and np.isfinite(x).all() and x.any() else None)
            yield pd.Series(out, dtype=object)

    return raw(column)


def planted_margin(grid: Grid, units: np.ndarray, threshold: float, recall: float, seed: int = 3) -> float:
    """The margin within which ``recall`` of planted neighbours lie, whichever way they lie.

    Around each unit vector one neighbour has just the threshold's cosine in a
    random direction, one within the first half, one within the second, and one
    towards another vector: links of a real corpus, whose cosines lie between
    the threshold and 1, are nearer.
    """
    rng = np.random.default_rng(seed)
    noise, cut = rng.standard_normal(units.shape), grid.first.shape[1]
    halves = [noise * (np.arange(units.shape[1]) < cut), noise * (np.arange(units.shape[1]) >= cut)]
    d1, d2 = grid.distances(units)
    nearest = d1.min(axis=1) + d2.min(axis=1)
    worst, rows = 0.0, np.arange(len(units))
    for towards in (noise, *halves, units[rng.permutation(len(units))]):
        across = towards - units * (towards * units).sum(axis=1, keepdims=True)
        size = np.sqrt((across * across).sum(axis=1, keepdims=True))
        there = size[:, 0] > 1e-9
        if not there.any():
            continue
        y = threshold * units + math.sqrt(1 - threshold * threshold) * across / np.maximum(size, 1e-12)
        e1, e2 = grid.distances(y)
        need = d1[rows, e1.argmin(axis=1)] + d2[rows, e2.argmin(axis=1)] - nearest
        worst = max(worst, float(np.quantile(need[there], recall)))
    return worst


def fit_grid(classes: DataFrame, n: int, kind: str, threshold: float, recall: float, per_cell: int, most_centres: int) -> Grid:
    """Codebooks from at most ``SAMPLE`` vectors; the margin from real and from planted links.

    ``QUERIES`` to ``MOST`` of the vectors are compared with all rows. Their
    links with other classes are counted by how far beyond its nearest cell a
    query would have had to go, once per link and once per query with links;
    only counts per step travel. More queries are compared until
    1 / (1 - recall) of them have links. The margin reaches ``recall`` by either
    count and on neighbours planted around ``PLANTED`` of the vectors, which
    stand for the links where there are too few.
    """
    chosen = classes.orderBy(F.xxhash64("cid"), "cid").limit(max(SAMPLE, MOST)).select("cid", "raw").collect()
    units, names = unit_rows([bytes(r["raw"]) for r in chosen], kind), np.array([r["cid"] for r in chosen], dtype=np.int64)
    cut = max(1, units.shape[1] // 2)

    def codebooks(size: int) -> Grid:
        centres = int(min(max(2, round((n / size) ** 0.5)), most_centres))
        first = k_means(units[:SAMPLE, :cut], centres)
        return Grid(first, k_means(units[:SAMPLE, cut:], centres) if units.shape[1] > 1 else np.zeros((1, 0)), 0.0)

    grid = codebooks(per_cell)
    spark = classes.sparkSession

    def measured(since: int, until: int) -> pd.DataFrame:
        shared = spark.sparkContext.broadcast((grid, units[since:until], names[since:until]))

        def margins(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            grid, every, asking = shared.value
            for batch in batches:
                x, cid = unit_rows([bytes(r) for r in batch["raw"]], kind), batch["cid"].to_numpy()
                d1, d2 = grid.distances(x)
                home1, home2 = d1.argmin(axis=1), d2.argmin(axis=1)
                for at in range(0, len(every), QUERIES):
                    queries = every[at : at + QUERIES]
                    q, m = np.nonzero(queries @ x.T >= threshold)
                    other = asking[at + q] != cid[m]
                    q, m = q[other], m[other]
                    if not len(q):
                        continue
                    q1, q2 = grid.distances(queries)
                    need = q1[q, home1[m]] + q2[q, home2[m]] - (q1.min(axis=1) + q2.min(axis=1))[q]
                    steps = np.ceil(np.maximum(need, 0) / STEP).astype(np.int64)
                    keys, counts = np.unique(np.column_stack([q, steps]), axis=0, return_counts=True)
                    yield pd.DataFrame({"q": since + at + keys[:, 0], "step": keys[:, 1], "n": counts})

        links = classes.select("cid", "raw").mapInPandas(margins, "q bigint, step bigint, n bigint")
        found = links.groupBy("q", "step").agg(F.sum("n").alias("n")).toPandas()
        shared.unpersist()
        return found

    most = min(MOST, len(units)) if recall < 1 else 0
    enough = round(1 / (1 - recall)) if recall < 1 else 1
    found, done, linked = pd.DataFrame({"q": [], "step": [], "n": []}).astype("int64"), 0, 0
    while linked < enough and done < most:
        goal = QUERIES if not done else most if not linked else max(2 * done, math.ceil(1.25 * enough * done / linked))
        goal = min(goal, most)
        found = pd.concat([found, measured(done, goal)])
        done, linked = goal, found["q"].nunique()
    planted = 0.0 if linked >= enough or done >= n else planted_margin(grid, units[:PLANTED], threshold, recall)
    if not len(found):
        return grid._replace(margin=planted)
    found["share"] = found["n"] / found.groupby("q")["n"].transform("sum")
    by_step = found.groupby("step")[["n", "share"]].sum().sort_index()
    reached = (by_step.cumsum() / by_step.sum() >= recall).all(axis=1)
    return grid._replace(margin=max(planted, (float(by_step.index[reached.argmax()]) + 0.5) * STEP))


def _index(grid, kind: str):
    """Rows of class vectors as what they store (side 0) and whom they ask (side 1), by cell."""

    def entries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 200):
                part = batch.iloc[at : at + 200]
                d1, d2 = grid.value.distances(unit_rows([bytes(r) for r in part["raw"]], kind))
                width = d2.shape[1]
                home = d1.argmin(axis=1) * width + d2.argmin(axis=1)
                asked = [[i * width + j for i, j in multi_sequence(a, b, grid.value.margin)] for a, b in zip(d1, d2)]
                yield pd.DataFrame({"cid": part["cid"], "n": part["n"], "raw": part["raw"], "home": home, "own": d1.min(axis=1) + d2.min(axis=1), "asked": asked})

    return entries


def _verify(grid, kind: str, threshold: float):
    """Compares what asks with what is stored, one bounded (cell, chunk, chunk) after the other.

    For each class: links it found, links that only the other side found, and
    the local root that joins it to what it links with.
    """

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        side = rows["side"].to_numpy()
        stored, asking = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        empty = pd.DataFrame({"cid": [], "links": [], "root": []}).astype("int64")
        if not len(stored) or not len(asking):
            return empty
        raw = [bytes(r) for r in rows["raw"]]
        units = unit_rows(raw, kind)
        cid, n, home, own = (rows[c].to_numpy() for c in ("cid", "n", "home", "own"))
        linked = units[asking] @ units[stored].T >= threshold
        linked &= cid[asking][:, None] != cid[stored][None, :]
        if not linked.any():
            return empty
        homes, which = np.unique(home[asking], return_inverse=True)
        d1, d2 = grid.value.distances(units[stored])
        width = d2.shape[1]
        back = d1[:, homes // width] + d2[:, homes % width] <= (own[stored] + grid.value.margin)[:, None]
        found = linked @ n[stored]
        only = (linked & ~back[:, which].T).T @ n[asking]
        to_rows, to_columns = _local_labels(linked, cid[asking], cid[stored])
        out = pd.DataFrame(
            {"cid": np.concatenate([cid[asking], cid[stored]]), "links": np.concatenate([found, only]), "root": np.concatenate([to_rows, to_columns])}
        )
        return out[(out["links"] > 0) | (out["root"] != out["cid"])]

    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        last = None
        for batch in batches:
            keys = batch[["cell", "stored_chunk", "asked_chunk"]].to_numpy()
            edges = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for part in np.split(np.arange(len(batch)), edges):
                key = tuple(keys[part[0]])
                if held and key != last:
                    yield compare(pd.concat(held) if len(held) > 1 else held[0])
                    held = []
                last = key
                held.append(batch.iloc[part])
        if held:
            yield compare(pd.concat(held) if len(held) > 1 else held[0])

    return stream


def near_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.95, recall: float = 0.999, per_cell: int = 256, most_centres: int = 512) -> DataFrame:
    """(id, n_links, component_id, kept) per row: how many other rows link with it, the smallest id reachable.

    Equal vectors become one class first, so copies are never paired. All
    classes are indexed and all of them search. A cell with more than ``CHUNK``
    rows, or that more of them ask for, is compared in blocks of that size that
    any tasks may take, so a hot cell fills no task and none of it is left out.
    A comparison returns one row for each class, not one for each pair.

    A null, empty or all-zero vector, one with null or non-finite components,
    and a row without an id link with nothing and are components of their own.
    Vectors of different lengths are indexed apart and never link. Repeated rows count as rows of a class.
    Other columns are ignored; no rows give no rows.
    """
    spark = rows.sparkSession
    small_batches(spark)
    kind = "<f8" if rows.schema[vector_col].dataType == ArrayType(DoubleType()) else "<f4"
    vectors = F.when(~F.exists(vector_col, lambda x: x.isNull()), F.col(vector_col))
    given = write_through(rows.select(F.col(id_col).cast("bigint").alias("id"), _raw(vectors, kind).alias("raw")), "vectors")
    named = F.col("id").isNotNull() & F.col("raw").isNotNull()
    alone = given.where(~named).select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    lengths = [r["bytes"] for r in given.where(named).select(F.length("raw").alias("bytes")).distinct().orderBy("bytes").limit(LENGTHS + 1).collect()]
    if len(lengths) > LENGTHS:
        raise ValueError(f"vectors of more than {LENGTHS} lengths")
    for size in lengths:
        same = given.where(named & (F.length("raw") == size))
        alone = alone.unionByName(_linked(same, kind, threshold, recall, per_cell, most_centres))
    return alone


def _linked(given: DataFrame, kind: str, threshold: float, recall: float, per_cell: int, most_centres: int) -> DataFrame:
    """The rows of :func:`near_vectors` for usable vectors (id, raw) of one length."""
    spark = given.sparkSession
    classes = given.groupBy("raw").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    classes = write_through(classes.withColumn("cid", F.monotonically_increasing_id()), "vector-classes")
    fitted = fit_grid(classes, classes.count(), kind, threshold, recall, per_cell, most_centres)
    grid = spark.sparkContext.broadcast(fitted)

    entries = classes.select("cid", "n", "raw").mapInPandas(_index(grid, kind), "cid bigint, n bigint, raw binary, home bigint, own double, asked array<bigint>")
    entries = write_through(entries, "vector-index")
    stores = entries.groupBy(F.col("home").alias("cell")).agg(F.count(F.lit(1)).alias("stored"))
    asks = entries.select(F.explode("asked").alias("cell")).groupBy("cell").agg(F.count(F.lit(1)).alias("asking"))
    # at most one row for each cell of the grid: most_centres squared
    chunks = F.broadcast(stores.join(asks, "cell").select("cell", F.ceil(F.col("stored") / CHUNK).alias("stored_chunks"), F.ceil(F.col("asking") / CHUNK).alias("asked_chunks")))

    def dealt(side: int, cell, mine: str, other: str) -> DataFrame:
        own = entries.select("cid", "n", "raw", "home", "own", cell.alias("cell")).join(chunks, "cell")
        own = own.withColumn(mine, F.pmod(F.xxhash64("cid"), F.col(mine + "s"))).withColumn(other, F.explode(F.sequence(F.lit(0), F.col(other + "s") - 1)))
        return own.select("cell", F.col("stored_chunk").cast("bigint"), F.col("asked_chunk").cast("bigint"), F.lit(side).alias("side"), "cid", "n", "raw", "home", "own")

    both = dealt(0, F.col("home"), "stored_chunk", "asked_chunk").unionByName(dealt(1, F.explode("asked"), "asked_chunk", "stored_chunk"))
    keys = ["cell", "stored_chunk", "asked_chunk"]
    compared = both.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(_verify(grid, kind, threshold), "cid bigint, links bigint, root bigint")
    compared = write_through(compared, "vector-links")
    links = compared.groupBy("cid").agg(F.sum("links").alias("links"))
    roots = connected(compared.where("root <> cid").select(F.col("cid").alias("u"), F.col("root").alias("v"))).select(F.col("node").alias("cid"), "root")
    told = classes.join(links, "cid", "left").join(roots, "cid", "left")
    told = told.select("raw", "first_id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("root", "cid").alias("root"))
    lowest = told.groupBy("root").agg(F.min("first_id").alias("component_id"))
    told = told.join(lowest, "root").select("raw", "n_links", "component_id")
    return given.join(told, "raw").select("id", "n_links", "component_id", (F.col("id") == F.col("component_id")).alias("kept"))
