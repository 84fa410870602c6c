"""Connected components of an edge table, as rounds of joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proseframe.session import remove, shared_dir


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], int(row["h"] or 0)


def _written(df: DataFrame) -> tuple[DataFrame, str]:
    path = shared_dir(df.sparkSession, "edges")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def connected(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for each node of ``edges`` (u, v); root is the component's smallest node.

    Alternates "large star" (a node hands its larger neighbours to its smallest
    one) and "small star" (a node hands its smaller neighbours to its smallest
    one) until the edges stop changing, which takes a number of rounds that
    grows with the logarithm of the longest path. A hub is never gathered: its
    minimum is an aggregate that is combined before the shuffle, and it is
    joined back to the hub's edges, a join whose large side Spark may split.
    Each round is written to the shared folder, so lineage stays short; the
    driver sees one count and one checksum a round. Nulls and self loops are
    left out; an empty table gives an empty result.
    """
    spark = edges.sparkSession
    plain = edges.where("u is not null and v is not null and u <> v")
    current, path = _written(plain.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = _state(current)
    for _ in range(max_rounds):
        if not state[0]:
            break
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after, new = _written(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        now = _state(after)
        remove(spark, path)
        done = now == state
        current, path, state = after, new, now
        if done:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
