"""Tables that grow with the corpus are never broadcast, however small Spark believes them to be."""

import re

from proseframe.llm import simhash
from proseframe.llm.simhash import near_pairs, one_per_group, simhash_groups


def joins(df):
    """The joins of the plan that is about to run, the last one first."""
    return re.findall(r"\w+Join\b", df._jdf.queryExecution().executedPlan().toString())


def test_probes_are_not_broadcast(spark, tmp_path):
    spark.range(500).selectExpr("xxhash64(id) fp").write.parquet(f"{tmp_path}/prints")
    pairs = near_pairs(spark.read.parquet(f"{tmp_path}/prints"))
    assert joins(pairs) == ["SortMergeJoin"]
    pairs.collect()
    assert set(joins(pairs)) == {"SortMergeJoin"}


def test_rows_are_not_broadcast(odd):
    assert joins(simhash_groups(odd))[0] == "SortMergeJoin"


def test_chosen_rows_are_not_broadcast(odd, monkeypatch):
    seen = {}

    def spy(df, purpose, write=simhash.write_through):
        seen[purpose] = joins(df)
        return write(df, purpose)

    monkeypatch.setattr(simhash, "write_through", spy)
    assert one_per_group(odd).count()
    assert seen["simhash-gone"] == ["SortMergeJoin"]
