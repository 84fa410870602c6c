"""Every query of the catalogue on the smallest tables, against its SQL twin."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry_points

SMALL = os.environ.get("TEST_SMALL_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SMALL}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    yield con
    con.close()


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in map(tuple, rows))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    got = df.collect()
    if name not in ORACLES:
        assert got
        return
    result = duck.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    want = result.fetchall()
    assert sorted(df.columns) == sorted(columns)
    assert canonical(df.columns, got) == canonical(columns, want)


def test_entry(spark):
    assert {r["split"] for r in entry_points.entry(spark).collect()} == {"train", "validation", "test"}


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


# --- plans -----------------------------------------------------------------------


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_cut_points_read_only_ids(spark):
    text = plan(QUERIES["split_exact"](spark, SMALL))
    scans = [line for line in text.splitlines() if "ReadSchema" in line]
    assert sum("lang" not in line.split("ReadSchema")[1] for line in scans) >= 2
    main = text.split("Subquery subquery")[0]
    assert "Exchange" not in main  # the rows themselves are never moved


@pytest.mark.parametrize("name", ["rouge_stemmed", "bleu_corpus", "exact_match"])
def test_text_metrics_aggregate_before_the_only_shuffle(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    assert "Exchange SinglePartition" in text and "partial_" in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_no_query_uses_a_cross_join(spark):
    for name in ("split_exact", "running_best", "early_stop", "compare_models", "encode_fixed_length_joined", "batch_numbers"):
        text = plan(QUERIES[name](spark, SMALL))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_first_k_limits_before_the_shuffle(spark):
    text = plan(QUERIES["first_k_per_split"](spark, SMALL))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_runs_are_shuffled_by_chunk(spark):
    """Log rows never meet by run alone: only the chunk summaries do."""
    text = plan(QUERIES["running_best"](spark, SMALL))
    by_run_alone = [line for line in text.splitlines() if "hashpartitioning(run_id#" in line and "_chunk#" not in line]
    by_chunk = [line for line in text.splitlines() if "hashpartitioning(run_id#" in line and "_chunk#" in line]
    assert len(by_run_alone) <= 1 and by_chunk


def test_one_python_step_for_all_text_metrics(spark):
    text = plan(QUERIES["all_text_metrics"](spark, SMALL))
    assert text.count("ArrowEvalPython") == 1
