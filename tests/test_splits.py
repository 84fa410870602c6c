import hashlib
import math

import pytest
from helpers import rows
from pyspark.sql import functions as F

from proseframe.operators.cleaning import clean_samples, cleaning_counts, rename_columns, resolve_pair_columns
from proseframe.operators.ranks import batch_number, global_rank
from proseframe.operators.report import data_summary
from proseframe.operators.splits import first_k, sample_exact, split_counts, split_exact, split_hash


def order(n, seed=42):
    return sorted(range(n), key=lambda i: hashlib.md5(f"{seed}-{i}".encode()).hexdigest())


def ids(spark, n):
    return spark.range(n).withColumnRenamed("id", "sample_id")


@pytest.mark.parametrize("n,ratios", [(0, (0.8, 0.1, 0.1)), (1, (0.8, 0.1, 0.1)), (20, (0.7, 0.3, 0.0)), (100, (0.29, 0.3, 0.41)), (200, (0.8, 0.2, 0.0)), (5000, (0.5, 0.25, 0.25)), (7, (0.0, 0.0, 1.0))])
def test_split_exact_is_the_rank_split(spark, n, ratios):
    got = dict(rows(split_exact(ids(spark, n), *ratios)))
    n_train, n_val = int(n * ratios[0]), int(n * ratios[1])
    want = {}
    for place, i in enumerate(order(n)):
        want[i] = "train" if place < n_train else "validation" if place < n_train + n_val else "test"
    assert got == want


def test_ratios_must_sum_to_one(spark):
    with pytest.raises(ValueError):
        split_exact(ids(spark, 3), 0.8, 0.1, 0.2)
    with pytest.raises(ValueError):
        split_hash(ids(spark, 3), 0.5, 0.1, 0.1)


@pytest.mark.parametrize("n,k", [(50, 10), (50, 50), (50, 60), (50, 1), (50, None), (3000, 1234)])
def test_sample_exact(spark, n, k):
    got = {r[0] for r in rows(sample_exact(ids(spark, n), k, seed=3))}
    assert got == set(order(n, 3)[: k or n])


def test_samples_do_not_depend_on_partitioning(spark):
    a = rows(split_exact(ids(spark, 500)))
    assert a == rows(split_exact(ids(spark, 500).repartition(7)))
    assert rows(split_hash(ids(spark, 500))) == rows(split_hash(ids(spark, 500).repartition(3)))


def test_splits_partition_the_input(spark):
    parts = split_hash(ids(spark, 2000))
    train, rest = parts.where("split = 'train'"), parts.where("split <> 'train'")
    assert train.select("sample_id").intersect(rest.select("sample_id")).isEmpty()
    assert parts.select("sample_id").exceptAll(ids(spark, 2000)).isEmpty()
    counts = dict(rows(split_counts(parts)))
    assert sum(counts.values()) == 2000 and abs(counts["train"] - 1600) < 80


def test_global_rank_and_batches(spark):
    got = dict(rows(global_rank(ids(spark, 700))))
    assert got == {i: place + 1 for place, i in enumerate(order(700))}
    batches = dict(rows(batch_number(ids(spark, 30), 8)))
    assert batches == {i: place // 8 for place, i in enumerate(order(30))}


def test_first_k(spark):
    df = ids(spark, 100).withColumn("split", F.when(F.col("sample_id") < 95, "train").otherwise("test"))
    got = rows(first_k(df, 7))
    assert got == sorted([(i, "train") for i in range(7)] + [(i, "test") for i in range(95, 100)])


def test_clean_samples_keeps_rows_with_empty_label(spark):
    df = spark.createDataFrame(
        [(1, " a  b ", "  "), (2, " 　\n", "x"), (3, None, "y"), (4, "c", None)], "sample_id bigint, text string, label string"
    )
    assert clean_samples(df).columns == df.columns
    assert sorted(map(str, clean_samples(df).collect())) == sorted(
        ["Row(sample_id=1, text='a b', label='')", "Row(sample_id=4, text='c', label=None)"]
    )
    assert tuple(cleaning_counts(df).first()) == (4, 2)


def test_renames(spark):
    df = spark.createDataFrame([("a", "b")], "body string, target string")
    assert rename_columns(df, "body", "target").columns == ["text", "label"]
    assert rename_columns(df, "absent", "missing").columns == ["body", "target"]
    with pytest.raises(ValueError):
        rename_columns(df.withColumnRenamed("target", "text"), "body")
    got = resolve_pair_columns(df.withColumnRenamed("body", "input_text")).select("input", "reference").first()
    assert tuple(got) == ("a", "b")
    with pytest.raises(ValueError):
        resolve_pair_columns(df)


def test_summary(spark):
    df = split_exact(ids(spark, 10))
    got = data_summary(df, {"source": "x", "options": {"clean": True, "max": None}}).first().asDict(recursive=True)
    assert got["source"] == "x" and got["options"] == {"clean": True, "max": None}
    assert got["dataset_sizes"] == {"train": 8, "validation": 1, "test": 1}
    assert math.isclose(sum(got["dataset_sizes"].values()), 10)


def test_repeated_and_missing_ids(spark):
    rows_ = [("u-1", i) for i in range(8)] + [("u-2", 0), ("u-3", 1)]
    df = spark.createDataFrame(rows_, "sample_id string, n int")
    for n in range(1, 11):
        assert sample_exact(df, n, ties=["n"]).count() == n
    counts = {r["split"]: r["n_rows"] for r in split_counts(split_exact(df, 0.5, 0.3, 0.2, ties=["n"])).collect()}
    assert counts == {"train": 5, "validation": 3, "test": 2}
    # whether the cut falls between rows of one id depends on the order: it is exact or an error, never silently off
    for n in range(1, 10):
        try:
            assert sample_exact(df, n).count() == n
        except Exception as e:
            assert "ties" in str(e)
    with pytest.raises(Exception, match="null"):
        sample_exact(spark.createDataFrame([(None, 1), ("a", 2)], "sample_id string, n int"), 1).collect()
