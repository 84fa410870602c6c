"""Readers with their edge rows, and writers."""

import json

import pytest
from helpers import rows
from pyspark.sql import functions as F

from proseframe.operators.splits import split_exact
from proseframe.plans.prepare import prepare_dataset
from proseframe.sinks.writers import write_inference, write_report, write_samples, write_splits
from proseframe.sources.datasets import load_named, read_split, resolve_dataset
from proseframe.sources.metric_log import append_metric_log, number_entries, read_metric_log
from proseframe.sources.prompts import read_prompts
from proseframe.sources.samples import read_samples
from proseframe.sources.synthetic import CHOICES, synthetic_samples

CSV = 'id,text,label\n1,"say ""hi""",a\n2,"two\nlines", b \n3,,c\n4,  padded  ,\n5\n6,é😀,d,extra\n'


def texts(samples):
    return sorted((r["text"], r["label"]) for r in samples.collect())


def reasons(quarantine):
    return sorted(r["reason"] for r in quarantine.collect())


def put(tmp_path, name, content):
    path = tmp_path / name
    path.write_text(content, encoding="utf-8")
    return str(path)


@pytest.mark.parametrize("sep,name", [(",", "a.csv"), ("\t", "a.TSV")])
def test_delimited(spark, tmp_path, sep, name):
    samples, bad = read_samples(spark, put(tmp_path, name, CSV.replace(",", sep)), "text", "label")
    assert sorted(texts(samples)) == sorted([('say "hi"', "a"), ("two\nlines", "b"), ("", "c"), ("padded", ""), ("é😀", "d")])
    assert reasons(bad) == ["text field missing"]
    ids = [r["sample_id"] for r in samples.collect()]
    assert len(set(ids)) == 5


def test_delimited_without_label(spark, tmp_path):
    path = put(tmp_path, "a.csv", CSV)
    samples, _ = read_samples(spark, path, "text", "absent")
    assert {r["label"] for r in samples.collect()} == {None}
    samples, _ = read_samples(spark, path, "text", id_col="id")
    assert sorted(r["sample_id"] for r in samples.collect()) == ["1", "2", "3", "4", "6"]
    with pytest.raises(ValueError):
        read_samples(spark, path, "body")
    with pytest.raises(ValueError):
        read_samples(spark, put(tmp_path, "a.txt", "x"), fmt="xml")


def test_jsonl(spark, tmp_path):
    lines = [
        '{"text": " a ", "label": 5}', "", "   ", "{broken", '{"text": null}', '{"text": {"k": [1, 2]}, "label": true}',
        '{"label": "no text"}', '["text"]', '{"text": "b", "label": null}', '{"text": "c"} trailing', "7", '{"text": 1.5}',
    ]
    samples, bad = read_samples(spark, put(tmp_path, "a.jsonl", "\n".join(lines)), "text", "label")
    assert sorted(map(str, texts_unsorted(samples))) == sorted(
        map(str, [("a", "5"), ('{"k":[1,2]}', "true"), ("b", None), ("1.5", None)])
    )
    assert reasons(bad) == ["not a JSON object"] * 4 + ["text is null", "text key missing"]


def texts_unsorted(samples):
    return [(r["text"], r["label"]) for r in samples.collect()]


def test_jsonl_other_encoding(spark, tmp_path):
    path = tmp_path / "l.jsonl"
    path.write_bytes('{"text": "é"}\n'.encode("latin-1"))
    samples, _ = read_samples(spark, str(path), encoding="ISO-8859-1")
    assert texts_unsorted(samples) == [("é", None)]


def test_json(spark, tmp_path):
    items = [{"text": " a ", "label": 1}, {"text": None}, {"label": "x"}, {"text": True, "label": "é"}]
    samples, bad = read_samples(spark, put(tmp_path, "a.json", "\n " + json.dumps(items, indent=2)), "text", "label")
    assert sorted(texts_unsorted(samples)) == [("a", "1"), ("true", "é")]
    assert reasons(bad) == ["text missing or null"] * 2
    with pytest.raises(ValueError):
        read_samples(spark, put(tmp_path, "b.json", '{"text": "a"}'))


def test_directory_takes_the_first_format(spark, tmp_path):
    put(tmp_path, "b.jsonl", '{"text": "from jsonl"}')
    put(tmp_path, "c.json", '[{"text": "from json"}]')
    put(tmp_path, "d.JSON", '[{"text": "also json"}]')
    samples, _ = read_samples(spark, str(tmp_path))
    assert sorted(t for t, _ in texts_unsorted(samples)) == ["also json", "from json"]
    empty = tmp_path / "empty"
    empty.mkdir()
    with pytest.raises(ValueError):
        read_samples(spark, str(empty))


@pytest.mark.parametrize("fmt", ["csv", "tsv", "json", "jsonl"])
def test_write_and_read_back(spark, tmp_path, fmt):
    data = [(1, 'quote " and, comma', "x"), (2, "two\nlines\ttab", "é"), (3, "back\\slash", ""), (4, "中😀", "y"), (5, "", "z")]
    df = spark.createDataFrame(data, "sample_id bigint, text string, label string").repartition(3)
    path = str(tmp_path / fmt)
    write_samples(df, path, fmt)
    samples, bad = read_samples(spark, path, "text", "label", fmt=fmt, id_col="sample_id")
    assert rows(samples) == sorted((str(i), *rest) for i, *rest in data)
    assert bad.isEmpty()
    if fmt == "json":
        for part in (tmp_path / fmt).glob("part-*"):
            content = part.read_text(encoding="utf-8")
            assert content == "" or isinstance(json.loads(content), list)
    with pytest.raises(ValueError):
        write_samples(df, path, "xml")


def test_prompts(spark, tmp_path):
    got = read_prompts(spark, put(tmp_path, "p.txt", "  one \n\n 　\ntwo\r\nthree")).orderBy("prompt_id").collect()
    assert [r["prompt"] for r in got] == ["one", "two", "three"]


def test_split_sets(spark, tmp_path):
    df = split_exact(spark.range(20).withColumnRenamed("id", "sample_id"), 0.5, 0.5, 0.0)
    path = str(tmp_path / "set")
    write_splits(df, path)
    assert read_split(spark, path, "validation").count() == 10
    assert {r["split"] for r in read_split(spark, path, "test").collect()} == {"train"}
    scan = read_split(spark, path, "validation")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in scan
    assert resolve_dataset(spark, path, split="train", sample_size=4).count() == 4


def test_named_table(spark):
    spark.createDataFrame([(1, "a", "x", "test"), (2, "b", "y", "train")], "sample_id int, body string, tag string, split string").createOrReplaceTempView("named")
    assert load_named(spark, "named", split="test", text_col="body", label_col="tag").select("text", "label").collect() == [("a", "x")]
    assert resolve_dataset(spark, "named", "body", "tag", "train").select("text").collect() == [("b",)]


def test_synthetic(spark):
    got = synthetic_samples(spark, 500, "summarization")
    assert got.count() == 500 and got.select("text", "label").distinct().count() == 9
    assert rows(got) == rows(synthetic_samples(spark, 500, "summarization").repartition(5))
    assert {r["label"] for r in got.collect()} <= set(CHOICES["summarization"][1])
    assert synthetic_samples(spark, 10, "unknown").isEmpty()


def test_metric_log_files(spark, tmp_path):
    path = str(tmp_path / "runs")
    log = spark.createDataFrame([("r", 1, 1.0, 10, 0.5, None)], "run_id string, log_seq bigint, epoch double, step bigint, train_loss double, eval_loss double")
    append_metric_log(log, path)
    append_metric_log(log.withColumn("log_seq", F.lit(2).cast("bigint")), path)
    got = read_metric_log(spark, path)
    assert sorted(r["log_seq"] for r in got.collect()) == [1, 2]
    assert got.first()["eval_loss"] is None and got.first()["learning_rate"] is None
    bare = tmp_path / "runB"
    bare.mkdir()
    (bare / "log.jsonl").write_text('{"step": 1}\n{"step": 2}\n')
    filled = number_entries(read_metric_log(spark, str(bare))).orderBy("log_seq").collect()
    assert [(r["run_id"], r["step"]) for r in filled] == [("runB", 1), ("runB", 2)]


def test_inference_rows_leave_out_absent_output(spark, tmp_path):
    df = spark.createDataFrame([(0, "p", "a b c", None), (1, "q", "d", ""), (2, "r", "e", "f g")], "prompt_id bigint, prompt string, output string, remote_output string")
    path = str(tmp_path / "inf")
    write_inference(df.coalesce(1), path)
    got = [json.loads(line) for p in sorted((tmp_path / "inf").glob("part-*")) for line in p.read_text().splitlines()]
    assert got[0] == {"prompt_id": 0, "input": "p", "local_output": "a b c", "local_output_length": 3}
    assert "remote_output" not in got[1] and got[2]["remote_output_length"] == 2


def test_text_report_keeps_line_order(spark, tmp_path):
    from proseframe.operators.report import listing_lines, metric_lines

    metrics = spark.createDataFrame([("b", 0.5), ("a", 1 / 3)], "metric string, value double")
    path = str(tmp_path / "report")
    write_report(metric_lines(metrics, "Evaluation Summary", {"Task Type": "x"}), path, "text")
    lines = "".join(p.read_text() for p in (tmp_path / "report").glob("part-*")).splitlines()
    assert lines == ["Evaluation Summary", "=" * 40, "", "Task Type: x", "", "Metrics:", "  a: 0.3333", "  b: 0.5000"]
    rows_ = spark.createDataFrame([(0, "in", "out", None)], "prompt_id bigint, input string, local_output string, remote_output string")
    assert listing_lines(rows_).first()["line"].startswith("Example 1:\nInput: in\nLocal Output: out\n---")


def test_prepare_end_to_end(spark, tmp_path):
    content = "body,tag\n" + "".join(f'"sample  number {i}",t{i % 3}\n' for i in range(40)) + '"   ",blank\n'
    source = put(tmp_path, "in.csv", content)
    vocabulary = spark.createDataFrame([("sample", 5), ("number", 6)], "token string, token_id int")
    out = str(tmp_path / "out")
    got = prepare_dataset(spark, source, out, "body", "tag", vocabulary=vocabulary, max_length=4, seed=1)
    assert got.count() == 40 and got.where("split = 'train'").count() == 32
    assert got.first()["input_ids"] == [5, 6, 1, 0]
    assert spark.read.json(f"{out}/summary").first()["dataset_sizes"]["test"] == 4
    assert spark.read.json(f"{out}/samples").groupBy("split").count().orderBy("count").first()["count"] == 4


def test_intermediate_tables_are_removed(spark, tmp_path, monkeypatch):
    """After their result is written and the scope ends nothing is left in the shared folder."""
    import os

    import proseframe.session as session
    from proseframe.plans.catalogue import QUERIES

    monkeypatch.setattr(session, "shared_base", lambda spark, base=None: str(tmp_path / "shared"))
    small = "/root/testdata/sf0.001"
    for name in ("encode_fixed_length", "early_stop", "roundtrip_csv", "complete_ledger", "pair_by_position"):
        with session.intermediate_tables(spark):
            QUERIES[name](spark, small).write.parquet(str(tmp_path / name))
            assert os.listdir(tmp_path / "shared")
        assert os.listdir(tmp_path / "shared") == [] and spark.read.parquet(str(tmp_path / name)).count() > 0
    with pytest.raises(ZeroDivisionError), session.intermediate_tables(spark):
        session.write_through(spark.range(3), "x")
        1 / 0
    assert os.listdir(tmp_path / "shared") == []
    outer = session.shared_dir(spark, "outside")
    assert outer.startswith(str(tmp_path))
