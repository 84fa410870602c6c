"""Delimited records read by blocks, against Python's csv module and Spark's own reader."""

import csv
import io
import json
import random

import pytest

from proseframe.sources import records
from proseframe.sources.records import ends_inside, read_json_objects, read_records, scan_json
from proseframe.sources.samples import read_samples


def content(rng, rows, ending="\n"):
    fields = ["plain", "", "two words", 'say "hi"', "a\nb", "\n\n", "x,y", '"', '""\n"', "é中", 'end"\n', "1\r\n2"]
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=ending)
    writer.writerow(["text", "label", "id"])
    table = [[rng.choice(fields) + str(rng.randint(0, 9)), rng.choice(fields), f"k{i}"] for i in range(rows)]
    writer.writerows(table)
    return out.getvalue(), table


@pytest.fixture
def small_blocks(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", 97)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("ending", ["\n", "\r\n"])
def test_blocks_equal_csv_module(spark, tmp_path, small_blocks, ending):
    text, table = content(random.Random(3), 150, ending)
    (tmp_path / "a.csv").write_bytes(text.encode())
    records = read_records(spark, str(tmp_path / "a.csv"))
    got = records.orderBy("block", "nth").collect()
    assert len({r["block"] for r in got}) > 20
    assert [next(csv.reader(io.StringIO(r["record"], newline=""))) for r in got][1:] == table and all(r["closed"] for r in got)


def test_samples_equal_those_of_the_plain_reader(spark, tmp_path, small_blocks):
    text, table = content(random.Random(4), 80)
    (tmp_path / "a.csv").write_bytes((text + "short\n\n   \nlong,a,b,c\n").encode())
    for id_col in ("id", None):
        both = [read_samples(spark, str(tmp_path / "a.csv"), "text", "label", id_col=id_col, by_blocks=b) for b in (False, True)]
        columns = ["sample_id", "text", "label"] if id_col else ["text", "label"]
        plain, blocks = (sorted(map(str, samples.select(columns).collect())) for samples, _ in both)
        assert blocks == plain and len(plain) >= 80
        assert sorted(r["reason"] for r in both[1][1].collect()) == sorted(r["reason"] for r in both[0][1].collect())


def test_each_file_has_its_own_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text('text,label\none,1\n"two\n2",2\n')
    (tmp_path / "b.csv").write_text("﻿other,label,text\nx,3,three\n")
    (tmp_path / "c.csv").write_text("label,text\n")
    (tmp_path / "d.csv").write_text("")
    samples, bad = read_samples(spark, str(tmp_path), "text", "label", by_blocks=True)
    assert sorted((r["text"], r["label"]) for r in samples.collect()) == [("one", "1"), ("three", "3"), ("two\n2", "2")] and bad.count() == 0
    with pytest.raises(ValueError, match="nothing"):
        read_samples(spark, str(tmp_path), "nothing", by_blocks=True)


def test_a_quote_that_never_ends(spark, tmp_path, small_blocks):
    (tmp_path / "a.csv").write_text("text,label\nok,1\n" + '"open,2\n' + "more\n" * 100)
    samples, bad = read_samples(spark, str(tmp_path / "a.csv"), "text", "label", by_blocks=True)
    assert [r["text"] for r in samples.collect()] == ["ok"]
    assert [(r["reason"], r["raw"].count("more")) for r in bad.collect()] == [("quoted field never ends", 100)]


@pytest.mark.parametrize("line, inside, then", [("a,b", False, False), ('a,"b', False, True), ('a","b', True, True), ('x""y', True, True), ('x"', True, False), ('5" pipe', False, False), ('"a"', False, False), ('a"b,"', False, True), ("", True, True), ('"', False, True), ('""', False, False), ('"""', False, True)])
def test_ends_inside(line, inside, then):
    assert ends_inside(line, inside, ",") == then


def test_only_lines_with_a_quote_are_handed_over_to_find_states(spark, tmp_path, small_blocks):
    (tmp_path / "a.csv").write_text("text\n" + "plain\n" * 60 + '"open\n' + "inside\n" * 60 + 'end"\n' + "plain\n" * 60)
    lines = records._numbered_lines(records._lines(spark, str(tmp_path / "a.csv"), None))
    maps = records._block_maps(lines, ",")
    assert 1 <= len(maps) <= 2  # blocks without a quote change nothing and tell nothing
    got = [r["record"] for r in read_records(spark, str(tmp_path / "a.csv")).orderBy("block", "nth").collect()]
    assert got == ["text", *["plain"] * 60, '"open\n' + "inside\n" * 60 + 'end"', *["plain"] * 60]


# --- JSON arrays -------------------------------------------------------------------


def objects(rng, n):
    odd = ["plain", "", "}", "{", "]}", "a}b{c", '"', '\\"}', "\\", "}\\", "é中\n}", ", {"]
    return [{"text": rng.choice(odd) + str(i), "label": rng.choice(odd), "id": f"k{i}", "more": rng.choice([1, None, {"a": [{"b": "}"}, []]}, [[{}], {}], {}])} for i in range(n)]


@pytest.mark.parametrize("indent", [None, 2])
def test_json_blocks_equal_json_module(spark, tmp_path, small_blocks, indent):
    items = objects(random.Random(5), 120)
    (tmp_path / "a.json").write_text(" " + json.dumps(items, indent=indent, ensure_ascii=bool(indent)) + "\n")
    got = read_json_objects(spark, str(tmp_path / "a.json")).orderBy("block", "nth").collect()
    assert [json.loads(r["record"]) for r in got] == items and len({r["block"] for r in got}) > 20


def test_json_samples_equal_those_of_the_plain_reader(spark, tmp_path, small_blocks):
    (tmp_path / "a.json").write_text(json.dumps(objects(random.Random(6), 60) + [{"text": None, "id": "n"}, {"id": "none"}, {"text": "no id"}]))
    (tmp_path / "b.json").write_text("[]")
    (tmp_path / "c.json").write_text("")
    (tmp_path / "d.json").write_text("[ ]\n")
    for id_col in ("id", None):
        both = [read_samples(spark, str(tmp_path), "text", "label", fmt="json" if b else None, id_col=id_col, by_blocks=b) for b in ((True,) if id_col is None else (True, True))]
        plain = read_samples(spark, str(tmp_path / "a.json"), "text", "label", id_col=id_col)
        columns = ["sample_id", "text", "label"] if id_col else ["text", "label"]
        assert sorted(map(str, both[0][0].select(columns).collect())) == sorted(map(str, plain[0].select(columns).collect()))
        assert sorted(r["reason"] for r in both[0][1].collect()) == sorted(r["reason"] for r in plain[1].collect())


def test_broken_arrays(spark, tmp_path, small_blocks):
    (tmp_path / "a.json").write_text('[{"text": "one"}, 5, {"text": "two"}, {"text": "cut off ' + "x" * 300)
    samples, bad = read_samples(spark, str(tmp_path / "a.json"), "text", by_blocks=True)
    assert [r["text"] for r in samples.collect()] == ["one"] and [r["reason"] for r in bad.collect()] == ["not parsable"] * 2
    (tmp_path / "b.json").write_text('{"text": "no list"}')
    with pytest.raises(ValueError, match="list of objects"):
        read_samples(spark, str(tmp_path / "b.json"), "text", by_blocks=True)


@pytest.mark.parametrize("piece, inside, then", [('[{"a": 1', False, (False, 1)), ('"x', False, (True, 0)), ('x"', True, (False, -1)), ("x", True, (True, 0)), ('a\\"b', True, (True, 0)), ('a\\\\"', True, (False, -1)), ('x", "y', True, (True, 0)), ("]", False, (False, -2))])
def test_scan_json(piece, inside, then):
    assert scan_json(piece, inside) == then
