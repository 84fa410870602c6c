"""The corpus pipeline from end to end, each stage against a plain rule on its own input."""

import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from proseframe.llm.simhash import simhash
from proseframe.llm.tokens import tokenizer_path

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """The documents before the first stage and after each of the others."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = [docs.collect()]
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
        out.append(docs.collect())
        docs = spark.createDataFrame(out[-1], docs.schema) if out[-1] else docs
    return out


def by_id(rows):
    return {r["doc_id"]: r for r in rows}


def test_stages_return_documents(spark, stages):
    columns = spark.read.parquet(f"{SMALL}/documents.parquet").columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "quality", "near_duplicates", "decontaminate", "packing"]
    for before, after in zip(stages[:4], stages[1:5]):
        assert after and list(after[0].asDict()) == columns and set(by_id(after)) <= set(by_id(before)) and len(by_id(after)) == len(after)


def test_language_and_quality_keep_rows_as_they_are(stages):
    for before, after in ((stages[0], stages[1]), (stages[1], stages[2])):
        old = by_id(before)
        assert all(r == old[r["doc_id"]] for r in after) and len(after) >= 0.7 * len(before)


def test_one_of_each_group_stays(stages):
    prints = {r["doc_id"]: simhash(r["text"]) % 2**64 for r in stages[2]}
    top = {i: i for i in prints}

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for i, p in prints.items():
        for j, q in prints.items():
            if i < j and (p ^ q).bit_count() <= 3:
                a, b = sorted((find(i), find(j)))
                top[b] = a
    assert sorted(by_id(stages[3])) == sorted({find(i) for i in prints})


def windows(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    return words, [tuple(words[i : i + 10]) for i in range(max(1, len(words) - 9))] if words else []


def test_benchmark_passages_are_cut_out(spark, stages):
    phrases = {w for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect() for w in windows(r["text"])[1]}
    lengths = {len(p) for p in phrases}
    after, changed = by_id(stages[4]), 0
    for r in stages[3]:
        words, _ = windows(r["text"])
        hit = set()
        for n in lengths:
            for i in range(len(words) - n + 1):
                if tuple(words[i : i + n]) in phrases:
                    hit.update(range(i, i + n))
        if words and len(hit) == len(words):
            assert r["doc_id"] not in after
        elif not hit:
            assert after[r["doc_id"]] == r
        else:
            changed += 1
            assert windows(after[r["doc_id"]]["text"])[0] == [w for i, w in enumerate(words) if i not in hit]
            assert after[r["doc_id"]]["n_chars"] == len(after[r["doc_id"]]["text"])
    assert changed


def test_packing_holds_every_id_once(stages):
    library = Tokenizer.from_file(tokenizer_path())
    pieces, lengths = {}, Counter()
    for r in stages[5]:
        pieces.setdefault(r["doc_id"], []).append((r["start"], bytes(r["ids"])))
        lengths[r["sequence_id"]] += r["length"]
        assert r["ids_crc32"] == zlib.crc32(bytes(r["ids"])) and r["length"] == len(r["ids"]) // 4
    assert set(pieces) == set(by_id(stages[4])) and max(lengths.values()) <= 4096
    for r in stages[4]:
        want = b"".join(i.to_bytes(4, "little") for i in [*library.encode(r["text"] or "", add_special_tokens=False).ids, 2])
        assert b"".join(ids for _, ids in sorted(pieces[r["doc_id"]])) == want


def test_run_is_the_stages(spark, stages):
    got = corpus_pipeline.run(spark, SMALL).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    want = Counter()
    for r in stages[5]:
        want[r["doc_id"]] += r["length"]
    assert {r["doc_id"]: r["n"] for r in got} == dict(want)


def test_odd_rows_pass_all_stages(spark, odd):
    docs = odd.select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
        rows = docs.collect()
        docs = spark.createDataFrame(rows, docs.schema)
    empty = odd.select("doc_id", "text", "lang", "source", "n_chars").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SMALL)
        assert empty.count() == 0, name
        empty = spark.createDataFrame([], empty.schema)
