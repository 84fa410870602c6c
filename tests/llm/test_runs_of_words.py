"""Periodic runs against a brute-force search, and the grammar against its text."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from proseframe.llm.grammar import repair
from proseframe.llm.queries import looped, op12_runs
from proseframe.llm.runs import batch_runs, longest, run_digest, with_runs


def brute(words, least=24):
    """Every maximal stretch of each period; of equal stretches the smallest period."""
    found = {}
    for q in range(1, len(words) // 3 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, 3 * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e, q) for (s, e), q in found.items())


def random_words(rng):
    letters = rng.choice([1, 2, 2, 3, 5, 30])
    words = [rng.randrange(letters) for _ in range(rng.choice([0, 1, 5, 30, 60, 120]))]
    for _ in range(rng.randint(0, 4)):
        period = [rng.randrange(letters) for _ in range(rng.randint(1, 12))]
        at = rng.randint(0, len(words))
        words[at:at] = (period * rng.randint(2, 14))[: rng.randint(3, 80)]
    return [b"%d" % w for w in words * rng.choice([1, 1, 3])]


@pytest.mark.parametrize("least", [24, 12, 14, 6])
def test_runs_equal_brute_force(least):
    rng = random.Random(least)
    for _ in range(120):
        texts = [random_words(rng) for _ in range(rng.randint(1, 6))]
        assert [[tuple(r) for r in runs.tolist()] for runs in batch_runs(texts, least)] == [brute(t, least) for t in texts]


def test_grammar_derives_its_texts():
    rng = np.random.default_rng(3)
    for letters in (1, 2, 4):
        seq, text = rng.integers(0, letters, 400), np.sort(rng.integers(0, 5, 400))
        g = repair(seq, text)

        def derive(x):
            return [x] if x < g.first else derive(g.left[x - g.first]) + derive(g.right[x - g.first])

        assert [x for root in g.roots for x in derive(root)] == seq.tolist()
        assert [len(derive(r)) for r in g.roots] == g.lengths[g.roots].tolist() == np.bincount(text).tolist()
        assert len(g.left) < len(seq)


def expected(doc_id, text):
    words = looped(doc_id, text.encode().split() if text else [])
    runs = brute(words)
    lines = "".join(f"{s},{e - s},{q}\n" for s, e, q in sorted(runs, key=lambda r: (r[0], r[2])))
    dropped = {i for s, e, q in runs for i in range(s + q, e)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    best = min(runs, key=lambda r: (-(r[1] - r[0]) / r[2], r[0], r[2])) if runs else None
    told = (best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *told, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_query_equals_brute_force(spark):
    small = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{small}/documents.parquet").where("length(text) < 6000").select("doc_id", "text").collect()
    got = {r["doc_id"]: tuple(r) for r in op12_runs(spark, small).collect()}
    assert len(got) == spark.read.parquet(f"{small}/documents.parquet").count()
    assert all(got[r["doc_id"]] == expected(r["doc_id"], r["text"]) for r in docs)
    assert sum(got[r["doc_id"]][1] > 0 for r in docs) >= 5


def test_loops_are_as_stated():
    doc = next(i for i in range(1000) if zlib.crc32(str(i).encode()) % 10 == 0)
    words = [b"%d" % i for i in range(500)]
    g = zlib.crc32(str(doc).encode()) // 10
    a = g % 500
    p = 1 + (500 - a) // (3 + g % 8)
    assert looped(doc, words) == [words[i] if i < a else words[a + (i - a) % p] for i in range(500)]
    assert looped(doc, []) == [] and looped(None, words) == words


def test_odd_rows(spark, odd, empty):
    found = with_runs(odd).select("doc_id", "text", "row", "__runs.*").collect()
    assert len(found) == odd.count()
    for r in found:
        words = (r["text"] or "").encode().split()
        assert r["n_words"] == len(words)
        if len(words) < 2000:
            assert [(x["start"], x["start"] + x["length"], x["period"]) for x in r["runs"]] == brute(words)
        else:  # twelve words, 3000 times
            assert [(x["start"], x["period"]) for x in r["runs"]] == [(0, 12)] and r["collapsed"].startswith("the quick brown fox and the lazy dog of an old town")
    assert with_runs(empty).count() == 0
    with pytest.raises(ValueError, match="__runs"):
        with_runs(odd.withColumn("__runs", F.lit(1)))


def test_longest_compares_exactly(spark):
    big = 3_000_000_000_000_000_000
    runs = [(5, big, 3), (4, big - 1, 3), (9, 3 * 7, 7)]
    df = spark.createDataFrame([(runs,), ([(8, 30, 10), (2, 24, 8)],), ([],)], "runs array<struct<start: bigint, length: bigint, period: bigint>>")
    found = [r[0] and tuple(r[0]) for r in df.select(longest(F.col("runs"))).collect()]
    assert found == [(5, big, 3), (2, 24, 8), None]
    assert df.select(run_digest(F.col("runs"))).collect()[2][0] == hashlib.sha256(b"").hexdigest()
