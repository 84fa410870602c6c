import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from proseframe.llm.decontaminate import Phrases, cut_words, hit_words, match_shard, merged, remove_matches, with_matches, words_of
from proseframe.llm.fmindex import FMIndex
from pyspark.sql import functions as F

LONG = "the quick brown fox and the lazy dog of an old town " * 3000

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 4), min_size=1, max_size=80), st.lists(st.lists(st.integers(1, 5), min_size=1, max_size=4), min_size=1, max_size=6))
def test_index_finds_every_place(text, phrases):
    text = np.array([*text, 0], dtype=np.int64)
    rows = np.zeros((len(phrases), 4), dtype=np.int64)
    for i, p in enumerate(phrases):
        rows[i, : len(p)] = p
    index = FMIndex(text, rate=3)
    low, high = index.search(rows, np.array([len(p) for p in phrases]))
    for i, p in enumerate(phrases):
        places = [at for at in range(len(text)) if text[at : at + len(p)].tolist() == p]
        assert sorted(index.locate(np.arange(low[i], high[i])).tolist()) == places


def brute(text, items, window):
    words = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    hit, found = set(), set()
    for name, item in items:
        own = WORD.findall((item or "").translate({c: c + 32 for c in range(65, 91)}))
        size = min(window, len(own))
        for k in range(len(own) - size + 1 if own else 0):
            for at in range(len(words) - size + 1):
                if words[at : at + size] == own[k : k + size]:
                    hit.update(range(at, at + size))
                    found.add(name)
    return len(words), hit, found


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet="abC é-", max_size=40), max_size=6), st.lists(st.text(alphabet="abC é-", max_size=14), max_size=4))
def test_shards_equal_brute_force(texts, items):
    items = [(str(i), t) for i, t in enumerate(items)]
    n_words, spans, found = match_shard(texts, Phrases(items, 3))
    for i, text in enumerate(texts):
        n, hit, names = brute(text, items, 3)
        covered = {w for a, b in zip(spans[i][::2], spans[i][1::2]) for w in range(a, b)}
        assert (n_words[i], covered, {str(x) for x in found[i]}) == (n, hit, names)
        assert spans[i] == merged(spans[i]) and words_of(text) == [w.encode() for w in WORD.findall(text.lower() if text.isascii() else "".join(c.lower() if c.isascii() else c for c in text))]


ITEMS = [(1, "the quick brown fox and the lazy dog of an old town"), (2, "cat sat on the mat"), (3, None), (4, ""), (5, "not in any document at all"), (6, "Cat SAT on the mat!"), (None, "a text without an id")]


def test_query(spark, odd, empty):
    items = spark.createDataFrame([(i, t, 1) for i, t in ITEMS], "item_id bigint, text string, doc_id int")
    for block in (8 << 20, 30):
        found = with_matches(odd, items, block_bytes=block).withColumn("n_hit", hit_words(F.col("__hits.spans"))).collect()
        assert len(found) == odd.count()
        for r in found:
            n, hit, names = brute(r.text, [("null" if i is None else str(i), t) for i, t in ITEMS], 10)
            assert (r["__hits"].n_words, r.n_hit, set(r["__hits"]["items"])) == (n, len(hit), names)
    assert with_matches(empty, items).count() == 0
    nothing = with_matches(odd, items.limit(0)).select(F.sum(F.size("__hits.spans"))).first()[0]
    assert nothing == 0


def test_item_on_two_rows_counts_once(spark, odd):
    items = spark.createDataFrame([(1, "cat sat on the mat"), (1, "the dog ran"), (1, "cat sat on the mat"), (2, "dog ran")], "item_id bigint, text string")
    for block in (8 << 20, 10):
        found = with_matches(odd.where("doc_id = 1"), items, block_bytes=block).collect()
        assert [sorted(r["__hits"]["items"]) for r in found] == [["1", "2"]] * 2


def test_removal(spark, odd, empty):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    left = remove_matches(odd, items)
    assert left.columns == odd.columns
    rows = left.collect()
    kept = {(r.doc_id, r.text) for r in rows}
    assert all(not brute(r.text, ITEMS, 10)[1] for r in rows) and all(r.n_chars == len(r.text or "") for r in rows)
    clean = [(r.doc_id, r.text) for r in odd.collect() if not brute(r.text, ITEMS, 10)[1]]
    assert all(c in kept for c in clean)
    assert not any(r.doc_id == 5 for r in rows)  # nothing but the passage
    assert sum(r.doc_id == 1 for r in rows) == 2 and remove_matches(empty, items).count() == 0
    assert cut_words("Keep, this! cut THIS é? keep", [2, 5]) == "Keep, this! \n? keep"
    assert LONG not in {t for _, t in kept}


def test_one_index_for_each_batch(spark):
    from proseframe.llm.decontaminate import remove_matches

    docs = spark.createDataFrame([(1, "a b c", 5)], "doc_id bigint, text string, n_chars bigint")
    items = spark.createDataFrame([(1, "a b")], "item_id bigint, text string")
    plan = remove_matches(docs, items)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
