"""Phrase mining against plain counting."""

import random
import re
from collections import Counter

import pytest

from proseframe.llm.phrases import mine_phrases, phrase_counts, words_and_breaks

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces(text):
    return [w for w in (re.findall("[^ \t]+", p) for p in re.split("[.,;:!?\n-\r]", (text or "").translate(UPPER))) if w]


def model(rows, least, share, top):
    counts, words = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in pieces(text):
            words[lang] += len(piece)
            for k in range(1, 5):
                counts.update((lang, tuple(piece[i : i + k])) for i in range(len(piece) - k + 1))
    found = {key: a for key, a in counts.items() if len(key[1]) > 1 and a >= least}
    inside = Counter()
    for (lang, p), a in found.items():
        for k in range(2, len(p)):
            for i in range(len(p) - k + 1):
                inside[lang, p[i : i + k]] = max(a, inside[lang, p[i : i + k]])
    out = []
    for lang in words:
        ranked = []
        for (own, p), a in found.items():
            if own == lang and not 100 * inside[lang, p] >= share * a:
                cuts = [(2_000_000 * a // (counts[lang, p[:k]] + counts[lang, p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                ranked.append((-score, -a, " ".join(p).encode(), a, counts[lang, p[:k]], counts[lang, p[k:]]))
        for i, (score, _, p, a, left, right) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, i, p.decode(), a, left, right, words[lang], -score))
    return sorted(out)


def random_rows(rng, texts):
    vocabulary = ["The", "the", "of", "a", "é", "中文", "x\x00", "\x1cy", "%", "b b", "end.", "so,", "no!yes", "tab\tbed", "a:b"]
    langs = ["en", "en", "en", None, "und", "", "a b", "a%20b", "a\tb"]
    return [(rng.choice(langs), rng.choice([" ", "  ", "\n", " \t"]).join(rng.choices(vocabulary, k=rng.randint(0, 60)))) for _ in range(texts)]


@pytest.mark.parametrize("partitions", [1, 4, 60])
@pytest.mark.parametrize("least", [2, 5])
def test_equals_plain_counting(spark, partitions, least):
    rows = random_rows(random.Random(partitions + least), 80)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = sorted(map(tuple, mine_phrases(docs, least, 80, 25).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == model(rows, least, 80, 25)


def test_blocks_add_up(spark, monkeypatch):
    import proseframe.llm.phrases as phrases

    rows = random_rows(random.Random(5), 60)
    docs = spark.createDataFrame(rows, "lang string, text string").coalesce(1)
    whole = sorted(map(tuple, phrase_counts(docs, 3).collect()))
    monkeypatch.setattr(phrases, "BLOCK_WORDS", 50)
    assert sorted(map(tuple, phrase_counts(docs, 3).collect())) == whole


def test_exact_beyond_64_bits(spark):
    from proseframe.llm.phrases import with_cuts

    big = 6_000_000_000_000_000_001
    candidates = spark.createDataFrame([("en", "a b", 2, big)], "lang string, phrase string, words int, a bigint")
    counts = spark.createDataFrame([("en", "a", 1, big), ("en", "b", 1, big + 7)], "lang string, phrase string, words int, n bigint")
    row = with_cuts(candidates, counts).collect()[0]
    assert row["score"] == 2_000_000 * big // (2 * big + 7)


def test_odd_rows(spark, odd, empty):
    rows = [(r["lang"], r["text"]) for r in odd.collect()]
    assert sorted(map(tuple, mine_phrases(odd).collect())) == model(rows, 30, 80, 2000)
    assert mine_phrases(empty).count() == 0


def test_words_and_breaks():
    assert words_and_breaks(None) == []
    assert words_and_breaks("A b,C\td\x0be\x1cf") == [b"a", b"b", b".", b"c", b"d", b".", b"e\x1cf"]
