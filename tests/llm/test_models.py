import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from proseframe.llm.gru import HIDDEN, Net, Trainer, log_probabilities, new_net, score_texts, step, window_gradient
from proseframe.llm.language import fit_texts, identify, keep_identified, page_evidence
from proseframe.llm.lm import score_documents, training_texts, vocabulary, word_counts
from proseframe.llm.quality import SIZE, dual_descent, fit, fit_quality, indicators, keep_quality, log_count_ratios, score_column


def test_gradient_is_the_slope():
    rng = np.random.default_rng(0)
    net = Net(*[a.astype(np.float64) for a in new_net(np.full(130, 50), np.full(5, 30))])
    x, y = rng.integers(0, 135, (4, 3)), rng.integers(0, 135, (4, 3))
    h = 0.3 * rng.standard_normal((3, HIDDEN))
    real = np.ones((4, 3))
    gradient = window_gradient(net, x, y, real, h)[0]
    for k, a in enumerate(net):
        for _ in range(5):
            i = (int(x[rng.integers(4), 0]), int(rng.integers(96))) if k == 0 else tuple(int(rng.integers(s)) for s in a.shape)
            loss = []
            for move in (1e-5, -1e-5):
                moved = [b.copy() for b in net]
                moved[k][i] += move
                loss.append(window_gradient(Net(*moved), x, y, real, h)[2])
            assert abs((loss[0] - loss[1]) / 2e-5 - gradient[k][i]) < 1e-5


def test_probabilities_sum_to_one_and_state_is_carried():
    net = new_net(np.arange(130, 0, -1), np.array([5, 7]))
    states = np.random.default_rng(1).standard_normal((1, HIDDEN)).astype(np.float32)
    every = np.arange(132)
    logs = log_probabilities(net, np.repeat(states, 132, axis=0), every)
    assert abs(np.exp(logs).sum() - 1) < 1e-5
    texts = [np.array([5, 131, 3, 0]), np.array([0]), np.random.default_rng(2).integers(0, 132, 700)]
    for text, got in zip(texts, score_texts(net, texts, held=64)):
        h, last, total = np.zeros((1, HIDDEN), dtype=np.float32), 0, 0.0
        for word in text:
            h, _ = step(net, np.array([last]), h)
            total += log_probabilities(net, h, np.array([word]))[0]
            last = int(word)
        assert abs(got - total) < 1e-3 * max(1, abs(total))


def words(text):
    return (text or "").encode().lower().split()


def check_scores(docs, found):
    rows = docs.collect()
    held = lambda i: i is None or zlib.crc32(str(i).encode()) % 10 == 0
    train = [words(r.text) for r in rows if not held(r.doc_id)]
    counts = Counter(w for t in train for w in t)
    if train:
        counts[b""] = len(train)
    n, v = sum(counts.values()), len(counts)
    want = sorted((str(r.doc_id), held(r.doc_id), len(words(r.text)) + 1, sum(w in counts for w in [*words(r.text), b""]), n, round(sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in [*words(r.text), b""]), 4)) for r in rows)
    got = found.collect()
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == want
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    return got


def test_scores(spark, sf, odd, empty):
    check_scores(odd, score_documents(odd))
    check_scores(odd.where("doc_id is null"), score_documents(odd.where("doc_id is null")))
    assert score_documents(empty).count() == 0
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = [r for r in check_scores(docs, score_documents(docs)) if r.held_out]
    assert sum(r.score for r in got) > sum(r.base_score for r in got)


def test_every_word_is_learned_from_in_the_state_it_is_scored_in():
    rng = np.random.default_rng(3)
    net = new_net(np.arange(100, 30, -1), np.array([5.0, 7.0]))
    texts = [np.append(rng.integers(1, 72, n), 0) for n in (0, 1, 15, 16, 17, 40, 2000, 3, 100, 31, 7)]
    for lanes in (1, 3, 64):
        seen, loss = Trainer(net, rate=0.0).learn([texts[:5], [], texts[5:]], lanes)
        assert seen == sum(map(len, texts)) and abs(loss + score_texts(net, texts).sum()) < 1e-3 * loss
    assert Trainer(net).learn([], 4) == (0, 0.0)


def test_training_texts_are_whole(spark, odd):
    vocab = vocabulary(word_counts(odd))
    got = sorted(bytes(r.ids) for r in training_texts(odd, spark.sparkContext.broadcast(vocab)).collect())
    assert got == sorted(vocab.for_net(vocab.read(words(r.text))).astype("<u2").tobytes() for r in odd.collect())
    assert max(map(len, got)) == 2 * 36002


def test_support_vectors():
    seen = np.zeros(SIZE, dtype=bool)
    texts = [f"calm words in line {i}" for i in range(60)] + [f"LOUD!! WORDS!! {i}!!" for i in range(60)]
    rows = [indicators(t, seen) for t in texts]
    labels = np.array([1] * 60 + [0] * 60)
    assert not seen.any() and len(indicators(None, seen)) == len(indicators("", seen)) == 0
    order = np.random.default_rng(0).permutation(120)
    model = fit([rows[i] for i in order], labels[order])
    assert all((model.score(r) >= 0.5) == bool(y) for r, y in zip(rows, labels))
    ratios = log_count_ratios(rows, labels)
    assert ratios[np.setdiff1d(rows[70], rows[3])].mean() < 0 < ratios[np.setdiff1d(rows[3], rows[70])].mean()
    one, two = np.array([0]), np.array([1])
    w, b = dual_descent([one, two], [np.ones(1), np.ones(1)], np.array([1.0, -1.0]), np.array([10.0, 10.0]), rounds=200)
    assert w[0] + b > 0.95 and w[1] + b < -0.95
    assert fit([], np.array([])).score(rows[0]) > 0.9 and fit(rows[:60], labels[:60]).score(rows[0]) > 0.9


def test_quality_held_out(spark, sf, odd, empty):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = fit_quality(docs, labels)
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    got = docs.join(labels, "doc_id").where(held).select("quality", (score_column(model, docs) >= 0.3).cast("int").alias("said")).collect()
    assert len(got) > 30 and np.mean([r.quality == r.said for r in got]) > 0.95
    marks = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (5, None), (99, 0)], "doc_id bigint, quality int")
    for few in (marks, marks.limit(0)):
        assert keep_quality(odd, few).columns == odd.columns
        assert keep_quality(empty, few).count() == 0
    scores = odd.select(score_column(fit_quality(odd, marks), odd).alias("s")).collect()
    assert len(scores) == odd.count() and all(0 <= r.s <= 1 for r in scores)


LANG = {"en": "the house and the garden of the old man were near this river ", "fr": "la maison et le jardin du vieil homme étaient près de cette rivière ", "de": "das haus und der garten des alten mannes waren an diesem fluss "}


@pytest.fixture(scope="module")
def model(spark):
    rows = [(t * 5, k) for k, t in LANG.items()] + [(None, "en"), ("", "fr"), ("some text", None), ("other", "xx")]
    return fit_texts(spark.createDataFrame(rows, "text string, lang string"))


def test_evidence_is_fused(spark, model):
    rows = [(i, LANG[k], "", f"{k}.example.{'com' if k == 'en' else k}") for i, k in enumerate(["en"] * 8 + ["fr"] * 8 + ["de"] * 8)]
    rows += [(100, "an", "fr", "fr.example.fr"), (101, "an", "de", "de.example.de"), (102, "12 !!", "fr", "fr.example.fr"), (103, None, None, None), (104, "qxzw vvkq jjxq", "", "")]
    rows = [(i, t, d or (LANG[k] and k) if i < 100 else d, h) for (i, t, d, h), k in zip(rows, ["en"] * 8 + ["fr"] * 8 + ["de"] * 13)]
    got = {r.i: r for r in identify(spark.createDataFrame(rows, "i int, text string, declared string, host string"), model, declared="declared", host="host").collect()}
    assert len(got) == len(rows)
    assert [got[i].lang for i in (0, 9, 20)] == ["en", "fr", "de"] and got[100].lang == "fr" and got[101].lang == "de"
    assert all(got[i].rejected and got[i].lang == "und" for i in (102, 103)) and got[104].rejected
    pages = spark.createDataFrame([(1, "http://A.example.fr/x", '<html lang="FR"><script>no</script><p>bon&amp;jour</p>'), (2, None, None)], "page_id int, url string, html string")
    first, second = sorted(page_evidence(pages).collect(), key=lambda r: r.page_id)
    assert (first.host, first.declared.lower(), first.text.split()) == ("a.example.fr", "fr", ["bon", "jour"]) and second.host == ""


def test_language_stage(spark, sf, odd, empty, model):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    judged = identify(docs.select("doc_id", "text", "source", F.col("lang").alias("true_lang")), fit_texts(docs), host="source").collect()
    assert np.mean([r.lang == r.true_lang for r in judged]) > 0.99 and not any(r.rejected for r in judged)
    left = keep_identified(odd, model, host="source")
    assert left.columns == odd.columns
    texts = [r.text for r in left.collect()]
    assert "the cat sat on the mat and the dog ran" in texts and "!!! ### ***" not in texts
    assert keep_identified(empty, model, host="source").count() == 0 and fit_texts(empty).logs.shape[1] == 4
