"""Language evidence fused as in a plain model, languages taken from the table, accuracy on rows not learned from."""

import math
import random
from collections import Counter

import numpy as np

from proseframe.llm.language import LANGUAGES, OTHER, OVERLAP, STRENGTH, fit_texts, identify, languages_of

WORDS = {"en": "the and of that with from this have not are", "fr": "les des une dans pour avec est que sur pas", "sw": "ya wa na kwa ni katika hii kama watu siku"}


def corpus(rng, n, langs):
    return [(i, " ".join(rng.choices(WORDS[lang].split(), k=rng.randint(1, 9))), lang) for i, lang in enumerate(rng.choices(langs, k=n))]


def test_languages_come_from_the_table(spark):
    docs = spark.createDataFrame([(None,), ("",), ("und",), ("xx",)] + [("sw",)] * 5 + [("en",)] * 9, "lang string")
    assert languages_of(docs) == ("en", "sw")
    assert languages_of(docs.where("lang = 'xx'")) == ("xx",)
    assert languages_of(docs.limit(0)) == LANGUAGES


def test_accuracy_on_rows_not_learned_from(spark):
    rows = corpus(random.Random(2), 400, list(WORDS))
    docs = spark.createDataFrame(rows, "doc_id int, text string, lang string")
    model = fit_texts(docs.where("doc_id < 300"))
    assert model.languages == ("en", "fr", "sw")
    found = {r["doc_id"]: r["lang"] for r in identify(docs.where("doc_id >= 300").select("doc_id", "text"), model).collect()}
    assert sum(found[i] == lang for i, _, lang in rows[300:]) >= 97


def test_accuracy_on_the_table(spark, sf):
    """Fitted on four fifths of the documents, told on the rest (junk texts are of no language)."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = fit_texts(docs.where("doc_id % 5 <> 0"))
    rest = docs.where("doc_id % 5 = 0 and length(text) > 100")
    said = {r["doc_id"]: (r["lang"], r["rejected"]) for r in identify(rest.select("doc_id", "text"), model).collect()}
    told = [(r["lang"], said[r["doc_id"]][0]) for r in rest.collect() if not said[r["doc_id"]][1]]
    assert len(told) >= 0.9 * len(said) and sum(a == b for a, b in told) >= 0.97 * len(told)


def fused(rows, model):
    """The documented product of evidence, row by row."""
    names = list(model.languages)
    width, info = len(names), []
    for _, text, declared, host in rows:
        n, logs = model.likelihood(text)
        labels = (host or "").split(".")
        info.append((n, logs, (declared or "").strip().lower(), (host or "").lower(), ".".join(labels[-2:]).lower() if len(labels) > 2 else "", labels[-1].lower() if len(labels) > 1 else "", int(np.argmax(logs)) if n else -1))
    guesses = Counter(g for *_, g in info)
    total = sum(guesses[i] for i in range(width))
    overall = [(guesses[i] + 1) / (total + width) for i in range(width)]
    count = lambda at: Counter((x[at], x[6]) for x in info)
    by_declared, by_host, by_domain, by_suffix = count(2), count(3), count(4), count(5)
    out = []
    for n, logs, declared, host, domain, suffix, guess in info:
        scores = []
        for i in range(width):
            parent = overall[i] if not domain else (by_domain[domain, i] + STRENGTH * overall[i]) / (sum(by_domain[domain, j] for j in range(width)) + STRENGTH)
            own, every = by_host[host, i] - (guess == i), sum(by_host[host, j] for j in range(width)) - (guess >= 0)
            score = logs[i] / OVERLAP + math.log((own + STRENGTH * parent) / (every + STRENGTH) if host else overall[i])
            for table, value in ((by_declared, declared), (by_suffix, suffix)):
                if value:
                    share = sum(table[value, j] for j in range(width)) / max(total, 1)
                    score += math.log((table[value, i] + STRENGTH * share + 1e-9) / (guesses[i] + STRENGTH))
            scores.append(score)
        z = np.array([*scores, logs[-1] / OVERLAP + math.log(OTHER)])
        p = np.exp(z - z.max())
        best, p = int(np.argmax(scores)), p[int(np.argmax(scores))] / p.sum()
        out.append(("und" if not n or p < 0.5 else names[best], round(float(p), 9)))
    return out


def test_fusion_equals_a_plain_model(spark):
    rng = random.Random(5)
    model = fit_texts(spark.createDataFrame(corpus(rng, 200, list(WORDS)), "doc_id int, text string, lang string"))
    hosts = [None, "", "a.co", "b.co", "x.site.co", "y.site.co", "www.deep.site.co", "one", "z.fr"]
    rows = [(i, t, rng.choice([None, "en", " FR ", "xx"]), rng.choice(hosts)) for i, t, _ in corpus(rng, 120, list(WORDS))]
    rows += [(500, None, "en", "a.co"), (501, "", None, None), (502, "123 !!", "fr", "z.fr"), (503, "zzzz qqqq jjjj xxxx", None, "a.co")]
    df = spark.createDataFrame(rows, "doc_id int, text string, declared string, host string")
    got = {r["doc_id"]: (r["lang"], round(r["probability"], 9)) for r in identify(df, model, declared="declared", host="host").collect()}
    for row, want in zip(rows, fused(rows, model)):
        assert got[row[0]][0] == want[0] and math.isclose(got[row[0]][1], want[1], abs_tol=1e-6), (row, got[row[0]], want)
