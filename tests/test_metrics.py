"""Metrics against hand-computed values and brute-force models."""

import math
import random
import re
from collections import Counter

import pytest
from helpers import rows
from pyspark.sql import functions as F

from proseframe.functions.paircounts import lcs_length
from proseframe.functions.stem import stem
from proseframe.operators import classify, compare, pairs, perplexity, report, text_metrics
from proseframe.plans.evaluate import evaluate_predictions, predictions_for

PAIR = "row_id bigint, prediction string, reference string"


def frame(spark, data):
    return spark.createDataFrame([(i, p, r) for i, (p, r) in enumerate(data)], PAIR)


# --- models --------------------------------------------------------------------


def rouge_tokens(text, stemmed):
    found = [t for t in re.sub(r"[^a-z0-9]+", " ", text.lower()).split()]
    return [stem(t) if stemmed and len(t) > 3 else t for t in found]


def lcs_model(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def rouge_model(p, r, kind, stemmed):
    p, r = rouge_tokens(p, stemmed), rouge_tokens(r, stemmed)
    if kind == "rougeL":
        m, a, b = lcs_model(p, r), len(p), len(r)
    else:
        n = int(kind[-1])
        x, y = (Counter(tuple(t[i : i + n]) for i in range(len(t) - n + 1)) for t in (p, r))
        m, a, b = sum((x & y).values()), sum(x.values()), sum(y.values())
    precision, recall = m / max(a, 1), m / max(b, 1)
    f = 2 * precision * recall / (precision + recall) if precision + recall else 0.0
    return precision, recall, f


def tokens_13a(line):
    line = line.rstrip().replace("<skipped>", "").replace("-\n", "").replace("\n", " ")
    line = line.replace("&quot;", '"').replace("&amp;", "&").replace("&lt;", "<").replace("&gt;", ">")
    line = f" {line} "
    line = re.sub(r"([\{-\~\[-\` -\&\(-\+\:-\@\/])", r" \1 ", line)
    line = re.sub(r"([^0-9])([\.,])", r"\1 \2 ", line)
    line = re.sub(r"([\.,])([^0-9])", r" \1 \2", line)
    line = re.sub(r"([0-9])(-)", r"\1 \2 ", line)
    return line.split()


def bleu_model(data):
    match, total, sys_len, ref_len = [0] * 4, [0] * 4, 0, 0
    for prediction, references in data:
        p, refs = tokens_13a(prediction), [tokens_13a(r) for r in references]
        sys_len += len(p)
        ref_len += min((abs(len(r) - len(p)), len(r)) for r in refs)[1]
        for n in range(1, 5):
            x = Counter(tuple(p[i : i + n]) for i in range(len(p) - n + 1))
            best = Counter()
            for r in refs:
                best |= Counter(tuple(r[i : i + n]) for i in range(len(r) - n + 1))
            match[n - 1] += sum((x & best).values())
            total[n - 1] += max(len(p) - n + 1, 0)
    if not any(match):
        return 0.0
    smooth, logs = 1.0, 0.0
    for m, t in zip(match, total):
        if t == 0:
            return 0.0
        if m == 0:
            smooth *= 2
        logs += math.log(100.0 * m / t if m else 100.0 / (smooth * t))
    bp = math.exp(1 - ref_len / sys_len) if sys_len < ref_len else 1.0
    return bp * math.exp(logs / 4)


def random_pairs(seed, n=60):
    rng = random.Random(seed)
    words = ["the", "running", "runs", "cat", "cats", "a.b", "3,5", "3-4", "été", "x&amp;y", "relational", "-\n", "..", "(q)", "\n"]
    def text():
        return " ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 2, 3, 8, 25])))
    return [(text(), text()) for _ in range(n)]


# --- ROUGE ---------------------------------------------------------------------


@pytest.mark.parametrize("word,expected", [
    ("caresses", "caress"), ("ponies", "poni"), ("ties", "tie"), ("cats", "cat"), ("feed", "feed"), ("agreed", "agre"),
    ("plastered", "plaster"), ("motoring", "motor"), ("sing", "sing"), ("conflated", "conflat"), ("troubled", "troubl"),
    ("sized", "size"), ("hopping", "hop"), ("falling", "fall"), ("hissing", "hiss"), ("filing", "file"), ("happy", "happi"),
    ("enjoy", "enjoy"), ("relational", "relat"), ("conditional", "condit"), ("valenci", "valenc"), ("digitizer", "digit"),
    ("radically", "radic"), ("vietnamization", "vietnam"), ("sensibility", "sensibl"), ("electricity", "electr"),
    ("triplicate", "triplic"), ("hopefulness", "hope"), ("adoption", "adopt"), ("replacement", "replac"), ("bowdlerize", "bowdler"),
    ("probate", "probat"), ("rate", "rate"), ("cease", "ceas"), ("controlling", "control"), ("rolling", "roll"), ("dying", "die"),
    ("skies", "sky"), ("geology", "geolog"), ("cried", "cri"), ("died", "die"), ("spied", "spi"),
])
def test_stems(word, expected):
    assert stem(word) == expected


def test_lcs_against_table():
    rng = random.Random(1)
    for _ in range(200):
        a, b = ([rng.choice("abcd") for _ in range(rng.randint(0, 90))] for _ in range(2))
        assert lcs_length(a, b) == lcs_model(a, b)


@pytest.mark.parametrize("stemmed", [True, False])
def test_rouge_matches_model(spark, stemmed):
    data = random_pairs(5) + [("", ""), ("a", ""), ("", "b")]
    got = text_metrics.rouge_rows(frame(spark, data), use_stemmer=stemmed).orderBy("row_id").collect()
    for row, (p, r) in zip(got, data):
        for kind in text_metrics.ROUGE_KINDS:
            values = tuple(row[f"{kind}_{m}"] for m in ("precision", "recall", "fmeasure"))
            assert values == pytest.approx(rouge_model(p, r, kind, stemmed))


def test_rouge_by_hand_and_by_group(spark):
    data = [("the cat sat on the mat", "the cat is on the mat"), ("b a", "a b")]
    df = frame(spark, data).withColumn("model", F.concat(F.lit("m"), F.col("row_id").cast("string")))
    got = {r["model"]: r for r in text_metrics.rouge(df, by=["model"]).collect()}
    assert got["m0"]["rouge1_fmeasure"] == pytest.approx(5 / 6) and got["m0"]["rouge2_precision"] == pytest.approx(3 / 5)
    assert got["m1"]["rouge1_recall"] == 1.0 and got["m1"]["rouge2_recall"] == 0.0 and got["m1"]["rougeL_recall"] == 0.5
    with pytest.raises(ValueError):
        text_metrics.rouge(df, kinds=["rouge9x"])


# --- BLEU ----------------------------------------------------------------------


def test_bleu_matches_model(spark):
    for seed in (1, 2, 3):
        data = random_pairs(seed)
        got = text_metrics.bleu(frame(spark, data)).first()["bleu"]
        assert got == pytest.approx(bleu_model([(p, [r]) for p, r in data]))


def test_bleu_many_references(spark):
    a, b, c = random_pairs(7), random_pairs(8), random_pairs(9)
    data = [(p, [r, x, y][: 1 + i % 3]) for i, ((p, r), (x, _), (y, _)) in enumerate(zip(a, b, c))]
    df = spark.createDataFrame([(i, p, r) for i, (p, r) in enumerate(data)], "row_id bigint, prediction string, reference array<string>")
    assert text_metrics.bleu(df).first()["bleu"] == pytest.approx(bleu_model(data))


@pytest.mark.parametrize("data,expected", [
    ([("the cat sat on the mat", "the cat sat on the mat")], 100.0),
    ([("a b c", "a b c")], 0.0),  # no 4-grams at all
    ([("x y z w", "a b c d")], 0.0),
    ([("", "a b")], 0.0),
    ([("a b c d x", "a b c d y z")], math.exp(1 - 6 / 5) * 100 * (4 / 5 * 3 / 4 * 2 / 3 * 1 / 2) ** 0.25),
    ([("a b x d e", "a b c d e")], 100 * (4 / 5 * 2 / 4 * 1 / (2 * 3) * 1 / (4 * 2)) ** 0.25),
])
def test_bleu_by_hand(spark, data, expected):
    assert text_metrics.bleu(frame(spark, data)).first()["bleu"] == pytest.approx(expected)


def test_bleu_of_nothing(spark):
    assert text_metrics.bleu(frame(spark, [("a", "b")]).where("row_id < 0")).first()["bleu"] == 0.0


# --- exact match and classification --------------------------------------------


def test_exact_match(spark):
    data = [("Yes!", "yes"), ("a  b", "a b"), (" x ", "x"), ("É", "é"), ("no", "yes")]
    got = text_metrics.exact_match(frame(spark, data)).first()
    assert tuple(got) == (3 / 5, 5, 3)
    assert text_metrics.exact_match(frame(spark, data), ignore_case=False).first()["correct_examples"] == 1
    assert tuple(text_metrics.exact_match(frame(spark, data).where("false")).first()) == (0.0, 0, 0)


def test_classification(spark):
    data = [("a", "a")] * 3 + [("a", "b"), ("b", "b"), ("only_predicted", "a")]
    by_class = {r["class"]: r for r in classify.class_report(frame(spark, data)).collect()}
    assert (by_class["a"]["precision"], by_class["a"]["recall"], by_class["a"]["support"]) == (3 / 4, 3 / 4, 4)
    assert (by_class["only_predicted"]["precision"], by_class["only_predicted"]["recall"]) == (0.0, 0.0)
    got = classify.classification_report(frame(spark, data), ["a", "absent"]).first()
    f_a, f_b = 3 / 4, 2 * 1 * 0.5 / 1.5
    assert got["accuracy"] == pytest.approx(4 / 6) and got["recall"] == pytest.approx(4 / 6)
    assert got["precision"] == pytest.approx((4 * 0.75 + 2 * 1.0) / 6)
    assert got["f1"] == pytest.approx((4 * f_a + 2 * f_b) / 6)
    assert (got["f1_a"], got["f1_absent"]) == (pytest.approx(f_a), 0.0)
    assert sum(r["n"] for r in classify.confusion(frame(spark, data)).collect()) == 6


# --- perplexity -----------------------------------------------------------------


def test_perplexity(spark):
    losses = spark.createDataFrame([(1.0, 3), (2.0, 1), (9.0, 0)], "loss double, n_tokens bigint")
    got = perplexity.perplexity_from_loss(losses).first()
    assert tuple(got) == (pytest.approx(math.exp(1.25)), 1.25, 4)
    assert tuple(perplexity.perplexity_from_loss(losses.where("n_tokens = 0")).first()) == (math.inf, math.inf, 0)
    logits = spark.createDataFrame([([1000.0, 1000.0], 0), ([0.0, math.log(3)], 1), ([5.0, 5.0], -100)], "logits array<double>, label int")
    got = perplexity.perplexity_from_logits(logits).first()
    assert got["perplexity"] == pytest.approx(math.exp((math.log(2) + math.log(4 / 3)) / 2)) and got["n_positions"] == 2
    assert perplexity.perplexity_from_logits(logits.where("label = -100")).first()["perplexity"] == math.inf
    with pytest.raises(Exception, match="label outside"):
        perplexity.perplexity_from_logits(logits.withColumn("label", F.lit(7))).collect()


# --- pairing, comparison, dispatch ------------------------------------------------


def test_pairing(spark):
    p = spark.createDataFrame([(1, "a"), (2, None), (3, "")], "row_id bigint, prediction string")
    r = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "row_id bigint, reference string")
    assert pairs.pair(p, r, strict=True).count() == 3
    assert pairs.with_prediction(pairs.pair(p, r)).count() == 2
    with pytest.raises(Exception, match="without a partner"):
        pairs.pair(p.where("row_id > 1"), r, strict=True).collect()
    twice = p.unionByName(p.where("row_id = 1"))
    got = pairs.pairing_report(twice.where("row_id < 3"), r).first().asDict()
    assert got == {"n_without_reference": 0, "n_without_prediction": 1, "n_repeated": 1, "n_paired": 2}


def test_side_by_side(spark):
    df = spark.createDataFrame([(1, "m", "a"), (1, "n", "b"), (2, "m", "c")], "prompt_id bigint, provider string, output string")
    assert rows(pairs.side_by_side(df, ["m", "n"]).fillna("-")) == [(1, "a", "b"), (2, "c", "-")]
    local = df.where("provider = 'm'").select("prompt_id", "output")
    assert rows(pairs.beside_local(local, df.where("provider = 'n'")).fillna("-")) == [(1, "a", "b"), (2, "c", "-")]


def test_compare_models(spark):
    data = [
        ("b", "bleu", 3.0), ("a", "bleu", 3.0), ("c", "bleu", 1.0), ("a", "perplexity", 5.0), ("b", "perplexity", 2.0),
        ("c", "perplexity", 5.0), ("a", "rouge1_fmeasure", 0.1), ("b", "rouge1_fmeasure", 0.2), ("c", "rouge1_fmeasure", 0.3),
        ("a", "f1", 1.0), ("b", "f1", 2.0), ("a", "total_examples", 1.0), ("b", "total_examples", 2.0), ("c", "total_examples", 3.0),
    ]
    values = spark.createDataFrame(data, "model string, metric string, value double")
    got = {r["metric"]: (r["best_model"], r["worst_model"]) for r in compare.compare_models(values).collect()}
    assert got == {"bleu": ("a", "c"), "perplexity": ("b", "a"), "rouge1_fmeasure": ("c", "a")}
    strict = {r["metric"]: r["best_model"] for r in compare.compare_models(values, "strict_list").collect()}
    assert strict == {"bleu": "a", "perplexity": "b", "rouge1_fmeasure": "a", "total_examples": "a"}
    rule = spark.createDataFrame([("perplexity", True)], "metric string, higher boolean")
    turned = {r["metric"]: r["best_model"] for r in compare.compare_models(values, directions=rule).collect()}
    assert turned["perplexity"] == "a" and turned["bleu"] == "a"
    given = values.withColumn("rank", F.when(F.col("model") == "b", 0).otherwise(1))
    assert {r["metric"]: r["best_model"] for r in compare.compare_models(given, order_col="rank").collect()}["bleu"] == "b"
    with pytest.raises(Exception, match="at least 2 models"):
        compare.compare_models(values.where("model = 'a'")).collect()
    doc = {r["metric"]: r["values"] for r in report.comparison_report(compare.compare_models(values), values).collect()}
    assert doc["bleu"] == {"a": 3.0, "b": 3.0, "c": 1.0}


def test_all_metrics(spark):
    df = frame(spark, [("yes", "yes"), ("no", "yes")])
    names = {r["metric"] for r in compare.all_metrics(df, "summarization").collect()}
    assert names == {f"{k}_{m}" for k in text_metrics.ROUGE_KINDS for m in ("precision", "recall", "fmeasure")} | {
        "bleu", "exact_match", "total_examples", "correct_examples"}
    assert {r["metric"] for r in compare.all_metrics(df, "classification", ["yes"]).collect()} >= {"accuracy", "f1_yes"}
    with pytest.raises(ValueError):
        compare.all_metrics(df, "translation")


def test_success_rate_and_lengths(spark):
    df = spark.createDataFrame([("m", "a b"), ("m", None), ("n", "[Generation failed]"), ("n", "é")], "provider string, output string")
    assert tuple(compare.success_rate(df).first()) == (4, 3, 0.75)
    assert compare.success_rate(df, failed_text="[Generation failed]").first()["success_rate"] == 0.5
    assert compare.success_rate(df.where("false")).first()["success_rate"] is None
    assert rows(compare.length_table(df))[:2] == [("m", "Character Count", 3, 3.0), ("m", "Word Count", 2, 2.0)]
    both = spark.createDataFrame([(1, "a b", "ccc")], "prompt_id bigint, x string, y string")
    assert rows(compare.direct_length_comparison(both, ["x", "y"])) == [(1, "Character Count", 3, 3), (1, "Word Count", 2, 1)]


def test_evaluate_end_to_end(spark, tmp_path):
    data = spark.createDataFrame([(i, f"q{i}", "a" if i % 2 else "b") for i in range(20)], "sample_id bigint, text string, label string")
    scored = predictions_for(data, lambda prompts: ["a" if p != "q3" else None for p in prompts], delay=0, batch_size=1)
    losses = spark.createDataFrame([(1.0, 2)], "loss double, n_tokens bigint")
    got = dict(rows(evaluate_predictions(scored, "classification", losses=losses, out=str(tmp_path / "r"))))
    assert got["accuracy"] == pytest.approx(9 / 19) and got["success_rate"] == 0.95 and got["perplexity"] == pytest.approx(math.e)
    doc = spark.read.json(str(tmp_path / "r")).first()
    assert doc["num_samples"] == 19 and len(doc["sample_predictions"]) == 10 and doc["metrics"]["accuracy"] == pytest.approx(9 / 19)


# --- wide logits, pairing by position ------------------------------------------------


@pytest.mark.parametrize("width", [1, 3, 7, 100])
def test_perplexity_from_chunks(spark, width):
    rng = random.Random(width)
    data = [(i, [rng.uniform(-800, 800) for _ in range(10)], rng.choice([-100, rng.randrange(10)])) for i in range(30)]
    df = spark.createDataFrame(data, "row_id int, logits array<double>, label int")
    got = perplexity.perplexity_from_chunks(perplexity.logit_chunks(df, width=width).repartition(4)).first()
    want = perplexity.perplexity_from_logits(df).first()
    assert got["n_positions"] == want["n_positions"] and math.isclose(math.log(got["perplexity"]), math.log(want["perplexity"]), rel_tol=1e-12)
    with pytest.raises(Exception, match="outside"):
        perplexity.perplexity_from_chunks(perplexity.logit_chunks(spark.createDataFrame([(1, [0.5], 4)], df.schema))).collect()
    none = perplexity.perplexity_from_chunks(perplexity.logit_chunks(df.where("label = -100"))).first()
    assert tuple(none) == (math.inf, 0)


def test_pair_by_position(spark):
    left = spark.createDataFrame([(i * 7 % 50, f"p{i * 7 % 50}") for i in range(50)], "n int, prediction string").repartition(5)
    right = spark.createDataFrame([(-i, f"r{i}") for i in range(50)], "m int, reference string").repartition(3)
    assert rows(pairs.pair_by_position(left, right, "n", "m")) == [(i, f"p{i}", f"r{49 - i}") for i in range(50)]
    with pytest.raises(Exception, match="as many predictions"):
        pairs.pair_by_position(left, right.where("m < 0"), "n", "m").collect()
    assert pairs.pair_by_position(left.limit(0), right.limit(0), "n", "m").count() == 0


@pytest.mark.parametrize("together", [1, 40, 10**6])
def test_overlaps_equal_counters(monkeypatch, together):
    from proseframe.functions import paircounts

    monkeypatch.setattr(paircounts, "TOKENS", together)
    rng = random.Random(together)
    text = lambda: rng.choices("abcde", k=rng.choice([0, 1, 3, 20]))
    predictions, references = [text() for _ in range(60)], [[text() for _ in range(rng.randint(0, 3))] for _ in range(60)]
    grams = lambda t, n: Counter(tuple(t[i : i + n]) for i in range(len(t) - n + 1))
    for i, row in enumerate(paircounts.clipped_overlaps(predictions, references, 4).tolist()):
        for n in range(1, 5):
            best = Counter()
            for r in references[i]:
                best |= grams(r, n)
            assert row[n - 1] == sum((grams(predictions[i], n) & best).values())
    assert paircounts.clipped_overlaps([], [], 2).shape == (0, 2)


def test_only_some_rows_of_a_batch_are_tokens_at_once(spark, monkeypatch):
    """Whatever the batch, a worker holds about CHARS characters of it as tokens; results do not depend on the cuts."""
    import pyarrow as pa

    from proseframe.functions import paircounts

    held = []
    plain = paircounts.clipped_overlaps
    monkeypatch.setattr(paircounts, "clipped_overlaps", lambda p, r, n: held.append(sum(map(len, p))) or plain(p, r, n))
    lines = pa.array(["one two three", None, "four", "", "five six " * 50] * 40)[1:]
    listed = pa.array([None if x is None else [x, None, "one five"] for x in lines.to_pylist()], type=pa.list_(pa.string()))[3:]
    rouge, bleu = (f.func for f in (paircounts.rouge_counts_udf([1, 2], True, True), paircounts.bleu_counts_udf(4)))
    found = []
    for chars in (10, 2000, 10**9):
        monkeypatch.setattr(paircounts, "CHARS", chars)
        held.clear()
        found.append((rouge(lines, lines).to_pylist(), bleu(lines[3:], listed).to_pylist(), max(held)))
    assert found[0][:2] == found[1][:2] == found[2][:2] and len(found[0][0]) == 199 and len(found[0][1]) == 196
    assert found[0][2] == 100 and found[1][2] < 300 and found[2][2] > 3000
    assert found[0][0][3] == [100, 100, 100, 99, 100] and found[0][0][0] is None and found[0][1][1][:2] == [3, 3]
