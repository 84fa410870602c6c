"""Named queries over the driver's tables, one or more per operator.

Every query reads whole tables. Their SQL twins are in ``oracle``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from proseframe.functions.text import char_count, continuation, strip, word_count
from proseframe.operators import classify, compare, pairs, perplexity, report, splits, text_metrics, training_log
from proseframe.operators.cleaning import clean_samples, cleaning_counts, render_template, resolve_pair_columns
from proseframe.operators.complete import complete, complete_with_fallback, complete_with_ledger, fallback_from_columns
from proseframe.operators.encode import encode_fixed_length, token_counts
from proseframe.operators.ranks import batch_number
from proseframe.plans.evaluate import evaluate_predictions, predictions_for
from proseframe.plans.prepare import prepared_splits
from proseframe.session import shared_dir
from proseframe.sinks import writers
from proseframe.sources.checkpoints import latest_checkpoint_in
from proseframe.sources.datasets import load_named, read_split, resolve_dataset
from proseframe.sources.metric_log import append_metric_log, read_metric_log
from proseframe.sources.prompts import read_prompts
from proseframe.sources.samples import read_samples
from proseframe.sources.synthetic import CHOICES, draw_samples
from proseframe.streaming import jobs, keyed

Query = Callable[[SparkSession, str], DataFrame]

VOCABULARY_IDS = 50_000
ENCODED_LENGTH = 512


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def texts(spark: SparkSession, sf: str, name: str = "documents") -> DataFrame:
    return table(spark, sf, name)


def rounded(df: DataFrame, *names: str) -> DataFrame:
    """Round metric columns: the order of floating sums is not fixed."""
    return df.withColumns({n: F.round(n, 6) for n in names})


def _documents(spark, sf) -> DataFrame:
    """Documents as a sample table; the language serves as the label."""
    return texts(spark, sf).select(F.col("doc_id").alias("sample_id"), "text", F.col("lang").alias("label"))


# --- cleaning and projections ---------------------------------------------


def clean_text_default(spark, sf):
    return clean_samples(_documents(spark, sf))


def clean_text_max200(spark, sf):
    docs = texts(spark, sf).select("doc_id", "text")
    return clean_samples(docs, lowercase=True, min_length=50, max_length=200)


def clean_counts(spark, sf):
    return cleaning_counts(texts(spark, sf), min_length=300)


def word_char_counts(spark, sf):
    docs = texts(spark, sf)
    return docs.select("doc_id", word_count("text").alias("n_words"), char_count("text").alias("n_characters"))


def render_template_query(spark, sf):
    docs = texts(spark, sf)
    return render_template(docs, "Category: {lang}. Description: {text}").select("doc_id", "text")


# --- splits and samples -----------------------------------------------------


def split_hash(spark, sf):
    return splits.split_hash(table(spark, sf, "documents").select("doc_id"), id_col="doc_id")


def split_hash_counts(spark, sf):
    return splits.split_counts(split_hash(spark, sf))


def split_exact(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    return splits.split_exact(docs, 0.7, 0.17, 0.13, id_col="doc_id")


def split_exact_counts(spark, sf):
    return splits.split_counts(split_exact(spark, sf))


def split_exact_large(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey")
    return splits.split_counts(splits.split_exact(orders, id_col="o_orderkey"))


def first_k_per_split(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "source")
    return splits.first_k(splits.split_exact(docs, id_col="doc_id"), 10, order="doc_id")


def sample_exact(spark, sf):
    return splits.sample_exact(table(spark, sf, "documents").select("doc_id", "n_chars"), 250, "doc_id", seed=7)


def sample_exact_string_ids(spark, sf):
    docs = table(spark, sf, "documents").select(F.concat(F.lit("u-"), F.col("doc_id").cast("string")).alias("key"), "n_chars")
    return splits.sample_exact(docs, 300, "key")


def split_exact_repeated_ids(spark, sf):
    """A few users with many rows each: the event tells rows with one id apart."""
    events = table(spark, sf, "events").select("user_id", "event_id")
    return splits.split_exact(events, 0.6, 0.3, 0.1, id_col="user_id", ties=["event_id"])


def batch_numbers(spark, sf):
    return batch_number(table(spark, sf, "documents").select("doc_id"), 8, "doc_id")


def prepared_dataset(spark, sf):
    """Clean and split all documents; counts and lengths per split."""
    return _prepared(spark, sf, None)


def prepared_dataset_limited(spark, sf):
    """The same with the example limit, which is the feature here."""
    return _prepared(spark, sf, 600)


def _prepared(spark, sf, limit):
    data = prepared_splits(_documents(spark, sf), max_examples=limit, clean_options={"min_length": 300})
    return data.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.length("text")).alias("n_characters")
    )


def data_summary(spark, sf):
    data = splits.split_exact(table(spark, sf, "documents"), id_col="doc_id")
    summary = report.data_summary(data, {"input_source": "documents", "processing": {"clean_data": True}})
    return summary.select(
        "input_source", F.col("processing.clean_data").alias("clean_data"), "dataset_sizes.*"
    )


def report_file(spark, sf):
    """The summary as a JSON report, read back."""
    path = shared_dir(spark, "report")
    data = splits.split_exact(table(spark, sf, "documents"), id_col="doc_id")
    writers.write_report(report.data_summary(data, {"input_source": "documents", "processing": {"clean_data": True}}), path)
    return spark.read.json(path).select("input_source", F.col("processing.clean_data").alias("clean_data"), "dataset_sizes.*")


def inspection_files(spark, sf):
    """The first rows of each split as JSON files, read back."""
    path = shared_dir(spark, "inspection")
    docs = table(spark, sf, "documents").select("doc_id", "text", "source")
    writers.write_samples_by_split(report.inspection_samples(splits.split_exact(docs, id_col="doc_id"), order="doc_id"), path)
    return spark.read.schema("doc_id bigint, text string, source string, split string").json(path)


def metric_report(spark, sf):
    """Mean event values as the lines of a text report, read back in their order."""
    path = shared_dir(spark, "metric-report")
    means = table(spark, sf, "events").groupBy(F.col("event_type").alias("metric")).agg(F.avg("value").alias("value"))
    writers.write_report(report.metric_lines(means, "Evaluation", {"Task": "events"}), path, "text")
    lines = spark.read.text(path).withColumn("at", F.monotonically_increasing_id())
    return lines.select((F.row_number().over(Window.orderBy("at")) - 1).cast("bigint").alias("line_no"), F.col("value").alias("line"))


# --- readers and writers: written in a format, read back ---------------------


def _roundtrip(spark, sf, fmt: str) -> DataFrame:
    path = shared_dir(spark, f"samples-{fmt}")
    writers.write_samples(_documents(spark, sf), path, fmt)
    samples, quarantine = read_samples(spark, path, "text", "label", fmt=fmt, id_col="sample_id")
    samples = samples.withColumn("sample_id", F.col("sample_id").cast("bigint"))
    bad = quarantine.select(F.lit(None).cast("bigint").alias("sample_id"), F.col("raw").alias("text"), F.col("reason").alias("label"))
    return samples.unionByName(bad)


def roundtrip_csv(spark, sf):
    return _roundtrip(spark, sf, "csv")


def roundtrip_tsv(spark, sf):
    return _roundtrip(spark, sf, "tsv")


def roundtrip_json(spark, sf):
    return _roundtrip(spark, sf, "json")


def roundtrip_jsonl(spark, sf):
    return _roundtrip(spark, sf, "jsonl")


def _lines(spark, sf) -> DataFrame:
    """A file of good, null, keyless, broken and plain lines, by language."""
    docs = table(spark, sf, "documents")
    return docs.select(
        F.when(F.col("lang") == "en", F.to_json(F.struct("text", F.col("doc_id").alias("id"))))
        .when((F.col("lang") == "fr") & (F.col("n_chars") > 1500), F.lit('{"text": null}'))
        .when(F.col("lang") == "fr", F.lit('{"label": "x"}'))
        .when((F.col("lang") == "de") & (F.col("n_chars") > 1500), F.lit('{"text": "a"} tail'))
        .when(F.col("lang") == "de", F.lit('["text"]'))
        .otherwise(F.lit("no JSON here"))
        .alias("value")
    )


def jsonl_quarantine(spark, sf):
    path = shared_dir(spark, "lines")
    _lines(spark, sf).write.text(path)
    samples, quarantine = read_samples(spark, path, fmt="jsonl")
    both = samples.select(F.lit("ok").alias("reason")).unionByName(quarantine.select("reason"))
    return both.groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows"))


def prompt_lines(spark, sf):
    path = shared_dir(spark, "prompts")
    table(spark, sf, "conversations").select("text").write.text(path)
    return read_prompts(spark, path).groupBy("prompt").agg(F.count(F.lit(1)).alias("n_rows"))


def read_split_present(spark, sf):
    path = shared_dir(spark, "splits")
    writers.write_splits(splits.split_exact(table(spark, sf, "documents").select("doc_id", "text"), id_col="doc_id"), path)
    return read_split(spark, path, "validation")


def read_split_fallback(spark, sf):
    path = shared_dir(spark, "splits")
    data = splits.split_exact(table(spark, sf, "documents").select("doc_id", "text"), 0.5, 0.5, 0.0, id_col="doc_id")
    writers.write_splits(data, path)
    return read_split(spark, path, "dev")


def named_dataset(spark, sf):
    table(spark, sf, "documents").createOrReplaceTempView("named_documents")
    return load_named(spark, "named_documents", label_col="source").select("doc_id", "text", "label", "lang")


def resolved_dataset(spark, sf):
    path = shared_dir(spark, "prepared")
    data = splits.split_exact(table(spark, sf, "documents").select("doc_id", "text", F.col("lang").alias("target")), id_col="doc_id")
    writers.write_splits(data, path)
    return resolve_dataset(spark, path, label_col="target", sample_size=40, id_col="doc_id")


def load_named_path(spark, sf):
    return load_named(spark, f"{sf}/documents.parquet", text_col="text", label_col="lang").select("doc_id", "text", "label")


def suffix_dispatch(spark, sf):
    """Each language in a file of another format, read by its suffix."""
    path, docs, found = shared_dir(spark, "suffixes"), _documents(spark, sf), None
    for lang, fmt in (("en", "csv"), ("fr", "tsv"), ("de", "json"), ("es", "jsonl")):
        writers.write_samples(docs.where(F.col("label") == lang), f"{path}/part.{fmt}", fmt)
        part = read_samples(spark, f"{path}/part.{fmt}", "text", "label", id_col="sample_id")[0]
        found = part if found is None else found.unionByName(part)
    return found.withColumn("sample_id", F.col("sample_id").cast("bigint"))


def json_values(spark, sf):
    """Numbers, booleans and objects where a text or label is expected."""
    docs = table(spark, sf, "documents")
    kind = F.col("doc_id") % 3
    text = F.when(kind == 0, F.col("doc_id").cast("string")).when(kind == 1, F.lit("true")).otherwise(F.concat(F.lit('{"n":'), F.col("n_chars").cast("string"), F.lit("}")))
    lines = docs.select(F.concat(F.lit('{"id": '), F.col("doc_id").cast("string"), F.lit(', "text": '), text, F.lit(', "label": [1, 2.5]}')).alias("value"))
    path = shared_dir(spark, "json-values")
    lines.write.text(path)
    return read_samples(spark, path, "text", "label", fmt="jsonl", id_col="id")[0]


def listing_report(spark, sf):
    """The listing of inference results as a text file, its lines read back."""
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("prompt_id"), F.col("source").alias("prompt"), F.col("lang").alias("output"))
    path = shared_dir(spark, "listing")
    rows = writers.inference_rows(docs)
    writers.write_listing(report.listing_lines(rows), path)
    return spark.read.text(path).where("value <> ''").groupBy(F.col("value").alias("line")).agg(F.count(F.lit(1)).alias("n_lines"))


def directory_scan(spark, sf):
    """A folder with files of two formats: the first format in the fixed order is read, by suffix."""
    path = shared_dir(spark, "folder")
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    docs.write.option("header", True).option("quoteAll", True).option("escape", '"').csv(f"{path}/a")
    docs.write.json(f"{path}/b")
    samples, _ = read_samples(spark, f"{path}/*", "text", "lang", id_col="doc_id")
    return samples.withColumn("sample_id", F.col("sample_id").cast("bigint"))


def synthetic_classification(spark, sf):
    ids = table(spark, sf, "documents").select(F.col("doc_id").alias("sample_id"))
    return draw_samples(ids, "classification")


def synthetic_completion(spark, sf):
    ids = table(spark, sf, "orders").select(F.col("o_orderkey").alias("sample_id"))
    return draw_samples(ids, "completion").groupBy("text", "label").agg(F.count(F.lit(1)).alias("n_rows"))


# --- pairs -------------------------------------------------------------------


def prompt_pairs(spark, sf):
    """A user turn and the assistant turn that follows it."""
    turns = texts(spark, sf, "conversations")
    user = turns.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("reference"))
    answer = turns.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("prediction")
    )
    return user.join(answer, ["conv_id", "turn"])


def pairing_report(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("row_id"))
    marks = table(spark, sf, "labels").select(F.col("doc_id").alias("row_id"))
    return pairs.pairing_report(marks, docs)


def pair_strict(spark, sf):
    docs = table(spark, sf, "documents")
    predictions = docs.select(F.col("doc_id").alias("row_id"), F.col("lang").alias("prediction"))
    return pairs.pair(predictions, docs.select(F.col("doc_id").alias("row_id"), F.col("source").alias("reference")), strict=True)


def continuations(spark, sf):
    both = prompt_pairs(spark, sf)
    return both.select("conv_id", "turn", continuation("reference", "prediction").alias("text"))


def outputs_side_by_side(spark, sf):
    events = table(spark, sf, "events").select(
        F.col("event_id").alias("prompt_id"), F.col("event_type").alias("provider"), F.col("props").alias("output")
    )
    return pairs.side_by_side(events)


def inference_listing(spark, sf):
    """Local outputs for all documents beside remote ones for the labelled documents."""
    docs = texts(spark, sf).select(F.col("doc_id").alias("prompt_id"), F.col("source").alias("prompt"), F.col("text").alias("output"))
    marks = table(spark, sf, "labels").select(
        F.col("doc_id").alias("prompt_id"), F.when(F.col("quality") == 1, F.lit("good text")).otherwise(F.lit("")).alias("output")
    )
    return writers.inference_rows(pairs.beside_local(docs, marks)).select(
        "prompt_id", "input", "local_output_length", "remote_output", "remote_output_length"
    )


# --- text metrics ------------------------------------------------------------


def _altered(spark, sf) -> DataFrame:
    """Documents against copies altered in a way that depends on the language."""
    docs = texts(spark, sf)
    prediction = (
        F.when(F.col("lang") == "en", F.lower("text"))
        .when(F.col("lang") == "fr", F.concat(F.lit("  "), "text", F.lit(" !")))
        .when(F.col("lang") == "de", F.regexp_replace("text", "[.,]", ""))
        .otherwise(F.concat("text", F.lit(" fin")))
    )
    return docs.select(
        F.col("doc_id").alias("row_id"), "lang", F.col("text").alias("reference"), prediction.alias("prediction")
    )


def exact_match(spark, sf):
    return rounded(text_metrics.exact_match(_altered(spark, sf)), "exact_match")


def exact_match_by_lang(spark, sf):
    strict = text_metrics.exact_match(_altered(spark, sf), ignore_case=False, by=["lang"])
    return rounded(strict, "exact_match")


def _rouge(spark, sf, kinds, use_stemmer) -> DataFrame:
    scores = text_metrics.rouge(prompt_pairs(spark, sf), kinds, use_stemmer)
    return rounded(scores, *scores.columns)


def rouge1(spark, sf):
    return _rouge(spark, sf, ["rouge1"], False)


def rouge2(spark, sf):
    return _rouge(spark, sf, ["rouge2"], False)


def rouge_l(spark, sf):
    return _rouge(spark, sf, ["rougeL"], False)


def rouge_stemmed(spark, sf):
    return _rouge(spark, sf, text_metrics.ROUGE_KINDS, True)


def _dropped_words(spark, sf) -> DataFrame:
    docs = texts(spark, sf)
    return docs.select(
        F.col("doc_id").alias("row_id"),
        "lang",
        F.col("text").alias("reference"),
        F.regexp_replace("text", " [a-zA-Z]{2} ", " ").alias("prediction"),
    )


def bleu_corpus(spark, sf):
    return rounded(text_metrics.bleu(_dropped_words(spark, sf)), "bleu")


def bleu_by_lang(spark, sf):
    return rounded(text_metrics.bleu(prompt_pairs(spark, sf).withColumn("first", F.lower(F.substring("reference", 1, 1))), by=["first"]), "bleu")


def bleu_two_references(spark, sf):
    """The assistant turn against the user turn before it and a reversed copy of itself."""
    both = prompt_pairs(spark, sf)
    second = F.array_join(F.reverse(F.split("prediction", " ")), " ")
    return rounded(text_metrics.bleu(both.withColumn("reference", F.array("reference", second))), "bleu")


# --- classification ----------------------------------------------------------


def _graded(spark, sf) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "n_chars", "lang")
    marks = table(spark, sf, "labels")
    both = docs.join(marks, "doc_id")
    reference = F.concat(F.lit("q"), F.col("quality").cast("string"), F.lit("t"), F.col("toxic").cast("string"))
    prediction = (
        F.when(F.col("n_chars") > 3000, "q0t0").when(F.col("n_chars") > 400, "q1t0").when(F.col("n_chars") > 200, "q1t1").otherwise("other")
    )
    return both.select("doc_id", "lang", reference.alias("reference"), prediction.alias("prediction"))


def confusion(spark, sf):
    return classify.confusion(_graded(spark, sf))


def classification_weighted(spark, sf):
    return rounded(classify.classification_report(_graded(spark, sf)), "accuracy", "precision", "recall", "f1")


def classification_by_lang(spark, sf):
    out = classify.classification_report(_graded(spark, sf), by=["lang"])
    return rounded(out, "accuracy", "precision", "recall", "f1")


def classification_per_class(spark, sf):
    out = classify.class_report(_graded(spark, sf)).select("class", "precision", "recall", "f1", "support")
    return rounded(out, "precision", "recall", "f1")


def classification_with_labels(spark, sf):
    out = classify.classification_report(_graded(spark, sf), ["q1t0", "q0t1", "absent"])
    return rounded(out, *out.columns)


def metric_union(spark, sf):
    graded = _graded(spark, sf)

    def exact(pairs_: DataFrame) -> DataFrame:
        return compare.to_long(text_metrics.exact_match(pairs_))

    return rounded(compare.all_metrics(graded, "classification", extra=[exact]), "value")


def all_text_metrics(spark, sf):
    return rounded(compare.all_metrics(prompt_pairs(spark, sf), "generation", use_stemmer=False), "value")


def all_text_metrics_stemmed(spark, sf):
    return rounded(compare.all_metrics(prompt_pairs(spark, sf), "generation"), "value")


# --- perplexity --------------------------------------------------------------


def perplexity_logits(spark, sf):
    vectors = table(spark, sf, "embeddings")
    rows = vectors.select(
        F.col("embedding").alias("logits"), F.when(F.col("label") == 0, -100).otherwise(F.col("label")).alias("label")
    )
    return rounded(perplexity.perplexity_from_logits(rows), "perplexity")


def perplexity_wide_logits(spark, sf):
    """50,048 logits a row, in pieces: each vector again and again."""
    rows = table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("row_id"), F.flatten(F.array_repeat("embedding", 782)).alias("logits"), F.when(F.col("label") == 0, -100).otherwise(F.col("label")).alias("label")
    )
    return rounded(perplexity.perplexity_from_chunks(perplexity.logit_chunks(rows)), "perplexity")


def pair_by_position(spark, sf):
    """Languages in the order of ids beside sources in the order of a hash."""
    docs = table(spark, sf, "documents")
    ordered = docs.select(F.col("lang").alias("prediction"), F.col("source").alias("reference"), "doc_id", F.md5(F.col("doc_id").cast("string")).alias("key"))
    return pairs.pair_by_position(ordered, ordered, "doc_id", ["key", "doc_id"])


def csv_by_blocks(spark, sf):
    """Texts with line breaks in quoted fields, read by blocks."""
    path = shared_dir(spark, "csv-blocks")
    docs = table(spark, sf, "documents").select("doc_id", "lang", F.regexp_replace("text", " ([a-z])", "\n$1").alias("text"))
    docs.write.option("header", True).option("quoteAll", True).option("escape", '"').csv(path)
    samples, _ = read_samples(spark, path, "text", "lang", fmt="csv", id_col="doc_id", by_blocks=True)
    return samples.select(F.col("sample_id").cast("bigint").alias("sample_id"), F.md5(F.replace("text", F.lit("\n"), F.lit(" "))).alias("text_md5"), "label")


def json_by_blocks(spark, sf):
    """One JSON array a task, read by blocks; texts with braces, quotes and line breaks."""
    path = shared_dir(spark, "json-blocks")
    docs = _documents(spark, sf).withColumn("text", F.concat(F.lit('}"\n'), "text", F.lit("{")))
    writers.write_samples(docs, path, "json")
    samples, _ = read_samples(spark, path, "text", "label", fmt="json", id_col="sample_id", by_blocks=True)
    return samples.select(F.col("sample_id").cast("bigint").alias("sample_id"), F.md5("text").alias("text_md5"), "label")


def _losses(spark, sf) -> DataFrame:
    events = table(spark, sf, "events")
    return events.select("event_type", (F.col("value") / 100).alias("loss"), F.col("user_id").alias("n_tokens"))


def perplexity_weighted(spark, sf):
    return rounded(perplexity.perplexity_from_loss(_losses(spark, sf)), "perplexity", "avg_loss")


def perplexity_by_type(spark, sf):
    return rounded(perplexity.perplexity_from_loss(_losses(spark, sf), by=["event_type"]), "perplexity", "avg_loss")


# --- comparison --------------------------------------------------------------


def _metric_values(spark, sf) -> DataFrame:
    """Mean event value per model and metric; one metric is missing from one model."""
    events = table(spark, sf, "events")
    k = F.regexp_extract("props", "[0-9]+", 0).cast("int")
    model = F.when(k < 33, "small").when(k < 66, "medium").otherwise("large")
    metric = (
        F.when(F.col("event_type") == "view", "rouge1_fmeasure")
        .when(F.col("event_type") == "click", "perplexity")
        .when(F.col("event_type") == "error", "accuracy")
        .when(F.col("event_type") == "signup", "total_examples")
        .otherwise("bleu")
    )
    rows = events.select(model.alias("model"), metric.alias("metric"), "value")
    rows = rows.where(~((F.col("model") == "large") & (F.col("metric") == "bleu")))
    return rows.groupBy("model", "metric").agg(F.round(F.avg("value"), 6).alias("value"))


def compare_models(spark, sf):
    return compare.compare_models(_metric_values(spark, sf))


def compare_models_null_value(spark, sf):
    """A model without a value for a metric: the metric isn't common to all."""
    values = _metric_values(spark, sf)
    gone = (F.col("model") == "small") & (F.col("metric") == "accuracy")
    return compare.compare_models(values.withColumn("value", F.when(~gone, F.col("value"))))


def compare_models_strict(spark, sf):
    return compare.compare_models(_metric_values(spark, sf), direction="strict_list")


def _outcomes(spark, sf) -> DataFrame:
    events = table(spark, sf, "events")
    output = F.when(F.col("event_type") == "error", None).when(F.col("event_type") == "signup", "").otherwise(F.col("props"))
    return events.select("event_id", "user_id", "event_type", "props", output.alias("output"))


def success_rate(spark, sf):
    return rounded(compare.success_rate(_outcomes(spark, sf), by=["user_id"]), "success_rate")


def length_table(spark, sf):
    docs = texts(spark, sf).select(F.col("lang").alias("provider"), F.col("text").alias("output"))
    return rounded(compare.length_table(docs), "mean")


def length_comparison(spark, sf):
    both = prompt_pairs(spark, sf).withColumn("prompt_id", F.col("conv_id") * 1000 + F.col("turn"))
    return compare.direct_length_comparison(both, ["prediction", "reference"])


def provider_fallback(spark, sf):
    rows = _outcomes(spark, sf).select(
        "event_id",
        F.col("output").alias("local"),
        F.when(F.col("event_type") == "signup", F.col("props")).alias("remote"),
        F.when(F.col("user_id") > 20, F.lit("spare")).otherwise(F.lit("")).alias("spare"),
    )
    return fallback_from_columns(rows, ["remote", "spare", "local"], prefer="local").select("event_id", "output", "winner")


# --- completion --------------------------------------------------------------


def _capital_a(prompts: list[str]) -> list[str | None]:
    return [p.replace("a", "A") + " " if len(p) > 100 else None for p in prompts]


def _echo_questions(prompts: list[str]) -> list[str]:
    return [p if p.startswith("T") else "" for p in prompts]


def _first_word(prompts: list[str]) -> list[str]:
    return [p.split(" ")[0] for p in prompts]


def _prompts(spark, sf) -> DataFrame:
    return table(spark, sf, "benchmark").select(F.col("item_id").alias("prompt_id"), F.col("text").alias("prompt"))


def batch_complete(spark, sf):
    return complete(_prompts(spark, sf), _capital_a, delay=0)


def complete_fallback(spark, sf):
    providers = [("questions", _echo_questions), ("local", _first_word)]
    return complete_with_fallback(_prompts(spark, sf), providers, delay=0)


def evaluate_completions(spark, sf):
    """Complete, pair and score the documents with a function in place of a model."""
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("sample_id"), F.col("source").alias("text"), F.col("lang").alias("label"))
    scored = predictions_for(docs, _source_language, delay=0, batch_size=256)
    return rounded(evaluate_predictions(scored, "classification"), "value")


def evaluate_by_model(spark, sf):
    """Two models, told apart by the parity of the document, scored separately."""
    docs = table(spark, sf, "documents")
    said = F.when(F.col("source").endswith("9"), None).when(F.col("source").endswith("3"), "fr").otherwise("en")
    model = F.when(F.col("doc_id") % 2 == 0, "even").otherwise("odd")
    rows = docs.select(F.col("doc_id").alias("row_id"), F.col("lang").alias("reference"), said.alias("prediction"), model.alias("model"))
    return rounded(evaluate_predictions(rows, "classification", by=["model"]), "value")


class _EveryOtherCallFails:
    """A service that answers each second call only."""

    def __init__(self):
        self.calls = 0

    def __call__(self, prompts: list[str]) -> list[str]:
        self.calls += 1
        if self.calls % 2:
            raise ConnectionError("busy")
        return [str(len(p)) for p in prompts]


def _no_wait(seconds: float) -> None:
    pass


def retry_attempts(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("prompt_id"), F.col("text").alias("prompt"))
    return complete(docs, _EveryOtherCallFails(), delay=0, batch_size=64, sleep=_no_wait).select("prompt_id", "output", "attempts", "error")


def _tagged(tag: str):
    return lambda prompts: [f"{tag} {hashlib.md5(p.encode()).hexdigest()}" for p in prompts]


def complete_ledger(spark, sf):
    """English documents are asked first, then all of them by another function: it gets only those not answered yet."""
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("prompt_id"), F.col("text").alias("prompt"), "lang")
    path = shared_dir(spark, "ledger")
    settings = {"rate": 20_000.0, "max_parallel": 4, "burst": 4, "batch_size": 64}
    complete_with_ledger(docs.where("lang = 'en'").drop("lang"), _tagged("first"), path, **settings)
    return complete_with_ledger(docs.drop("lang"), _tagged("second"), path, **settings).select("prompt_id", "output", "error")


def complete_paced(spark, sf):
    """Two providers with a wait between calls."""
    providers = [("questions", _echo_questions), ("local", _first_word)]
    return complete_with_fallback(_prompts(spark, sf), providers, delay=0.001, batch_size=64)


def _source_language(prompts: list[str]) -> list[str | None]:
    return [None if p.endswith("9") else ("fr" if p.endswith("3") else "en") for p in prompts]


# --- encoding ----------------------------------------------------------------


def vocabulary(spark, sf) -> DataFrame:
    """The words of all documents with an id from the word's md5."""
    words = table(spark, sf, "documents").select(F.explode(F.split(strip("text"), " ")).alias("token")).distinct()
    number = F.conv(F.substring(F.md5("token"), 1, 7), 16, 10).cast("bigint")
    return words.where(F.col("token") != "").select("token", (number % VOCABULARY_IDS + 2).cast("int").alias("token_id"))


def _encoded(spark, sf, shuffled: bool = False, **options) -> DataFrame:
    docs = texts(spark, sf).select(F.col("doc_id").alias("sample_id"), "text", F.col("source").alias("label"))
    words = vocabulary(spark, sf)
    return encode_fixed_length(docs, words.hint("shuffle_merge") if shuffled else words, max_length=ENCODED_LENGTH, **options)


def encode_fixed(spark, sf):
    joined = [F.array_join(F.col(c).cast("array<string>"), " ").alias(c) for c in ("input_ids", "attention_mask", "labels")]
    return _encoded(spark, sf, padding_side="left").select("sample_id", *joined)


def encode_fixed_joined(spark, sf):
    """The same with a vocabulary that must not be broadcast."""
    joined = [F.array_join(F.col(c).cast("array<string>"), " ").alias(c) for c in ("input_ids", "attention_mask", "labels")]
    return _encoded(spark, sf, padding_side="left", shuffled=True).select("sample_id", *joined)


def encoded_token_counts(spark, sf):
    return token_counts(_encoded(spark, sf)).select("sample_id", "n_tokens")


# --- training logs -----------------------------------------------------------


def metric_log(events: DataFrame) -> DataFrame:
    """Events as a metric log: one run per user, ordered by event id."""
    def only(*types: str):
        return F.when(F.col("event_type").isin(*types), F.col("value"))

    return events.select(
        F.col("user_id").cast("string").alias("run_id"),
        F.col("event_id").alias("log_seq"),
        F.dayofmonth("ts").cast("double").alias("epoch"),
        F.col("event_id").alias("step"),
        only("purchase").alias("train_loss"),
        only("view", "click").alias("eval_loss"),
        F.lit(None).cast("double").alias("eval_perplexity"),
        F.lit(None).cast("double").alias("learning_rate"),
        F.lit(None).cast("double").alias("epoch_time"),
        F.col("value").alias("total_time"),
        F.col("ts"),
    )


def running_best(spark, sf):
    log = metric_log(table(spark, sf, "events"))
    out = training_log.running_best(log)
    return out.select("run_id", "log_seq", "is_best", "best_so_far")


def running_best_highest(spark, sf):
    log = metric_log(table(spark, sf, "events"))
    out = training_log.running_best(log, greater_is_better=True)
    return out.where("is_best").select("run_id", "log_seq", F.col("best_so_far").alias("best"))


def early_stop(spark, sf):
    log = metric_log(table(spark, sf, "events"))
    return training_log.early_stop(log, threshold=0.5)


def last_known_metric(spark, sf):
    log = metric_log(table(spark, sf, "events"))
    return training_log.last_known(log).select("run_id", "log_seq", "last_value")


def elapsed_time(spark, sf):
    log = metric_log(table(spark, sf, "events")).drop("total_time", "epoch_time")
    out = training_log.elapsed(log)
    return rounded(out.select("run_id", "log_seq", "total_time", "epoch_time"), "total_time", "epoch_time")


def training_summary(spark, sf):
    return training_log.training_summary(metric_log(table(spark, sf, "events")))


def metric_log_roundtrip(spark, sf):
    path = shared_dir(spark, "metric-log")
    append_metric_log(metric_log(table(spark, sf, "events")).drop("ts"), path)
    return training_log.training_summary(read_metric_log(spark, path))


def latest_checkpoint(spark, sf):
    orders = table(spark, sf, "orders")
    odd = F.when(F.col("o_orderstatus") == "P", F.lit("checkpoint-last")).otherwise(
        F.concat(F.lit("checkpoint-"), F.col("o_orderkey").cast("string"))
    )
    manifest = orders.select(F.col("o_custkey").cast("string").alias("run_id"), F.concat(F.lit("/runs/"), odd).alias("path"))
    return training_log.latest_checkpoint(manifest)


def latest_checkpoint_folder(spark, sf):
    """The same from folders, one for each supplier, with a file in each."""
    path = shared_dir(spark, "runs")
    name = F.concat(F.lit("run"), "s_nationkey", F.lit("/checkpoint-"), "s_suppkey", F.lit("/state.json"))
    writers.write_files(table(spark, sf, "supplier").select(name.alias("path"), F.lit("{}").alias("text")), path)
    found = latest_checkpoint_in(spark, path)
    return found.select("run_id", F.regexp_extract("path", "/(run[^/]*/[^/]+)$", 1).alias("path"), "step")


# --- streams, run to the end of the table ------------------------------------


def _stream(spark, sf, name: str) -> DataFrame:
    static = table(spark, sf, name)
    # the pattern names the table whether it is one file or a folder of them
    return spark.readStream.schema(static.schema).option("maxFilesPerTrigger", 1).parquet(f"{sf}/{name}.parque[t]")


def stream_clean_split(spark, sf):
    docs = _stream(spark, sf, "documents").select(F.col("doc_id").alias("sample_id"), "text")
    out, checkpoint = shared_dir(spark, "stream-out"), shared_dir(spark, "stream-checkpoint")
    jobs.stream_clean_split(docs, out, checkpoint, once=True).awaitTermination()
    schema = "sample_id bigint, text string, split string"
    return spark.read.schema(schema).parquet(out).select("sample_id", F.md5("text").alias("text_md5"), "split")


def stream_jsonl_quarantine(spark, sf):
    """The lines of ``jsonl_quarantine`` as three micro-batches, each of as many files as the table has partitions for it; counts per reason."""
    path = shared_dir(spark, "stream-lines")
    lines = _lines(spark, sf)
    files = -(-lines.rdd.getNumPartitions() // 3)
    lines.repartition(3 * files).write.text(path)
    out, bad, checkpoint = (shared_dir(spark, f"stream-{p}") for p in ("out", "quarantine", "checkpoint"))
    lines = spark.readStream.option("maxFilesPerTrigger", files).text(path)
    jobs.stream_json_lines(lines, out, bad, checkpoint, "text", "id", once=True).awaitTermination()
    good = spark.read.schema("sample_id string, text string, label string, split string").parquet(out)
    reasons = spark.read.schema("raw string, reason string").parquet(bad).select("reason")
    both = good.select(F.lit("ok").alias("reason")).unionByName(reasons)
    return both.groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows"))


def stream_success_rate(spark, sf):
    rows = _stream(spark, sf, "events").select(
        "user_id", F.when(F.col("event_type") != "error", F.col("event_type")).alias("output")
    )
    ok = F.col("output").isNotNull()
    metrics = [F.count(F.lit(1)).alias("n_prompts"), F.count_if(ok).alias("n_success"), F.avg(ok.cast("double")).alias("success_rate")]
    out, checkpoint = shared_dir(spark, "stream-out"), shared_dir(spark, "stream-checkpoint")
    jobs.stream_metrics(rows, out, checkpoint, metrics, by=["user_id"], once=True).awaitTermination()
    return rounded(jobs.latest_groups(spark, out, ["user_id"]), "success_rate")


def stream_running_best(spark, sf):
    log = metric_log(_stream(spark, sf, "events"))
    out, state, checkpoint = (shared_dir(spark, f"stream-{p}") for p in ("out", "state", "checkpoint"))
    jobs.stream_running_best(log, out, state, checkpoint, threshold=0.5, once=True).awaitTermination()
    rows = spark.read.parquet(out)
    return rows.select("run_id", "log_seq", "is_best", "best_so_far", "strikes", "is_late")


def stream_run_states(spark, sf):
    """The log in four micro-batches, the last one with rows of the first again: they are late."""
    log = metric_log(table(spark, sf, "events")).select("run_id", "log_seq", "eval_loss")
    path, out, checkpoint = (shared_dir(spark, f"stream-{p}") for p in ("log", "out", "checkpoint"))
    first, second, third = log.approxQuantile("log_seq", [0.25, 0.5, 0.75], 0.01)
    seq = F.col("log_seq")
    parts = [seq < first, (seq >= first) & (seq < second), (seq >= second) & (seq < third), (seq >= third) | (seq < 40)]
    files = -(-log.rdd.getNumPartitions() // len(parts))
    for part in parts:  # one after the other, so that the files' times tell their order
        rows = log.where(part)
        rows = rows.coalesce(1) if files == 1 else rows.repartition(files, "log_seq")
        rows.write.mode("append").parquet(path)
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", files).parquet(path)
    keyed.stream_run_states(stream, out, checkpoint, threshold=0.5, once=True).awaitTermination()
    rows = spark.read.parquet(out)
    return rows.select("run_id", "log_seq", "is_best", "best_so_far", "strikes", "is_late")


def stream_success_rate_batches(spark, sf):
    """Running success rates over twenty micro-batches, read from the few tables that are left."""
    rows = table(spark, sf, "events").select("event_id", "user_id", F.when(F.col("event_type") != "error", F.col("event_type")).alias("output"))
    path, out, checkpoint = (shared_dir(spark, f"stream-{p}") for p in ("events", "out", "checkpoint"))
    rows.repartition(20, "event_id").write.parquet(path)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)
    ok = F.col("output").isNotNull()
    metrics = [F.count(F.lit(1)).alias("n_prompts"), F.count_if(ok).alias("n_success"), F.avg(ok.cast("double")).alias("success_rate")]
    jobs.stream_metrics(stream, out, checkpoint, metrics, by=["user_id"], once=True).awaitTermination()
    return rounded(jobs.latest_groups(spark, out, ["user_id"]), "success_rate")


QUERIES: dict[str, Query] = {
    "clean_text_default": clean_text_default,
    "clean_text_max200": clean_text_max200,
    "clean_counts": clean_counts,
    "word_char_counts": word_char_counts,
    "render_template": render_template_query,
    "split_hash": split_hash,
    "split_hash_counts": split_hash_counts,
    "split_exact": split_exact,
    "split_exact_counts": split_exact_counts,
    "split_exact_large": split_exact_large,
    "first_k_per_split": first_k_per_split,
    "sample_exact": sample_exact,
    "sample_exact_string_ids": sample_exact_string_ids,
    "split_exact_repeated_ids": split_exact_repeated_ids,
    "batch_numbers": batch_numbers,
    "prepared_dataset": prepared_dataset,
    "prepared_dataset_limited": prepared_dataset_limited,
    "data_summary": data_summary,
    "report_file": report_file,
    "inspection_files": inspection_files,
    "metric_report": metric_report,
    "roundtrip_csv": roundtrip_csv,
    "roundtrip_tsv": roundtrip_tsv,
    "roundtrip_json": roundtrip_json,
    "roundtrip_jsonl": roundtrip_jsonl,
    "jsonl_quarantine": jsonl_quarantine,
    "prompt_lines": prompt_lines,
    "read_split_present": read_split_present,
    "read_split_fallback": read_split_fallback,
    "named_dataset": named_dataset,
    "load_named_path": load_named_path,
    "directory_scan": directory_scan,
    "suffix_dispatch": suffix_dispatch,
    "json_values": json_values,
    "listing_report": listing_report,
    "resolved_dataset": resolved_dataset,
    "synthetic_classification": synthetic_classification,
    "synthetic_completion": synthetic_completion,
    "prompt_pairs": prompt_pairs,
    "pairing_report": pairing_report,
    "pair_strict": pair_strict,
    "continuations": continuations,
    "outputs_side_by_side": outputs_side_by_side,
    "inference_listing": inference_listing,
    "exact_match": exact_match,
    "exact_match_by_lang": exact_match_by_lang,
    "rouge1": rouge1,
    "rouge2": rouge2,
    "rouge_l": rouge_l,
    "rouge_stemmed": rouge_stemmed,
    "bleu_corpus": bleu_corpus,
    "bleu_by_group": bleu_by_lang,
    "bleu_two_references": bleu_two_references,
    "confusion": confusion,
    "classification_weighted": classification_weighted,
    "classification_by_lang": classification_by_lang,
    "classification_per_class": classification_per_class,
    "classification_with_labels": classification_with_labels,
    "metric_union": metric_union,
    "all_text_metrics": all_text_metrics,
    "all_text_metrics_stemmed": all_text_metrics_stemmed,
    "perplexity_logits": perplexity_logits,
    "perplexity_wide_logits": perplexity_wide_logits,
    "pair_by_position": pair_by_position,
    "csv_by_blocks": csv_by_blocks,
    "json_by_blocks": json_by_blocks,
    "perplexity_weighted": perplexity_weighted,
    "perplexity_by_type": perplexity_by_type,
    "compare_models": compare_models,
    "compare_models_strict": compare_models_strict,
    "compare_models_null_value": compare_models_null_value,
    "success_rate": success_rate,
    "length_table": length_table,
    "length_comparison": length_comparison,
    "provider_fallback": provider_fallback,
    "batch_complete": batch_complete,
    "complete_fallback": complete_fallback,
    "retry_attempts": retry_attempts,
    "complete_ledger": complete_ledger,
    "complete_paced": complete_paced,
    "evaluate_completions": evaluate_completions,
    "evaluate_by_model": evaluate_by_model,
    "encode_fixed_length": encode_fixed,
    "encode_fixed_length_joined": encode_fixed_joined,
    "token_counts": encoded_token_counts,
    "running_best": running_best,
    "running_best_highest": running_best_highest,
    "early_stop": early_stop,
    "last_known_metric": last_known_metric,
    "elapsed_time": elapsed_time,
    "training_summary": training_summary,
    "metric_log_roundtrip": metric_log_roundtrip,
    "latest_checkpoint": latest_checkpoint,
    "latest_checkpoint_folder": latest_checkpoint_folder,
    "stream_clean_split": stream_clean_split,
    "stream_jsonl_quarantine": stream_jsonl_quarantine,
    "stream_success_rate": stream_success_rate,
    "stream_running_best": stream_running_best,
    "stream_run_states": stream_run_states,
    "stream_success_rate_batches": stream_success_rate_batches,
}
