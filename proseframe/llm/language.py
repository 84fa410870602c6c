"""Language identification: text likelihoods fused with declared language, address suffix and host priors."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proseframe.llm.batches import small_batches
from proseframe.llm.urlfilter import host_of
from proseframe.session import write_through

#: languages of a table that names none
LANGUAGES = ("de", "en", "es", "fr")
#: documents that a language needs to be learned, unless none has them; languages learned at most (each is half a megabyte of every task)
LEAST, MOST = 5, 300
#: name of a text that fits none of the languages
UNKNOWN = "und"
BUCKETS = 1 << 16
PIECE = 1 << 21
#: trigrams overlap, so each counts as a third of independent evidence
OVERLAP = 3.0
#: prior of "none of the languages", for which all trigrams are equally likely
OTHER = 1e-3
#: rows that a parent's shares count for when a host's, suffix's or declaration's are estimated
STRENGTH = 10.0

_LETTERS = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def _trigrams(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of the trigram around each byte but the first and last, and whether a letter stands in its middle."""
    b = np.frombuffer(data, dtype=np.uint8).astype(np.uint32)
    mixed = (b[:-2] * np.uint32(0x9E3779B1)) ^ (b[1:-1] * np.uint32(0x85EBCA6B)) ^ (b[2:] * np.uint32(0xC2B2AE35))
    mixed ^= mixed >> np.uint32(15)
    return ((mixed * np.uint32(0x27D4EB2F)) >> np.uint32(16)).astype(np.int64), b[1:-1] != 32


def _pieces(text: str | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Trigrams of a whole text, a bounded piece at a time: letters lower-cased, all else a space."""
    data = b" " + (text or "").lower().encode().translate(_LETTERS) + b" "
    for at in range(0, len(data) - 2, PIECE):
        yield _trigrams(data[at : at + PIECE + 2])


class TextModel(NamedTuple):
    """Log probabilities of trigram buckets (one row per bucket, one column per language)."""

    languages: tuple[str, ...]
    logs: np.ndarray

    def likelihood(self, text: str | None) -> tuple[int, np.ndarray]:
        """Trigrams with a letter in the middle, and the log likelihood under each language and under none."""
        n, sums = 0, np.zeros(len(self.languages))
        for buckets, letter in _pieces(text):
            found = np.bincount(buckets[letter], minlength=BUCKETS) if len(buckets) > BUCKETS // 4 else None
            sums += found @ self.logs if found is not None else self.logs[buckets[letter]].sum(axis=0)
            n += int(letter.sum())
        return n, np.append(sums, n * -np.log(BUCKETS))


def languages_of(docs: DataFrame, lang_col: str = "lang") -> tuple[str, ...]:
    """The languages that at least LEAST documents name (else all that are named, else LANGUAGES), by name; more than MOST is an error."""
    named = docs.where(F.col(lang_col).isNotNull() & ~F.col(lang_col).isin("", UNKNOWN)).groupBy(F.col(lang_col).alias("lang")).agg(F.count(F.lit(1)).alias("n"))
    rows = named.orderBy(F.desc("n"), "lang").limit(MOST + 1).collect()
    found = sorted(r["lang"] for r in rows if r["n"] >= LEAST) or sorted(r["lang"] for r in rows)
    if len(found) > MOST:
        raise ValueError(f"more than {MOST} languages: name those to learn")
    return tuple(found) or LANGUAGES


def fit_texts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", languages: tuple[str, ...] | None = None) -> TextModel:
    """Trigram counts of each language over all documents, added up in each task before one grouped sum.

    The languages are those of the table (:func:`languages_of`) unless given.
    What reaches the driver is bounded by buckets times languages. Rows with a
    null or another language teach nothing; a language without rows is smoothed flat.
    """
    small_batches(docs.sparkSession)
    languages = languages or languages_of(docs, lang_col)

    def counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((len(languages), BUCKETS), dtype=np.int64)
        for batch in batches:
            for text, lang in zip(batch["text"], batch["lang"]):
                for buckets, letter in _pieces(text):
                    total[lang] += np.bincount(buckets[letter], minlength=BUCKETS)
        key = np.flatnonzero(total.reshape(-1))
        yield pd.DataFrame({"key": key, "n": total.reshape(-1)[key]})

    number = F.array_position(F.array(*[F.lit(x) for x in languages]), F.col(lang_col)) - 1
    rows = docs.where(F.col(lang_col).isin(*languages)).select(F.col(text_col).alias("text"), number.alias("lang"))
    summed = rows.mapInPandas(counts, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))
    total = np.full((len(languages), BUCKETS), 0.1)
    for row in summed.toLocalIterator():
        total.reshape(-1)[row["key"]] += row["n"]
    return TextModel(languages, np.log(total / total.sum(axis=1, keepdims=True)).T.copy())


def _likelihoods(model: TextModel, rows: DataFrame):
    shared = rows.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("struct<trigrams: bigint, logs: array<double>>")
    def likelihoods(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            found = [shared.value.likelihood(t) for t in texts]
            yield pd.DataFrame({"trigrams": [n for n, _ in found], "logs": [x.tolist() for _, x in found]})

    return likelihoods


def _counts(rows: DataFrame, by: list[str], names: list[str]) -> DataFrame:
    return rows.groupBy(*by).agg(*[F.count(F.when(F.col("guess") == i, 1)).cast("double").alias(n) for i, n in enumerate(names)])


def identify(rows: DataFrame, model: TextModel, text: str = "text", declared: str | None = None, host: str | None = None, least: float = 0.5) -> DataFrame:
    """``rows`` without ``text``, with lang, probability and rejected.

    Posterior = text likelihood x P(declared | language) x P(suffix | language)
    x P(language | host). A first guess from the text alone is counted per
    host, per parent of the host, per suffix and per declaration; a host's
    shares are smoothed with its parent's, those with the overall ones, and a
    row's own guess is taken out of its host's. Texts are read once and never
    shuffled: what is counted and joined are narrow rows, counts are combined
    before the shuffle, and joins on a hot host may be split.

    ``declared`` and ``host`` name columns, or None where there is no such
    evidence; a null or empty value is no evidence either. A text without
    letters, or one that none of the languages explains with probability
    ``least``, gets language "und" and is rejected. No rows give no rows.
    """
    small_batches(rows.sparkSession)
    names = list(model.languages)
    width = len(names)
    kept = [c for c in rows.columns if c != text]

    def given(column):
        return F.coalesce(F.lower(F.trim(F.col(column))), F.lit("")) if column else F.lit("")

    narrow = rows.select(*kept, given(declared).alias("__declared"), given(host).alias("__host"), _likelihoods(model, rows)(F.col(text)).alias("t"))
    narrow = narrow.select(*kept, "__declared", "__host", F.col("t.trigrams").alias("__n"), F.col("t.logs").alias("__logs"))
    labels = F.split("__host", "\\.")
    domain = F.when(F.size(labels) > 2, F.array_join(F.slice(labels, -2, 2), ".")).otherwise(F.lit(""))
    suffix = F.when(F.size(labels) > 1, F.element_at(labels, -1)).otherwise(F.lit(""))
    best = F.array_position("__logs", F.array_max("__logs")) - 1
    guess = F.when(F.col("__n") > 0, best).otherwise(-1)
    narrow = write_through(narrow.withColumns({"__domain": domain, "__suffix": suffix, "guess": guess}), "language-evidence")

    whole = _counts(narrow, [], names).first()
    counts = np.array([whole[n] for n in names])
    total = float(counts.sum())
    overall = (counts + 1) / (total + width)

    domains = _counts(narrow, ["__domain"], [f"d{i}" for i in range(width)])
    hosts = narrow.groupBy("__host", "__domain").agg(*[F.count(F.when(F.col("guess") == i, 1)).cast("double").alias(f"h{i}") for i in range(width)])
    in_domain = sum(F.col(f"d{i}") for i in range(width))
    shares = [F.when(F.col("__domain") == "", F.lit(float(p))).otherwise((F.col(f"d{i}") + STRENGTH * float(p)) / (in_domain + STRENGTH)).alias(f"p{i}") for i, p in enumerate(overall)]
    hosts = hosts.join(domains, "__domain").select("__host", *[f"h{i}" for i in range(width)], *shares)
    hosts = write_through(hosts, "language-hosts")  # so that the join below is free to split a hot host

    def evidence(column: str, prefix: str) -> DataFrame:
        """log P(value | language) for each value, smoothed towards P(value)."""
        table = _counts(narrow.where(F.col(column) != ""), [column], names)
        value = sum(F.col(n) for n in names) / max(total, 1.0)
        return table.select(column, *[F.log((F.col(n) + STRENGTH * value + 1e-9) / (float(c) + STRENGTH)).alias(f"{prefix}{i}") for i, (n, c) in enumerate(zip(names, counts))])

    joined = narrow.join(hosts, "__host", "left").join(evidence("__declared", "e"), "__declared", "left").join(evidence("__suffix", "s"), "__suffix", "left")
    in_host = sum(F.col(f"h{i}") for i in range(width)) - F.when(F.col("guess") >= 0, 1.0).otherwise(0.0)
    scores = []
    for i in range(width):
        own = F.col(f"h{i}") - F.when(F.col("guess") == i, 1.0).otherwise(0.0)
        prior = F.when(F.col("__host") == "", F.lit(float(overall[i]))).otherwise((own + STRENGTH * F.col(f"p{i}")) / (in_host + STRENGTH))
        scores.append(F.get("__logs", F.lit(i)) / OVERLAP + F.log(prior) + F.coalesce(f"e{i}", F.lit(0.0)) + F.coalesce(f"s{i}", F.lit(0.0)))
    none = F.get("__logs", F.lit(width)) / OVERLAP + float(np.log(OTHER))
    top = F.greatest(*scores, none)
    joined = joined.select(*kept, "__n", F.array(*scores).alias("__z"), none.alias("__none"), top.alias("__top"))
    mass = F.aggregate("__z", F.exp(F.col("__none") - F.col("__top")), lambda a, z: a + F.exp(z - F.col("__top")))
    best = F.array_max("__z")
    probability = F.exp(best - F.col("__top")) / mass
    joined = joined.select(*kept, "__n", F.element_at(F.array(*[F.lit(n) for n in names]), F.array_position("__z", best).cast("int")).alias("__best"), probability.alias("probability"))
    rejected = (F.col("__n") == 0) | (F.col("probability") < least)
    return joined.select(*kept, F.when(rejected, UNKNOWN).otherwise(F.col("__best")).alias("lang"), "probability", rejected.alias("rejected"))


def page_evidence(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, text, declared, host) of raw pages: text between tags, the html element's language, the url's host."""
    body = F.regexp_replace(F.col(html), r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
    declared = F.regexp_extract(F.col(html), r"(?i)<html[^>]*?\slang\s*=\s*[\"']?([a-z]{2,3})", 1)
    return pages.select("page_id", F.regexp_replace(body, r"&#?\w+;", " ").alias("text"), declared.alias("declared"), host_of(F.col(url)).alias("host"))


def keep_identified(docs: DataFrame, model: TextModel, id_col: str = "doc_id", text_col: str = "text", host: str | None = None) -> DataFrame:
    """``docs`` without those whose language can't be told.

    Rejected rows are named by id (null counts as an id) and text hash in a
    narrow table that is written first, so that Spark knows its size.
    """
    columns = docs.columns
    keys = docs.select(F.col(id_col).alias("__id"), F.xxhash64(F.col(text_col)).alias("__hash"), F.col(text_col).alias("__text"), *([F.col(host).alias("__source")] if host else []))
    judged = identify(keys, model, "__text", host="__source" if host else None)
    gone = write_through(judged.where("rejected").select("__id", "__hash").distinct(), "language-rejected")
    same = docs[id_col].eqNullSafe(gone["__id"]) & (F.xxhash64(docs[text_col]) == gone["__hash"])
    return docs.join(gone, same, "left_anti").select(*columns)
