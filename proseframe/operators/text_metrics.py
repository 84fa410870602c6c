"""ROUGE, BLEU and exact match as one map step and one partial aggregation.

A row holds both of its texts, so every count that needs both is taken inside
the row. Only a few numbers per group are shuffled, whatever the text volume.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proseframe.functions.paircounts import bleu_counts_udf, rouge_counts_udf
from proseframe.functions.text import normalise_answer
from proseframe.functions.tokens import bleu_line, rouge_line

ROUGE_KINDS = ("rouge1", "rouge2", "rougeL")
BLEU_ORDER = 4


def _prf(overlap: Column, n_pred: Column, n_ref: Column, kind: str) -> list[Column]:
    """Precision, recall and F for one row from its overlap and the lengths in grams."""
    precision = overlap / F.greatest(n_pred, F.lit(1))
    recall = overlap / F.greatest(n_ref, F.lit(1))
    f = F.when(precision + recall > 0, 2 * precision * recall / (precision + recall)).otherwise(F.lit(0.0))
    return [
        precision.alias(f"{kind}_precision"),
        recall.alias(f"{kind}_recall"),
        f.alias(f"{kind}_fmeasure"),
    ]


def _rouge_counts(kinds: Sequence[str], use_stemmer: bool) -> Column:
    unknown = set(kinds) - set(ROUGE_KINDS)
    if unknown:
        raise ValueError(f"unknown ROUGE kinds: {sorted(unknown)}")
    orders = [int(k[-1]) for k in kinds if k != "rougeL"]
    counts = rouge_counts_udf(orders, "rougeL" in kinds, use_stemmer)
    return counts(rouge_line("prediction"), rouge_line("reference"))


def _rouge_scores(counts: Column, kinds: Sequence[str]) -> list[Column]:
    """Scores from the counts; the subsequence length comes after the overlaps."""
    orders = [k for k in kinds if k != "rougeL"]
    n_pred, n_ref = counts[0], counts[1]
    scores: list[Column] = []
    for kind in kinds:
        n = 1 if kind == "rougeL" else int(kind[-1])
        at = 2 + (len(orders) if kind == "rougeL" else orders.index(kind))
        scores += _prf(counts[at], n_pred - (n - 1), n_ref - (n - 1), kind)
    return scores


def _rouge_names(kinds: Sequence[str]) -> list[str]:
    return [f"{k}_{m}" for k in kinds for m in ("precision", "recall", "fmeasure")]


def rouge_rows(pairs: DataFrame, kinds: Sequence[str] = ROUGE_KINDS, use_stemmer: bool = True) -> DataFrame:
    """``pairs`` with per-row scores; a null text gives null scores."""
    df = pairs.withColumn("_rouge", _rouge_counts(kinds, use_stemmer))
    return df.select(*pairs.columns, *_rouge_scores(F.col("_rouge"), kinds))


def rouge(
    pairs: DataFrame, kinds: Sequence[str] = ROUGE_KINDS, use_stemmer: bool = True, by: Sequence[str] = ()
) -> DataFrame:
    """Mean precision, recall and F per kind, one wide row per group."""
    rows = rouge_rows(pairs, kinds, use_stemmer)
    return rows.groupBy(*by).agg(*[F.avg(n).alias(n) for n in _rouge_names(kinds)])


BLEU_STATISTICS = ["sys_len", "ref_len"] + [f"{k}{n}" for n in range(1, BLEU_ORDER + 1) for k in ("match", "total")]


def _bleu_counts(pairs: DataFrame) -> Column:
    is_list = pairs.schema["reference"].dataType.typeName() == "array"
    lines = F.transform("reference", bleu_line) if is_list else F.array(bleu_line("reference"))
    return bleu_counts_udf(BLEU_ORDER)(bleu_line("prediction"), lines)


def _bleu_columns(counts: Column) -> list[Column]:
    stats = [counts[0].alias("sys_len"), counts[1].alias("ref_len")]
    for n in range(1, BLEU_ORDER + 1):
        stats.append(counts[1 + n].alias(f"match{n}"))
        stats.append(F.greatest(counts[0] - (n - 1), F.lit(0)).alias(f"total{n}"))
    return stats


def bleu_statistics(pairs: DataFrame) -> DataFrame:
    """Integer BLEU statistics per row; null where a text is missing.

    ``reference`` may be a string or an array of strings; each gram is clipped
    by its largest count over that row's references.
    """
    return pairs.withColumn("_bleu", _bleu_counts(pairs)).select(*pairs.columns, *_bleu_columns(F.col("_bleu")))


def bleu_score(stats: dict[str, Column]) -> Column:
    """The corpus score from summed statistics, exponential smoothing, 0..100."""
    any_match = sum((stats[f"match{n}"] for n in range(2, BLEU_ORDER + 1)), stats["match1"])
    log_sum, smooth, reached = F.lit(0.0), F.lit(1.0), F.lit(True)
    for n in range(1, BLEU_ORDER + 1):
        match, total = stats[f"match{n}"], stats[f"total{n}"]
        reached = reached & (total > 0)
        smooth = F.when(match == 0, smooth * 2).otherwise(smooth)
        precision = F.when(match == 0, F.try_divide(F.lit(100.0), smooth * total)).otherwise(
            F.try_divide(match * 100.0, total)
        )
        log_sum = log_sum + F.ln(precision)
    sys_len, ref_len = stats["sys_len"], stats["ref_len"]
    brevity = F.when(sys_len < ref_len, F.exp(1 - F.try_divide(ref_len, sys_len))).otherwise(F.lit(1.0))
    score = brevity * F.exp(log_sum / BLEU_ORDER)
    return F.when(reached & (any_match > 0), score).otherwise(F.lit(0.0))


def _bleu_sums() -> list[Column]:
    return [F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in BLEU_STATISTICS]


def bleu(pairs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    sums = bleu_statistics(pairs).groupBy(*by).agg(*_bleu_sums())
    return sums.select(*by, bleu_score({n: F.col(n) for n in BLEU_STATISTICS}).alias("bleu"))


def _same_answer(ignore_case: bool = True, ignore_punctuation: bool = True) -> Column:
    prediction, reference = (normalise_answer(c, ignore_case, ignore_punctuation) for c in ("prediction", "reference"))
    return prediction == reference


def _exact_columns() -> list[Column]:
    share = F.coalesce(F.try_divide(F.col("correct_examples"), F.col("total_examples")), F.lit(0.0))
    return [share.alias("exact_match"), F.col("total_examples"), F.col("correct_examples")]


def exact_match(
    pairs: DataFrame, ignore_case: bool = True, ignore_punctuation: bool = True, by: Sequence[str] = ()
) -> DataFrame:
    same = _same_answer(ignore_case, ignore_punctuation)
    counts = pairs.groupBy(*by).agg(F.count(F.lit(1)).alias("total_examples"), F.count_if(same).alias("correct_examples"))
    return counts.select(*by, *_exact_columns())


def generation_metrics(pairs: DataFrame, by: Sequence[str] = (), use_stemmer: bool = True) -> DataFrame:
    """ROUGE, BLEU and exact match in one pass: one scan, one Python step, one aggregation."""
    counted = pairs.select(
        *by,
        _rouge_counts(ROUGE_KINDS, use_stemmer).alias("_rouge"),
        _bleu_counts(pairs).alias("_bleu"),
        _same_answer().alias("_same"),
    )
    rows = counted.select(*by, "_same", *_rouge_scores(F.col("_rouge"), ROUGE_KINDS), *_bleu_columns(F.col("_bleu")))
    names = _rouge_names(ROUGE_KINDS)
    sums = rows.groupBy(*by).agg(
        *[F.avg(n).alias(n) for n in names],
        *_bleu_sums(),
        F.count(F.lit(1)).alias("total_examples"),
        F.count_if("_same").alias("correct_examples"),
    )
    score = bleu_score({n: F.col(n) for n in BLEU_STATISTICS}).alias("bleu")
    return sums.select(*by, *names, score, *_exact_columns())
