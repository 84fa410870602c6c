import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, fp bigint, row string, n int, id string, part int, label int, word string"


def frame(spark, rows):
    """Documents from (doc_id, text, lang, source), with extra columns named like the operators' own."""
    return spark.createDataFrame([(i, t, lang, s, len(t or ""), 7, "r", 3, "x", 5, 9, "w") for i, t, lang, s in rows], DOCS)


LONG = "the quick brown fox and the lazy dog of an old town " * 3000


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty, blank and very long texts, repeated ids and rows, odd characters."""
    rows = [
        (1, "the cat sat on the mat and the dog ran", "en", "a"),
        (1, "the cat sat on the mat and the dog ran", "en", "a"),
        (2, None, None, None),
        (3, "", "en", "a"),
        (4, " \t\n ", "fr", ""),
        (5, LONG, "en", "a"),
        (6, LONG + "end", "en", "b"),
        (7, "été à la plage 中文 \x00 \x1c😀 ΣΑΣ", "fr", "b"),
        (None, "a text without an id", "en", "a"),
        (None, "the cat sat on the mat and the dog ran", "en", "a"),
        (8, "!!! ### ***", "xx", "a"),
        (8, "another text with the same id", "en", "a"),
    ]
    return frame(spark, rows).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return frame(spark, [])


@pytest.fixture
def make(spark):
    return lambda rows: frame(spark, [(*r, "en", "a")[:4] if len(r) == 2 else r for r in rows])
