import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, term string, h long, n int, row string, word string, copies long"


def documents(spark, rows):
    """Documents with columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, lang, source, len(t or ""), 0.5, "x", 7, 1, "r", "w", 2) for i, t, lang, source in rows], SCHEMA)


LONG = "Lang über " * 30_000


@pytest.fixture(scope="session")
def odd(spark):
    """Null ids and texts, an empty one, white space, a very long one, repeated rows, odd bytes."""
    rows = [
        (0, "The cat sat on the mat and looked at the dog for a while", "en", "a"),
        (1, None, "en", "a"),
        (2, "", "de", None),
        (3, " \t\n ", None, "b"),
        (4, "word", "en", "a"),
        (5, LONG, "de", "b"),
        (6, "The cat sat on the mat and looked at the dog for a while", None, None),
        (6, "The cat sat on the mat and looked at the dog for a while", None, None),
        (7, "Ünïcode \U0001f600 wörds here 1234 | $$$ !!", "de", "c"),
        (None, "no id at all", "en", "a"),
        (None, None, None, None),
        (8, "1d10t", "en", "a"),
        (8, "another text under one id", "en", "b"),
    ]
    return documents(spark, rows)


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def make(spark):
    return lambda rows: documents(spark, rows)
