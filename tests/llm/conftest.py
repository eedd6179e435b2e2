import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, ids string, mix string, quality string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in any column, empty and blank texts, a long word, repeated rows, and columns named like results."""
    long = "word " * 30_000
    rows = [
        (1, "a b c d e f g h mail x.y@mail.example.com end " * 9, "en", "s0", 1, "i", "m", "q"),
        (2, None, "en", "s0", None, None, None, None),
        (3, "", None, None, 0, "i", "m", "q"),
        (4, " \n\t ", "en", "s1", 4, "i", "m", "q"),
        (5, "a b c d e f g h mail x.y@mail.example.com end " * 9, "en", None, 1, "i", "m", "q"),
        (5, "a b c d e f g h mail x.y@mail.example.com end " * 9, "en", None, 1, "i", "m", "q"),
        (None, "a b c d e f g h mail x.y@mail.example.com end " * 9, "fr", "s1", 1, "i", "m", "q"),
        (7, long, "de", "s2", 1, "i", "m", "q"),
        (8, "x" * 3000, "de", "s2", 1, "i", "m", "q"),
        (9, "日本語 🙂 ünïcode text", "ja", "s2", 1, "i", "m", "q"),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
