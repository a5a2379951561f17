import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "lorem ipsum dolor " * 20_000


@pytest.fixture
def edges(spark):
    """Nulls in every column, empty, long and repeated texts, repeated rows."""
    rows = [
        (1, "one two three four five six seven", "en", "a", 33),
        (2, "one two three four five six seven", "en", "a", 33),
        (2, "one two three four five six seven", "en", "a", 33),
        (3, "", "en", "b", 0),
        (4, None, None, None, None),
        (None, "words without an id", "de", None, None),
        (5, " \t\n\x0b\x0c\r ", "en", "b", 7),
        (6, LONG, "fr", "c", len(LONG)),
        (7, "naïve 😀   Straße\x00 <|endoftext|>", None, "", 30),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], DOCS)
