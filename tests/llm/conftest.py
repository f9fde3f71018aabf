import pytest

TEXTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, columns with clashing names."""
    long_text = " ".join(f"word{i % 977} of the" for i in range(40_000))
    rows = [
        (1, "Hello World again and again", "en", "a", 5, 1, "x"),
        (2, "hello world again and again", "en", "a", 5, 1, "x"),
        (2, "hello world again and again", "en", "a", 5, 1, "x"),
        (3, None, None, None, None, None, None),
        (4, "", "en", "a", 0, 0, ""),
        (None, "no id here, but text", "fr", "b", 3, 2, "y"),
        (None, None, None, None, None, None, None),
        (5, long_text, "en", "a", len(long_text), 1, "z"),
        (6, long_text, "en", "a", len(long_text), 1, "z"),
        (7, "  12 34 -- !!  ", "de", "a", 3, 1, "z"),
        (8, "Straße ÄÖÜ 😀 über alles ² x", "de", "a", 3, 1, "z"),
        (9, "straße äöü 😀 über alles ² x", "de", "a", 3, 1, "z"),
        (10, "a\tb\nc\r\nd  e   f g h \n i", "es", "a", 3, 1, "z"),
        (11, "\x00 nul \x1f unit \x85 next", "es", "a", 3, 1, "z"),
    ]
    return spark.createDataFrame(rows, TEXTS + ", row long, digest string")


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], TEXTS)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
