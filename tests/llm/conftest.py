import pytest

#: Nulls, empty and very long texts, ties, repeated rows and extra columns with clashing names.
LONG = "Lorem ipsum dolor sit amet consectetur. " * 3000
ROWS = [
    (1, "the quick brown fox jumps over the lazy dog near the river bank today", "en", 1),
    (2, None, "en", 2),
    (3, "", None, 3),
    (4, LONG, "de", 4),
    (5, "the quick brown fox jumps over the lazy dog near the river bank today", "en", 5),
    (6, "  \n\t ", "fr", 6),
    (7, "a b", "en", 7),
    (7, "a b", "en", 7),
    (None, "some text without an id, in a line of its own", "en", 8),
    (9, LONG + "tail", "de", 9),
    (10, "the quick brown fox jumps over the lazy dog near the river bank today", None, None),
]
SCHEMA = "doc_id long, text string, lang string, id long"


@pytest.fixture(scope="session")
def odd(spark):
    """A small table of odd rows; its extra column ``id`` clashes with inner names."""
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
