import pytest
from pyspark.sql import types as T

DOCUMENT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that operators use inside must not matter in a table.
        T.StructField("id", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("size", T.StringType()),
        T.StructField("digest", T.StringType()),
        T.StructField("rank", T.StringType()),
        T.StructField("score", T.StringType()),
        T.StructField("_row", T.StringType()),
        T.StructField("_copy", T.StringType()),
    ]
)
PROSE = (
    "once upon a time a small engine read all the lines of a long table and then it wrote them back again "
    "because nobody had told it to stop and so the table grew and grew until the disk was full at last"
)


def documents(spark, rows):
    """Rows of (doc_id, text, source) as a table of documents with further columns."""
    full = [(i, text, "en", source, len(text or ""), "x", "k", "s", "d", "r", None, "o", "c") for i, text, source in rows]
    return spark.createDataFrame(full, DOCUMENT)


@pytest.fixture(scope="session")
def make(spark):
    return lambda rows: documents(spark, rows)


@pytest.fixture(scope="session")
def awkward(make):
    """Nulls everywhere, empty and long texts, ties and rows that repeat whole."""
    return make(
        [
            (1, PROSE, "a"),
            (2, PROSE, "a"),
            (2, PROSE, "a"),
            (3, PROSE + " again", None),
            (4, None, "b"),
            (5, "", None),
            (6, " \t\n ", "b"),
            (None, PROSE, "c"),
            (None, None, None),
            (7, "one two three", "a"),
            (8, (PROSE + " ") * 400, "c"),
            (9, "é€😀 x password = 'abcdefghijkl1234'", "b"),
        ]
    )


@pytest.fixture(scope="session")
def nothing(make):
    return make([])
