import pytest
from pyspark.sql import Row


@pytest.fixture
def documents(spark):
    """A table of documents from (doc_id, text) pairs, with clashing extra columns."""

    def make(rows):
        schema = "doc_id long, text string, lang string, TEXT_ string, score double, spans string, piece int"
        return spark.createDataFrame(
            [Row(i, t, "en", "x", 0.5, "s", 1) for i, t in rows], schema
        ).withColumnRenamed("TEXT_", "Text")

    return make


ODD = [
    (1, None), (2, ""), (3, " \n\t "), (None, "no id at all"), (4, "one two three four five six"),
    (4, "one two three four five six"), (5, "One  two\nthree four five SIX"), (6, "x" * 200_000),
    (7, "word " * 30_000), (8, "ünï çödé ß İ Σας \x1c   <|endoftext|> it's"),
]


@pytest.fixture
def odd_rows():
    """Null, empty, blank, repeated, very long and unusual rows."""
    return list(ODD)
