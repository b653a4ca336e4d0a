"""Small tables for the tests; a module, not a conftest, so that the other tests' conftest stays the only one."""

import pytest
from pyspark.sql import functions as F

DATA = "/root/testdata/sf0.001"

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "lorem ipsum dolor sit amet " * 40_000


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], COLUMNS)


@pytest.fixture(scope="session")
def documents(spark):
    """A small table of prose, with copies and junk."""
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet").cache()


@pytest.fixture(scope="session")
def prose(documents):
    return [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def odd(spark):
    """NULLs, empty, blank and very long texts, ties, repeated rows, and columns whose names clash."""
    rows = [
        (1, None, "a"),
        (2, "", "a"),
        (3, " \t\n ", None),
        (4, "one", "b"),
        (5, "one", "b"),
        (5, "one", "b"),
        (6, LONG, "b"),
        (None, "a text without an id stays where it is", "c"),
        (7, "Ünïcödé wörds 漢字 \U0001f600 here", None),
    ]
    df = table(spark, rows)
    clash = ("size", "kept", "word", "node", "key", "whole", "place", "label", "uid", "id", "source_key", "n_words", "target")
    return df.withColumns({c: F.lit("x") for c in clash}).cache()


@pytest.fixture(scope="session")
def empty(odd):
    return odd.where("false")
