"""Rows and paths the tests of the operators share."""

from __future__ import annotations

import pytest
from hypothesis import settings
from pyspark.sql import types as T

# Examples share the machine with Spark, so none has a deadline.
settings.register_profile("beside_spark", deadline=None)
settings.load_profile("beside_spark")

SF = "/root/testdata/sf0.001"
DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from rows of (doc_id, text, lang, source); two partitions."""

    def make(rows):
        full = [(d, t, x, s, None if t is None else len(t)) for d, t, x, s in rows]
        return spark.createDataFrame(full, DOCS).repartition(2)

    return make


@pytest.fixture(scope="session")
def sample(spark):
    """The smallest documents table, as a list of rows."""
    return [r.asDict() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


@pytest.fixture(scope="session")
def folder_of(tmp_path_factory):
    """Writes a table of documents as a folder of driver tables; returns its path."""

    def write(df, **tables):
        base = tmp_path_factory.mktemp("sf")
        for name, table in {"documents": df, **tables}.items():
            table.write.parquet(f"{base}/{name}.parquet")
        return str(base)

    return write


def odd_rows():
    """Nulls in every column, empty and blank texts, repeated rows, a long text, ties."""
    return [
        (1, "", "en", "a"),
        (2, None, None, None),
        (3, " \n\t ", "en", "a"),
        (4, "one two", "en", "b"),
        (4, "one two", "en", "b"),
        (5, "one two", "de", None),
        (None, "no id here", "en", "a"),
        (6, "x" * 50_000, None, "b"),
        (7, "lorem ipsum dolor " * 4000, "fr", "c"),
        (8, "日本語の文章です。" * 30, "ja", "c"),
        (9, "naïve \U0001f600 café\r\n\x0b\x0c   end", "fr", "a"),
    ]
