from __future__ import annotations

import duckdb
import pytest

SF = "/root/testdata/sf0.001"

LONG = " ".join(f"word{i % 977}" for i in range(40_000))

# doc_id, text: NULLs, nothing, white space, repeated rows, ties, a very long text, other scripts
EDGE = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "one two three"),
    (4, "one two three"),
    (None, "a row without an id, long enough to have some words in it"),
    (None, None),
    (7, LONG),
    (8, LONG),
    (9, "Größe naïve Straße — 日本語 😀 ½ \u0000 end"),
]


@pytest.fixture(scope="session")
def documents():
    """(doc_id, text, lang) of the smallest table."""
    return duckdb.sql(f"SELECT doc_id, text, lang FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()


@pytest.fixture(scope="session")
def frame(spark):
    """Rows of (doc_id, text) as a frame with clashing extra columns."""

    def make(rows):
        schema = "n_chars string, doc_id long, TEXT string, text string, spans array<int>, lang string, component_id string"
        return spark.createDataFrame([("x", i, "other", t, [1], "en", "c") for i, t in rows], schema)

    return make


@pytest.fixture(scope="session", autouse=True)
def case_sensitive(spark):
    """The frames above hold names that differ in case alone."""
    spark.conf.set("spark.sql.caseSensitive", "true")
    yield
    spark.conf.set("spark.sql.caseSensitive", "false")
