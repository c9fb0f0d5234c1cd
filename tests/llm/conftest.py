from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

LONG = " ".join(f"w{i % 997}" for i in range(20_000))


@pytest.fixture(scope="module")
def odd_docs(spark):
    """Nulls in every column, empty and blank texts, a very long one, repeated rows, and clashing columns."""
    rows = [
        (1, None, None, None, None), (2, "", "en", "s", 0), (3, " \t\n ", None, "s", 4), (4, LONG, "en", None, len(LONG)),
        (5, "one two", "en", "s", 7), (5, "one two", "en", "s", 7), (None, "one two", "en", "s", 7), (None, None, None, None, None),
        (6, "A shared line of text\nown line six\nA shared line of text", "en", "s", 1),
        (7, "  a SHARED line of text \nown line seven", "en", "s", 1), (8, "é日本 😀 x@y.zz 4111 1111 1111 1111", "en", "s", 1),
    ]
    clash = ("key", "n", "pos", "h1", "fp", "kept", "spans", "score", "node", "row", "ids", "_hash", "n_lines")
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    return df.selectExpr("*", *[f"'x' AS `{c}`" for c in clash])


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
