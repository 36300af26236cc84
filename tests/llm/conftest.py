"""Tables for the tests of the corpus operators."""

from __future__ import annotations

import pytest

from brute import SF_DIR


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (id, text) or (id, text, lang, source), with columns of clashing names."""

    def build(rows):
        full = [(*row, *("en", "src0")[len(row) - 2 :]) for row in rows]
        schema = (
            "doc_id long, text string, lang string, source string, n_chars long, "
            "`key` string, `set` int, trusted string, kept string, `_row` int, component string"
        )
        return spark.createDataFrame(
            [(*r, len(r[1] or ""), "k", 1, "t", "x", 7, "c") for r in full], schema
        )

    return build
