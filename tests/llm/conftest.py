from __future__ import annotations

import pytest

from holdfast.llm.shipping import ship_package


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture
def docs(spark):
    """A function from rows (doc_id, text) to documents with clashing extra columns."""

    def make(rows):
        full = [(i, t, "en", "s", len(t or ""), 1, "x") for i, t in rows]
        names = "doc_id long, text string, lang string, source string, n_chars long, score int, kept string"
        return spark.createDataFrame(full, names)

    return make
