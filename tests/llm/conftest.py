"""Fixtures of the operator tests; the parent conftest gives ``spark``."""

import pytest


@pytest.fixture
def docs_of(spark):
    """Documents from texts, with columns beside the needed ones."""

    def make(texts, first=0, ids=None):
        rows = [(ids[i] if ids else first + i, t, "en", "s", None) for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")

    return make
