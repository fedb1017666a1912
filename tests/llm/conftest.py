"""Small tables for the operators of ``kessan.llm``. The session is that of ``tests/conftest.py``."""

from __future__ import annotations

import pytest


@pytest.fixture
def docs(spark):
    """A documents table from texts (or full tuples), with a column whose name operators use inside."""

    def make(texts, first=0):
        rows = [
            t if isinstance(t, tuple) else (first + i, t, "en", "src0", len(t) if t is not None else None, "own")
            for i, t in enumerate(texts)
        ]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, key string")

    return make
