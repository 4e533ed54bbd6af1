from __future__ import annotations

import pytest

from clickloom.llm.queries import vocabulary

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def tokenizer():
    return vocabulary()


@pytest.fixture(scope="session")
def documents(spark):
    """A function from texts (or (id, text, source) rows) to a documents table."""

    def make(*rows):
        rows = [(i, r, "a") if not isinstance(r, tuple) else r for i, r in enumerate(rows, 1)]
        full = [(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make
