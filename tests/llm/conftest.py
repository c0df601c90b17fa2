from __future__ import annotations

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Rows as documents; n_chars follows the text."""

    def make(texts, langs=None, ids=None):
        rows = [
            (i if ids is None else ids[i], t, langs[i] if langs else "en", "s", None if t is None else len(t))
            for i, t in enumerate(texts)
        ]
        return spark.createDataFrame(rows, SCHEMA)

    return make


@pytest.fixture
def odd(spark):
    """Nulls in every column, empty and blank texts, a long text, repeated rows, and columns with clashing names."""
    long = "palabra larga " * 40_000
    rows = [
        (1, "", "en", "s", 0), (2, None, None, None, None), (None, "the cat sat on the mat", "en", None, 22),
        (3, "the cat sat on the mat", None, "s", None), (3, "the cat sat on the mat", None, "s", None), (4, " \n\t ", "en", "s", 4),
        (5, long, "es", "s", len(long)), (6, "12345 --- !!!", "en", "s", 13), (7, "x", "en", "s", 1),
    ]
    names = "node long, component string, n long, row string, score string, kept string, ids string, matches string, secrets string"
    extra = [(i, "c", 5, "r", "q", "k", "i", "m", "x") for i in range(len(rows))]
    return spark.createDataFrame([a + b for a, b in zip(rows, extra, strict=True)], f"{SCHEMA}, {names}")
