from __future__ import annotations

import pytest

ROWS = [
    (1, "alpha beta gamma", "en", "s0", 16), (2, None, None, None, None), (3, "", "en", "s1", 0), (4, "alpha  beta\tgamma", "en", "s0", 17), (5, "alpha beta gamma", "en", "s0", 16),
    (5, "alpha beta gamma", "en", "s0", 16), (6, "x" * 300_000, "de", "s1", 300_000), (None, "token = abcdef123", "de", None, 17), (7, "\n\n \n", None, "s1", 4),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls everywhere, empty and very long texts, ties, repeated rows and ids."""
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
