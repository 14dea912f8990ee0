"""Small tables that the tests of the corpus operators share."""

import numpy as np
import pytest

#: Columns besides those of ``documents`` clash with names that operators use themselves.
DOCS = "doc_id long, text string, lang string, source string, n_chars long, word string, n long, h long, at int, rid long, key long, start int"


@pytest.fixture(scope="session")
def documents(spark):
    """Build a table from ``(doc_id, text)`` rows."""
    return lambda rows: spark.createDataFrame([(i, t, "en", "s", 0, "w", 1, 2, 3, 4, 5, 6) for i, t in rows], DOCS)


@pytest.fixture(scope="session")
def prose():
    """Random words, some far more frequent than others, many of them one edit apart."""
    r = np.random.default_rng(3)
    parts = ["an", "er", "ti", "éo", "st", "lo", "ma", "x"]
    known = ["".join(parts[k] for k in r.integers(0, 8, r.integers(2, 5))) for _ in range(600)]

    def text(words: int) -> str:
        return " ".join(known[int(k)] for k in 600 * r.random(words) ** 3)

    return text
