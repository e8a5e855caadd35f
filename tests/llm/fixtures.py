from __future__ import annotations

import pytest

LONG = " ".join(f"word{i % 977} other{i % 31}" for i in range(60_000))


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls in every column, empty and very long texts, repeated rows, a repeated id, columns that clash with working names."""
    rows = [
        (1, None, "en", "a", None), (2, "", "de", None, 0), (3, LONG, "en", "a", len(LONG)), (4, "the same words in two rows here", None, "a", 31),
        (4, "the same words in two rows here", None, "a", 31), (5, "the same words in two rows here", "en", "a", 31),
        (6, "an id that repeats", "en", "b", 18), (6, "with another text", "en", "b", 17),
        (None, "no id but a text of some words", "en", "b", 30), (None, None, None, None, None), (7, " \t\n ", "fr", "b", 4), (8, "?!.", "fr", "b", 3),
    ]
    clash = [(*r, "x", 1, 2.5, "y", True) for r in rows]
    return spark.createDataFrame(
        clash, "doc_id long, text string, lang string, source string, n_chars long, key string, n long, score double, language string, kept boolean")


@pytest.fixture(scope="session")
def empty(edge):
    return edge.limit(0)


@pytest.fixture
def docs_of(spark):
    return lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
