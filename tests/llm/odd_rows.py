import pytest


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in any column, empty and long texts, repeated rows, and columns whose names clash with results'."""
    rows = [(0, "One two three four five six seven eight nine ten eleven.\nShared line here", "s"), (1, None, "s"), (2, "", None), (None, "Some words without an id", "t"),
            (3, "long " * 5000 + "tail", "s"), (4, "same text", "t"), (4, "same text", "t"), (5, " \t\n ", "t"), (6, "same text", None), (None, None, None)]
    return spark.createDataFrame([(*r, 1, "x", None, "own text", 7, "own key", "own verdict") for r in rows], "doc_id long, text string, source string, n_words int, tokens string, "
                                 "score double, __text string, __fence int, __simhash_key string, __quality string")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
