import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


@pytest.fixture(scope="session")
def con():
    import duckdb
    c = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.001/{t}.parquet'")
    return c


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows, ties, a clashing extra column."""
    long = "Der lange Text geht weiter. " * 20000
    rows = [(1, None, "en", "a", 0, "x"), (2, "", None, None, None, None), (None, "the cat sat on the mat", "en", "a", 3, "y"),
            (4, long, "de", "b", len(long), "z"), (5, "the cat sat on the mat", "en", "a", 3, "y"),
            (5, "the cat sat on the mat", "en", "a", 3, "y"), (6, "12345 !!! ???", "en", None, 4, None),
            (7, "x", "fr", "a", 1, "w"), (8, " \n\t ", "fr", "a", 1, "w")]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, score string")
