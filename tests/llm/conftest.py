from __future__ import annotations

import pytest

from billmill.llm.ship import ship

BOUNDARY_TEXTS = [None, "", " ", "\n\t", "x", "the the the", "É é ß 日本 😀", "a" * 3000, "word " * 4000]


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="session")
def boundary(spark):
    """Nulls, ties, repeated rows, long texts, and extra columns with names that the operators use."""
    rows = list(enumerate(BOUNDARY_TEXTS)) + [(None, "no id"), (None, None), (4, "x"), (4, "another text")]
    schema = "doc_id long, text string, n long, words string, spans string, bucket int, source string"
    return spark.createDataFrame([(i, t, 7, "w", None, 1, None) for i, t in rows], schema)


@pytest.fixture
def folder(tmp_path):
    """Writes tables below a new folder and returns its path."""

    def write(**tables):
        for name, df in tables.items():
            df.write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write
