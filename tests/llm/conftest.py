from __future__ import annotations

import duckdb
import pytest

SF_DIR = "/root/testdata/sf0.001"

# Null, empty, blank and long texts, ties, repeated rows, and an id that repeats with another text.
WORDS = [f"w{i}" for i in range(400)]
EDGE = [
    (1, " ".join(WORDS[:120]), "a"),
    (2, " ".join([*WORDS[:119], "other"]), "a"),
    (3, " ".join(WORDS[:120]).upper(), "b"),
    (4, None, "a"),
    (5, "", None),
    (6, " \t\n\x0b\r ", "b"),
    (7, "one two three", "b"),
    (8, "One  two\nthree", "b"),
    (9, " ".join(WORDS[200:300]), None),
    (9, " ".join(WORDS[200:300]), None),
    (10, "x y z " * 60, "a"),
    (11, " ".join(WORDS) * 40, "c"),
    (None, " ".join(WORDS[300:400]), "c"),
    (12, "é ß 日本 😀 <|endoftext|> it's  a b\n\n# $", "c"),
]


@pytest.fixture(scope="session")
def edge(spark):
    """Columns have names that operators use inside."""
    rows = [(i, text, source, "en", i, "kept") for i, text, source in EDGE]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n long, kept string").repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(edge):
    return edge.limit(0)


@pytest.fixture(scope="session")
def documents():
    return duckdb.sql(f"SELECT doc_id, text FROM '{SF_DIR}/documents.parquet'").fetchall()
