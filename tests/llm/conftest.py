from __future__ import annotations

import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def documents(spark):
    """(doc_id, text) of the small table, in the driver."""
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in every column, empty and very long texts, repeated rows, and extra columns with clashing names."""
    rng = random.Random(7)
    long_text = " ".join(rng.choice(["ab", "cd", "ef", "gh!", "password=abcdefghijkl1"]) + str(rng.randrange(50)) for _ in range(30_000))
    rows = [
        (1, None, None, None, None), (2, "", "en", "s", 0), (3, long_text, "en", "s", len(long_text)),
        (3, long_text, "en", "s", len(long_text)), (None, "one two three", "en", None, 13), (4, " \t\n ", "de", "s", 4),
        (5, "a b c a b c a b c", "fr", "s", 17), (6, "\u00e9\u2003\u00df x\u00a0y", "es", "s", 6), (7, "one two three", "en", "s", 13),
    ]
    extra = [(*r, "x", 1, True, "y") for r in rows]
    return spark.createDataFrame(extra, DOCS + ", words string, n_words int, kept boolean, `a.b c` string")


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)
