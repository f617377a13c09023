import os
import sys

import pytest
from samples import prose

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in any column, empty and long texts, repeated rows, ties, a column
    that clashes with the operators' own names."""
    a, b = prose(120, 1), prose(90, 2)
    rows = [(1, a, "en", "s1", 1), (2, a, "en", "s2", 1), (3, a + " tail", "en", "s1", None), (3, a + " tail", "en", "s1", None),
            (4, None, None, None, None), (5, "", "en", "s1", 0), (6, " \t\n ", "de", None, 3), (7, "one", "en", "s1", 3),
            (8, "ONE", "en", "s3", 3), (9, b + " " + prose(60, 3), "en", "s1", 9), (10, prose(50, 4) + " " + b, "fr", "s2", 9),
            (11, ("x" * 30_000) + " " + prose(4_000, 5), "en", "s1", 9), (None, a, "en", "s1", 9), (None, None, None, None, None),
            (12, "é世 " + prose(40, 6) + " ü", "en", "s1", 9), (13, "w " * 200, "en", "s1", 9)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, id int, key string, size string, h int"
    return spark.createDataFrame([(*r, 7, "k", "big", 5) for r in rows], schema)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def small_docs(spark):
    return spark.read.parquet(f"{SF0001}/documents.parquet")
