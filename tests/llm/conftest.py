import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)

NASTY = [(1, None), (2, ""), (3, "  \n\t "), (4, "word " * 30_000), (5, "same text here now ok"), (5, "same text here now ok"),
         (None, "same text here now ok"), (6, "a")]


@pytest.fixture
def nasty(spark):
    """Null, empty and very long texts, ties, a repeated row, a null id and extra columns with names in use."""
    rows = [(i, t, "x", 1.0, 7, "k") for i, t in NASTY]
    return spark.createDataFrame(rows, "doc_id bigint, text string, score string, places double, _judged int, key string")


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], "doc_id bigint, text string")
