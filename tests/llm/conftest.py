import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

ODD = [
    (0, "Hello World!! it's 1234 <|endoftext|>x foo", "en", "a"),
    (1, None, "en", "a"),
    (2, "", None, "a"),
    (3, "  lead and tail  ", "de", None),
    (4, "a  b\n\nc \n d\t\te\r\n f", "de", "b"),
    (5, "日本語 テスト  \n\t 😀😀 don't I'LL été ÉTÉ", "fr", "b"),
    (6, "x " * 30_000, "en", "b"),
    (7, "one two three four five six seven eight nine ten eleven", "en", "b"),
    (8, "one two three four five six seven eight nine ten eleven", "en", "b"),
    (8, "one two three four five six seven eight nine ten eleven", "en", "b"),
    (9, "one two three four five six seven eight nine ten changed", "en", "b"),
    (None, "no id here", None, None),
    (None, None, None, None),
]
SCHEMA = "doc_id long, text string, lang string, source string, ids string, n int, _wf_x int, part string"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls anywhere, empty and very long texts, ties, repeated rows, clashing column names."""
    return spark.createDataFrame([(*r, "i", 1, 2, "p") for r in ODD], SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def some(spark):
    """A few hundred real rows."""
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
