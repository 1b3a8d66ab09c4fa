import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
for p in (ROOT, os.path.join(ROOT, "tests")):
    if p not in sys.path:
        sys.path.insert(0, p)

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, n_words long, group_size int"


@pytest.fixture(scope="session")
def make(spark):
    """Documents with extra columns whose names clash with result columns."""
    def build(rows):
        return spark.createDataFrame([(i, t, "en", s, None, "x", 7, 1) for i, t, s in rows], SCHEMA)
    return build


#: nulls, empty and blank texts, ties, repeated rows, a long text, a null id.
LONG = "word " * 30_000 + "end"
ODD = [(1, None, "a"), (2, "", None), (3, " \t\n", "a"), (4, "Some words here", "a"), (4, "Some words here", "a"),
       (5, "Somewordshere ", "b"), (6, LONG, "a"), (7, "ünï ▁ 漢字 \x0b x", None), (None, "no id", "a")]


@pytest.fixture(scope="session")
def odd(make):
    return make(ODD)


@pytest.fixture(scope="session")
def empty(make):
    return make([])
