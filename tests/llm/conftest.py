from __future__ import annotations

import os

import pytest

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "row long, n long, bits string, kept string, batch string, hash string, __id long, __row string, log_weight double, word int, id string, sha string"
)


def rows_of(*pairs, source="a"):
    return [(i, t, "en", source, None, *[None] * 12) for i, t in pairs]


@pytest.fixture
def documents(spark):
    """A table with the columns of ``documents`` and others whose names operators use themselves."""

    def build(*pairs, source="a"):
        return spark.createDataFrame(rows_of(*pairs, source=source), SCHEMA)

    return build


LONG = "some words again and again until the end of a very long text that goes on " * 4000
ODD = [
    (1, "one plain text of a few words"),
    (1, "one plain text of a few words"),
    (2, None),
    (3, ""),
    (None, "a text without an id"),
    (None, None),
    (None, "one plain text of a few words"),
    (4, LONG),
    (5, " \t\n"),
    (6, "größer als vorher, ñandú, 漢字 und 🙂"),
]


@pytest.fixture
def odd(documents):
    """Nulls, empty and long texts, repeated rows, clashing columns."""
    return documents(*ODD)


@pytest.fixture
def none(documents):
    return documents()


@pytest.fixture(scope="session")
def given(spark):
    if not os.path.isdir(SF_DIR):
        pytest.skip("the given tables are not here")

    def table(name):
        return spark.read.parquet(f"{SF_DIR}/{name}.parquet")

    return table
