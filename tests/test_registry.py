"""Every registered query against its SQL in DuckDB, on the given tables."""

from __future__ import annotations

import os
import re

import pytest

import __spark_entry__ as driver
from checks import compare
from checks.registry import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the given tables are not here")


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = compare.spark_rows(driver.queries()[name](spark, SF_DIR))
    assert compare.difference(got, compare.duck_rows(duck, driver.oracle_sql()[name])) is None


def test_entry(spark):
    df = driver.entry(spark)
    assert df.count() > 0 and "total_transaction_value" in df.columns


def test_names():
    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert set(QUERIES) <= set(driver.oracle_sql())
    assert not [n for n in QUERIES if re.match(r"op\d|.*pipeline", n)]
