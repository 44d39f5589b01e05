"""Feeds of JSON arrays: bounded files, written record by record, compressed unless they are read in ranges."""

from __future__ import annotations

import glob
import gzip
import json

import pytest

from checks import feeds
from ledgerloom.plans import reports
from ledgerloom.sources import readers
from tests.helpers import final_plan, rows


@pytest.mark.parametrize("n", [0, 1, 7, 8, 20, 40])
def test_arrays_are_whole_and_of_bounded_size(spark, monkeypatch, settings, n):
    monkeypatch.setattr(feeds, "FILE_RECORDS", 8)
    settings(**{"spark.sql.execution.arrow.maxRecordsPerBatch": "3"})
    table = spark.range(n).selectExpr("id", "if(id % 3 = 0, null, concat('a\"', id)) as t").repartition(2)
    for compression in ("gzip", "none"):
        path = feeds.write_json_arrays(table, "feed", compression)
        files = glob.glob(f"{path}/part-*")
        assert all(f.endswith(".gz") == (compression == "gzip") for f in files)
        texts = [gzip.open(f, "rt").read() if f.endswith(".gz") else open(f).read() for f in files]
        sizes = [len(json.loads(t)) for t in texts if t]
        assert sum(sizes) == n and all(0 < s <= 8 for s in sizes)
        assert rows(readers.read_json_records(spark, path, table.schema)) == rows(table)


def test_bills_of_repeated_holders_are_grouped_before_the_join(spark):
    transactions = spark.createDataFrame([("1", "20200105", 2.5), ("1", "20200106", 1.0), ("1", "20200201", None), ("2", "20200105", 4.0)], "CREDIT_CARD_NO string, TIMEID string, TRANSACTION_VALUE double")
    holders = [("1", 7, "A", None)] * 2 + [("1", 8, "A", None), ("2", None, None, "B")]
    customers = spark.createDataFrame(holders, "CREDIT_CARD_NO string, SSN long, FIRST_NAME string, LAST_NAME string")
    bills = reports.monthly_bills(transactions, customers)
    found = {(r.CREDIT_CARD_NO, r.bill_month.month, r.SSN): r.total_bill for r in bills.collect()}
    assert found == {("1", 1, 7): 7.0, ("1", 1, 8): 3.5, ("1", 2, 7): None, ("1", 2, 8): None, ("2", 1, None): 4.0}
    plan = final_plan(bills)
    join = next(i for i, line in enumerate(plan.splitlines()) if "Join" in line)
    assert not any("Aggregate" in line for line in plan.splitlines()[:join])
