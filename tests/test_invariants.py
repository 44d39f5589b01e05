"""Relations that must hold between results on the given tables."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from checks.registry import BankData
from ledgerloom.operators import dedup, joins
from ledgerloom.plans import reports

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the given tables are not here")


@pytest.fixture(scope="module")
def data(spark):
    return BankData(spark, SF_DIR)


def total(df, column):
    return df.agg(F.sum(F.col(column).cast("decimal(18,2)"))).first()[0]


def test_bills_and_daily_totals_add_up_to_all_transactions(data):
    everything = total(data.transactions, "TRANSACTION_VALUE")
    assert total(reports.monthly_bills(data.transactions, data.raw_customers), "total_bill") == everything
    daily = reports.daily_totals(data.transactions, data.raw_customers, data.branches)
    assert total(daily, "total_transaction_value") == everything
    assert total(reports.monthly_totals(data.transactions), "total_value") == everything


def test_customers_keep_every_card_once(data):
    cards = data.customers.groupBy("CREDIT_CARD_NO").count()
    assert cards.filter("count > 1").count() == 0
    assert cards.count() == data.raw_customers.select("CREDIT_CARD_NO").distinct().count()


def test_left_joins_keep_every_customer(data):
    fan_out = joins.with_crosswalk_rows(data.raw_customers, data.crosswalk)
    assert fan_out.select("CREDIT_CARD_NO").distinct().count() == data.raw_customers.count()
    assert joins.with_area_code(data.raw_customers, data.crosswalk).count() == data.raw_customers.count()


def test_duplicates_and_singles_make_up_the_table(data):
    fan_out = joins.with_crosswalk_rows(data.raw_customers, data.crosswalk)
    repeated = dedup.rows_with_duplicate_key(fan_out, "CREDIT_CARD_NO").count()
    singles = fan_out.groupBy("CREDIT_CARD_NO").count().filter("count = 1").count()
    assert repeated + singles == fan_out.count()


def test_shares_add_up_to_a_hundred(data):
    sums = reports.status_shares(data.loans).groupBy("cohort").agg(F.sum("share").alias("s")).collect()
    assert len(sums) == 3 and all(abs(r["s"] - 100) < 0.3 for r in sums)


def test_every_zip_has_five_digits_after_cleaning(data):
    assert data.branches.filter("length(BRANCH_ZIP) <> 5").count() == 0
    assert data.raw_branches.filter("length(cast(BRANCH_ZIP as string)) < 5").count() > 0


def test_running_twice_gives_the_same_tables(data):
    first, second = data.customers, BankData(data.spark, SF_DIR).customers
    assert first.exceptAll(second).count() == second.exceptAll(first).count() == 0
