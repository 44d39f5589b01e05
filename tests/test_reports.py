"""Reports on small tables: nulls, copies, empty periods, ties."""

from __future__ import annotations

import datetime as dt

import pytest

from ledgerloom import schemas
from ledgerloom.plans import reports
from tests.helpers import rows


@pytest.fixture(scope="module")
def transactions(spark):
    data = [
        (1, "c1", "20180105", 1, 10, "Bills", 10.10),
        (2, "c1", "20180105", 1, 10, "Gas", 0.20),
        (3, "c1", "20180131", 1, 11, "healthcare", 5.00),
        (4, "c1", "20180201", 1, 10, "Healthcare", 7.00),
        (5, "c2", "20180105", 2, 10, None, 3.33),
        (6, "c3", "20180230", 3, 10, "Bills", 9.99),
        (7, "c2", "20171231", 2, 12, "Bills", None),
    ]
    return spark.createDataFrame(data, schemas.TRANSACTION)


@pytest.fixture(scope="module")
def customers(spark):
    people = [(1, "Amy", "c1", "NY"), (2, "Beth", "c2", "NY"), (2, "Beth", "c2", "NY"), (4, "Carl", "c9", None)]
    data = []
    for ssn, first, card, state in people:
        row = dict.fromkeys(schemas.CUSTOMER.names)
        row.update(SSN=ssn, FIRST_NAME=first, LAST_NAME="X", CREDIT_CARD_NO=card, CUST_STATE=state)
        data.append(tuple(row.values()))
    return spark.createDataFrame(data, schemas.CUSTOMER)


@pytest.fixture(scope="module")
def branches(spark):
    data = [(10, "07501"), (11, "07501"), (12, "10001")]
    return spark.createDataFrame(data, "BRANCH_CODE long, BRANCH_ZIP string")


def test_periods(transactions):
    def ids(df):
        return sorted(r["TRANSACTION_ID"] for r in df.collect())

    assert ids(reports.in_month(transactions, 2018, 1)) == [1, 2, 3, 5]
    assert ids(reports.in_month(transactions, 2017, 12)) == [7]
    assert ids(reports.in_month(transactions, 2018, 2)) == [4]  # 30 February is no date
    assert ids(reports.in_period(transactions, dt.date(2018, 1, 31), dt.date(2018, 2, 1))) == [3, 4]


def test_daily_totals_for_zip(transactions, customers, branches):
    got = reports.daily_totals_for_zip(transactions, customers, branches, "07501", 2018, 1).collect()
    assert [tuple(r) for r in got] == [
        (1, "Amy", "X", "c1", "07501", dt.date(2018, 1, 31), 31, 5.0),
        (1, "Amy", "X", "c1", "07501", dt.date(2018, 1, 5), 5, 10.3),
        (2, "Beth", "X", "c2", "07501", dt.date(2018, 1, 5), 5, 6.66),  # two copies of the customer
    ]
    whole = reports.daily_totals(transactions, customers, branches)
    january = whole.filter("BRANCH_ZIP = '07501' and transaction_date between '2018-01-01' and '2018-01-31'")
    assert rows(january) == rows(reports.daily_totals_for_zip(transactions, customers, branches, "07501", 2018, 1))
    assert reports.daily_totals_for_zip(transactions, customers, branches, "00000", 2018, 1).count() == 0


def test_bills(transactions, customers):
    assert rows(reports.monthly_bill(transactions, customers, "c1", 1, 2018)) == [(1, "Amy", "X", 15.3)]
    assert reports.monthly_bill(transactions, customers, "c1", 3, 2018).count() == 0
    bills = {(r["CREDIT_CARD_NO"], r["bill_month"]): r["total_bill"] for r in reports.monthly_bills(transactions, customers).collect()}
    assert bills == {
        ("c1", dt.date(2018, 1, 1)): 15.3,
        ("c1", dt.date(2018, 2, 1)): 7.0,
        ("c2", dt.date(2018, 1, 1)): 6.66,
        ("c2", dt.date(2017, 12, 1)): None,
    }


def test_cards(transactions, customers):
    assert rows(reports.card_count(transactions, "c1")) == [(4,)]
    assert rows(reports.card_count(transactions, "zz")) == [(0,)]
    counts = reports.cards_with_transactions(customers, transactions)
    assert rows(counts) == [("c1", 4), ("c2", 2), ("c2", 2), ("c9", 0)]
    assert rows(reports.card_date_range(transactions, "zz")) == [(None, None)]
    newest = reports.card_transactions(transactions, "c1", dt.date(2018, 1, 1), dt.date(2018, 1, 31)).collect()
    assert [r["TIMEID"] for r in newest] == ["20180131", "20180105", "20180105"]


def test_statements(spark, transactions):
    day = dt.date
    asked = [
        ("c1", day(2018, 1, 31), day(2018, 2, 1)),
        ("c1", day(2018, 1, 31), day(2018, 2, 1)),
        ("c1", day(2019, 1, 1), day(2019, 2, 1)),
        ("c3", day(2018, 1, 1), day(2018, 12, 31)),
        ("zz", day(2018, 1, 1), day(2018, 12, 31)),
    ]
    requests = spark.createDataFrame(asked, "CREDIT_CARD_NO string, first_date date, last_date date")
    got = reports.card_statements(requests, transactions).drop("first_date", "last_date")
    assert rows(got) == sorted(
        [
            ("c1", "found", day(2018, 1, 31), "healthcare", 5.0, None, None),
            ("c1", "found", day(2018, 2, 1), "Healthcare", 7.0, None, None),
            ("c1", "outside_range", None, None, None, day(2018, 1, 5), day(2018, 2, 1)),
            ("c3", "outside_range", None, None, None, None, None),  # only a date that does not exist
            ("zz", "no_transactions", None, None, None, None, None),
        ],
        key=repr,
    )


def test_counts_ignore_nulls_but_keep_their_group(transactions, customers):
    by_type = {r[0]: r[1] for r in reports.transactions_by_type(transactions).collect()}
    assert by_type == {"Bills": 3, "Gas": 1, "Healthcare": 1, "healthcare": 1, None: 0}
    assert rows(reports.customers_by_state(customers)) == sorted([("NY", 3), (None, 0)], key=repr)
    assert rows(reports.top_states_with_ties(customers)) == sorted([("NY", 3), (None, 0)], key=repr)


def test_rankings(transactions):
    assert rows(reports.top_customers_by_count(transactions, 2)) == [(1, 4), (2, 1)]
    assert [tuple(r) for r in reports.top_customers_by_value(transactions, 2).collect()] == [(1, 22.3), (3, 9.99)]
    assert rows(reports.top_branches_for_type(transactions)) == [(10, 7.0), (11, 5.0)]
    assert [tuple(r) for r in reports.top_months_by_value(transactions, 2).collect()] == [("01", 18.63), ("02", 16.99)]
    top = reports.report_top_months(transactions, 1)
    assert rows(top) == [
        ("total_value", "January", 18.63, 4, "$18.63"),
        ("transactions", "January", 18.63, 4, "4"),
    ]
    low, high = reports.axis_bounds(reports.count_by(transactions, "CUST_SSN", "n"), "n").first()
    assert (low, high) == pytest.approx((0.9, 4.4))


def test_loans(spark):
    def loan(status, employed, gender, married):
        row = dict.fromkeys(schemas.LOAN.names)
        row.update(Application_Status=status, Self_Employed=employed, Gender=gender, Married=married)
        return tuple(row.values())

    data = [loan("Y", "No", "Male", "Yes")] * 2 + [loan("N", "Yes", "Female", "No")] + [loan("Y", "No", None, None)] * 3
    loans = spark.createDataFrame(data, schemas.LOAN)
    assert rows(reports.loans_by_status(loans)) == [("N", 1), ("Y", 5)]
    assert rows(reports.loans_by_status_where(loans, Gender="Male", Married="Yes")) == [("Y", 2)]
    shares = rows(reports.status_shares(loans).select("cohort", "Application_Status", "applications", "share"))
    assert shares == [
        ("all_applicants", "N", 1, 16.7),
        ("all_applicants", "Y", 5, 83.3),
        ("married_male", "Y", 2, 100.0),
        ("self_employed", "N", 1, 100.0),
    ]
    assert rows(reports.approval_comparison(loans)) == [("N", 1, 1, 100.0, 16.7), ("Y", 0, 5, 0.0, 83.3)]
