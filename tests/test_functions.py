"""Column functions on hand-written rows: null, blank, wrong length, boundary cases."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import cleaning as c
from ledgerloom.functions import labels, validation
from ledgerloom.functions import predicates as p


def evaluate(spark, schema, values, build):
    df = spark.createDataFrame(values, schema)
    return [r[0] for r in df.select(build(*[F.col(name) for name in df.columns])).collect()]


def one(spark, build, *values, schema="a string"):
    return evaluate(spark, schema, [values], build)[0]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_zip_keeps_its_zero_in_both_ansi_modes(spark, settings, ansi):
    settings(**{"spark.sql.ansi.enabled": ansi})
    cases = [(7501, "NJ"), (85001, "AZ"), (7501, "TX"), (None, "NJ"), (7501, None), (750, "NJ")]
    got = evaluate(spark, "zip long, state string", cases, c.restore_zip_zero)
    assert got == ["07501", "85001", "7501", None, "7501", "750"]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_missing_on_a_number_does_not_raise(spark, settings, ansi):
    settings(**{"spark.sql.ansi.enabled": ansi})
    assert evaluate(spark, "a long", [(1,), (None,)], p.is_missing) == [False, True]
    assert evaluate(spark, "a string", [("",), (" ",), (None,), ("x",)], p.is_missing) == [True, False, True, False]


def test_zip_join_key(spark):
    cases = [("7501",), ("07501",), ("75011",), (None,), ("07501-1234",)]
    assert evaluate(spark, "a string", cases, c.zip_join_key) == ["07501", "07501", "75011", None, "07501-1234"]


def test_branch_phone(spark):
    cases = [("1234567890",), ("123456789",), ("12345678901",), ("",), (None,)]
    wrong = "Invalid phone number length"
    assert evaluate(spark, "a string", cases, c.format_ten_digit_phone) == ["(123)456-7890", wrong, wrong, wrong, None]
    assert evaluate(spark, "a long", [(1234567890,)], c.format_ten_digit_phone) == ["(123)456-7890"]


def test_customer_phone_and_area_code(spark):
    cases = [("201", 1237818), (None, 1237818), ("201", None)]
    assert evaluate(spark, "a string, n long", cases, c.phone_with_area_code) == ["(201)123-7818", None, None]
    assert evaluate(spark, "a string", [("201/551",), ("631",), (None,)], c.first_area_code) == ["201", "631", None]


def test_joined_words(spark):
    cases = [("ElPaso",), ("KingofPrussia",), ("McLean",), ("Dover",), ("El Paso",), ("aBcDe",), ("USAtown",), (None,)]
    assert evaluate(spark, "a string", cases, c.split_joined_words) == [
        "El Paso", "Kingof Prussia", "Mc Lean", "Dover", "El Paso", "a Bc De", "USAtown", None,
    ]


def test_mc_surnames(spark):
    cases = [("Mckinney",), ("McKINNEY",), ("Mc",), ("Mcd",), ("Smith",), ("mcdonald",), ("",), (None,)]
    assert evaluate(spark, "a string", cases, c.fix_mc_surname) == [
        "McKinney", "McKinney", "Mc", "McD", "Smith", "mcdonald", "", None,
    ]


def test_generated_email_and_address_need_every_part(spark):
    names = [("Alec", "Wm", "Hooper"), ("Alec", None, "Hooper"), (None, "Wm", "Hooper")]
    got = evaluate(spark, "f string, m string, l string", names, c.generated_email)
    assert got == ["AWHooper@example.com", None, None]
    parts = [("656", "Main Street"), (None, "Main Street"), ("656", None)]
    assert evaluate(spark, "a string, b string", parts, c.street_address) == ["656 Main Street", None, None]


def test_time_id(spark):
    cases = [(2018, 2, 14), (2018, 12, 1), (2018, None, 1)]
    assert evaluate(spark, "y int, m int, d int", cases, c.time_id) == ["20180214", "20181201", None]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_time_id_to_date(spark, settings, ansi):
    settings(**{"spark.sql.ansi.enabled": ansi})
    cases = [("20180214",), ("20180230",), ("2018214",), ("abc",), (None,)]
    assert evaluate(spark, "a string", cases, c.time_id_to_date) == [dt.date(2018, 2, 14), None, None, None, None]
    assert evaluate(spark, "a string", [("20180214",)], c.time_id_month) == ["02"]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_iso_timestamp(spark, settings, ansi):
    settings(**{"spark.sql.ansi.enabled": ansi})
    cases = [("2018-04-21T12:49:02.000-04:00",), ("2018-04-21",), ("",), (None,)]
    got = evaluate(
        spark, "a string", cases, lambda a: F.date_format(c.parse_iso_timestamp(a), "yyyy-MM-dd HH:mm:ss")
    )
    assert got == ["2018-04-21 16:49:02", None, None, None]


def test_labels(spark):
    months = [("01",), ("12",), ("13",), (None,)]
    assert evaluate(spark, "a string", months, labels.month_name) == ["January", "December", "13", None]
    states = [("NY",), ("WY",), ("PR",), (None,)]
    assert evaluate(spark, "a string", states, labels.state_name) == ["New York", "Wyoming", None, None]
    assert len(labels.STATE_NAMES) == 50
    assert one(spark, labels.currency_label, 1234.56, schema="a double") == "$1,234.56"
    assert one(spark, lambda a: labels.currency_label(a, 0), 1234.56, schema="a double") == "$1,235"
    assert one(spark, labels.thousands_label, 1234567, schema="a long") == "1,234,567"


def test_predicates(spark):
    emails = [("AHooper@example.com",), ("a@x.example.com",), (None,)]
    assert evaluate(spark, "a string", emails, p.is_unexpected_email) == [True, False, None]
    names = [("Hooper",), ("McKinney",), ("hooper",), ("H",), ("",)]
    assert evaluate(spark, "a string", names, p.is_not_title_case) == [False, True, True, True, True]
    types = [("Healthcare",), ("HEALTHCARE",), ("Gas",)]
    assert evaluate(spark, "a string", types, lambda a: p.equals_ignoring_case(a, "healthcare")) == [True, True, False]


ACCEPTED = [
    ("FIRST_NAME", "Ana María"),
    ("LAST_NAME", "x" * 50),
    ("FULL_STREET_ADDRESS", ""),
    ("FULL_STREET_ADDRESS", "1" * 100),
    ("CUST_CITY", "King of Prussia"),
    ("CUST_STATE", "TX"),
    ("CUST_COUNTRY", "Österreich"),
    ("CUST_ZIP", "12345"),
    ("CUST_PHONE", "(123)456-7890"),
    ("CUST_EMAIL", "a.b+c@x-y.org"),
]
REFUSED = [
    ("FIRST_NAME", ""),
    ("FIRST_NAME", "   "),
    ("FIRST_NAME", "R2"),
    ("LAST_NAME", "x" * 51),
    ("LAST_NAME", "O'Neil"),
    ("FULL_STREET_ADDRESS", "1" * 101),
    ("CUST_STATE", "TEX"),
    ("CUST_STATE", "T "),
    ("CUST_ZIP", "1234"),
    ("CUST_ZIP", "1234a"),
    ("CUST_PHONE", "1234567890"),
    ("CUST_EMAIL", "a@b"),
    ("CUST_EMAIL", "a b@c.org"),
    ("CUST_ZIP", None),
]


def test_field_rules(spark):
    schema = "f string, v string"
    assert evaluate(spark, schema, ACCEPTED, validation.rejection_reason) == [None] * len(ACCEPTED)
    got = evaluate(spark, schema, REFUSED, validation.rejection_reason)
    assert got == [f"Invalid value for {field}" for field, _ in REFUSED]
    unknown = evaluate(spark, schema, [("SSN", "1"), (None, "1")], validation.rejection_reason)
    assert unknown == ["Invalid field: SSN", "Invalid field: "]


def test_report_parameters(spark):
    zips = [("07501",), ("7501",), ("075011",), ("0750a",), (None,)]
    assert evaluate(spark, "a string", zips, validation.is_zip_parameter) == [True, False, False, False, False]
    months = [("02/2018",), ("2/2018",), ("12/0001",), ("13/2018",), ("00/2018",), ("02-2018",), ("02/18",), ("1/0000",)]
    assert evaluate(spark, "a string", months, validation.is_month_parameter) == [
        True, True, True, False, False, False, False, False,
    ]
