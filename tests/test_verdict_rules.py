"""Dirty rows: nothing is dropped, made up or accepted by mistake."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from checks.registry import QUERIES, BankData
from ledgerloom import schemas
from ledgerloom.functions import labels, validation
from ledgerloom.operators import joins, profile, ranking, updates
from ledgerloom.plans import reports
from ledgerloom.sources import readers, writers
from tests.helpers import final_plan, rows

CROSSWALK = "CUST_ZIP string, CUST_STATE string, CUST_CITY string, CUST_COUNTY string, AREA_CODE string, TIME_ZONE string, DST string"


def test_any_zip_matches_but_a_blank_one(spark):
    customers = spark.createDataFrame([(1, "501-1"), (2, "123456"), (3, ""), (4, " "), (5, "0"), (6, None)], "id int, CUST_ZIP string")
    crosswalk = spark.createDataFrame([(z, None, None, None, a, None, None) for z, a in [("501-1", "1"), ("123456", "2"), ("", "3"), ("00000", "4"), (None, "5")]], CROSSWALK)
    assert rows(joins.with_area_code(customers, crosswalk).select("id", "AREA_CODE")) == sorted(
        [(1, "1"), (2, "2"), (3, None), (4, None), (5, "4"), (6, None)], key=repr
    )


def test_repeated_keys_lose_no_change(spark):
    before = spark.createDataFrame([(1, "c1", "x@e"), (1, "c2", "y@e"), (2, "c3", None)], "ssn int, card string, e string")
    after = spark.createDataFrame([(1, "c1", "x@e"), (1, "c2", "z@e"), (2, "c3", "n@e")], "ssn int, card string, e string")
    assert rows(joins.changed_values(before, after, ["ssn", "card"], "e", [])) == [(1, "c2", "y@e", "z@e")]
    assert len(rows(joins.changed_values(before, after, ["ssn", "card"], "e", [], null_safe=True))) == 2
    assert ("y@e", "z@e") in {r[1:] for r in rows(joins.changed_values(before, after, "ssn", "e", []))}
    assert rows(joins.repeated_keys(before, "ssn")) == [(1, 2)]


@pytest.mark.parametrize("block_rows", [1, 2, 1_000_000])
def test_every_request_is_audited(spark, block_rows):
    values = {f.name: None for f in schemas.CUSTOMER.fields}
    customers = spark.createDataFrame([[{**values, "CREDIT_CARD_NO": "c1", "CUST_CITY": "Rome"}[f.name] for f in schemas.CUSTOMER.fields]], schemas.CUSTOMER)
    asked = [(1 << 40, "c1", "CUST_CITY", "Oslo"), (3, None, "CUST_CITY", "Bern"), (None, "c1", "CUST_CITY", "Kyiv"), (None, None, "CUST_CITY", "Lima"), (7, "c1", "CUST_CITY", "Oslo")]
    requests = spark.createDataFrame(asked, schemas.CHANGE_REQUEST)
    audit = updates.audit_changes(customers, requests, block_rows=block_rows)
    got = {(r.REQUEST_ID, r.CREDIT_CARD_NO): (r.value_before, r.status) for r in audit.collect()}
    assert got == {
        (None, "c1"): ("Rome", "changed"), (7, "c1"): ("Kyiv", "changed"), (1 << 40, "c1"): ("Oslo", "unchanged"),
        (3, None): (None, "no_account"), (None, None): (None, "no_account"),
    }
    assert audit.count() == len(asked)
    assert updates.apply_changes(customers, requests).first().CUST_CITY == "Oslo"


@pytest.mark.parametrize("field, value", [("CUST_STATE", "T\n"), ("FIRST_NAME", "Amy\n"), ("CUST_ZIP", "12345\n"), ("LAST_NAME", "a\n")])
def test_a_final_newline_is_refused(spark, field, value):
    df = spark.createDataFrame([(field, value)], "f string, v string")
    assert df.select(validation.rejection_reason(F.col("f"), F.col("v"))).first()[0] == f"Invalid value for {field}"
    period = spark.createDataFrame([("03/2018\n", "12345\n")], "p string, z string")
    assert period.select(validation.is_month_parameter(F.col("p")), validation.is_zip_parameter(F.col("z"))).first() == (False, False)


def test_bad_dates_are_one_group(spark):
    transactions = spark.createDataFrame(
        [("c", "20180230", 1, 2.0), ("c", "2018AB01", 1, 3.0), ("c", "20180201", 1, 4.0)],
        "CREDIT_CARD_NO string, TIMEID string, BRANCH_CODE long, TRANSACTION_VALUE double",
    )
    customers = spark.createDataFrame([("c", 1, "A", "B")], "CREDIT_CARD_NO string, SSN long, FIRST_NAME string, LAST_NAME string")
    branches = spark.createDataFrame([(1, "00001")], "BRANCH_CODE long, BRANCH_ZIP string")
    found = reports.daily_totals(transactions, customers, branches).collect()
    assert {(r.transaction_date, r.total_transaction_value) for r in found if r.transaction_date is None} == {(None, 5.0)} and len(found) == 2


def test_distinct_values_of_empty_tables_and_zeros(spark):
    assert rows(profile.distinct_per_column(spark.createDataFrame([], "a int, b string"))) == [("a", 0), ("b", 0)]
    assert rows(profile.distinct_per_column(spark.createDataFrame([(0.0,), (-0.0,), (1.0,), (None,)], "d double"))) == [("d", 2)]


def test_appending_new_rows_is_repeatable(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "n"), (2, None)], "k int, v string")
    for _ in range(2):
        writers.append_new_rows(df, path, ["k"])
        assert rows(spark.read.parquet(path)) == sorted([(1, "a"), (None, "n"), (2, None)], key=repr)


def test_labels_cut_and_round(spark):
    df = spark.createDataFrame([(1234.7, -1234.7)], "a double, b double")
    assert df.select(labels.thousands_label(F.col("a")), labels.thousands_label(F.col("b"))).first() == ("1,234", "-1,234")
    assert df.select(labels.currency_label(F.col("a"), 0), labels.currency_label(F.col("b"))).first() == ("$1,235", "$-1,234.70")


def test_many_values_under_one_initial_are_split(spark, settings):
    settings(**{"spark.sql.shuffle.partitions": "8", "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    df = spark.range(2000).select(F.lit("all@x").alias("email"), F.format_string("A%05d", F.col("id")).alias("middle"), "id")
    ranked = ranking.rank_within(df, "email", "middle")
    assert ranked.filter("rank = id + 1").count() == 2000


def test_sort_orders(spark):
    folder = "/root/testdata/sf0.001"
    for name, order in {
        "sort_asc": lambda r: r.TRANSACTION_TYPE,
        "sort_desc": lambda r: -r.transactions,
        "sort_multi_desc": lambda r: tuple(-float(x) for x in (r.TIMEID, r.TRANSACTION_VALUE, r.TRANSACTION_ID)),
    }.items():
        found = driver.queries()[name](spark, folder).collect()
        assert found == sorted(found, key=order) and len(found) > 1


def planned(spark, settings, name) -> str:
    """The plan before it runs, with the scans' filters in full."""
    settings(**{"spark.sql.maxMetadataStringLength": "2000"})
    return QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["filter_date_between", "agg_monthly_bill", "agg_card_date_range", "agg_count_exists", "filter_point"])
def test_point_reports_push_the_card(spark, settings, name):
    assert "EqualTo(CREDIT_CARD_NO" in planned(spark, settings, name)


@pytest.mark.parametrize("name", ["filter_date_between", "filter_year_month", "agg_monthly_bill", "agg_zip_month_daily"])
def test_period_reports_prune_months_and_push_days(spark, settings, name):
    plan = planned(spark, settings, name)
    assert "GreaterThanOrEqual(TIMEID" in plan
    assert "PartitionFilters: [isnotnull(TXN_MONTH" in plan


@pytest.mark.parametrize("name", ["status_shares", "approval_comparison"])
def test_shares_read_the_loans_once(spark, tmp_path, name):
    path = str(tmp_path / "loans")
    BankData(spark, "/root/testdata/sf0.001").loans.write.parquet(path)
    plan = final_plan(getattr(reports, name)(readers.read_table(spark, path)))
    assert plan.split("Initial Plan")[0].count("FileScan") == 1
