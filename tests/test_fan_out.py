"""Customers against a crosswalk that lists their ZIPs many times: counts and smallest rows come without the product."""

from __future__ import annotations

from checks import queries_joins, queries_reports
from checks.registry import QUERIES
from ledgerloom.operators import dedup, joins, profile
from tests.helpers import final_plan, rows

CUSTOMER = "CREDIT_CARD_NO string, SSN long, CUST_ZIP string"
CROSSWALK = "CUST_ZIP string, CUST_STATE string, CUST_CITY string, CUST_COUNTY string, AREA_CODE string, TIME_ZONE string, DST string"
CUSTOMERS = [("1", 1, "501"), ("1", 2, "00501"), ("1", 1, "501"), ("2", 3, "10001"), ("3", 4, " "), ("4", 5, None), (None, 6, "00501"), ("5", 7, "99999")]
ZIPS = [
    ("00501", "NY", None, "b", "9", "5", "Y"), ("501", "NY", None, "b", "9", "6", "N"), ("501", None, "c", None, None, "5", "Y"),
    ("10001", None, None, None, None, "5", "Y"), (" ", "NY", "x", "x", "1", "5", "Y"), (None, "NY", "x", "x", "1", "5", "Y"),
]


class Data:
    def __init__(self, spark, customers, crosswalk):
        self.spark = spark
        self.raw_customers = spark.createDataFrame(customers, CUSTOMER)
        self.crosswalk = spark.createDataFrame(crosswalk, CROSSWALK)


def test_counts_and_smallest_rows_equal_those_of_the_product(spark):
    d = Data(spark, CUSTOMERS, ZIPS)
    product = joins.with_crosswalk_rows(d.raw_customers, d.crosswalk)
    assert product.count() == 3 * 3 + 1 + 1 + 1 + 3 + 1
    assert rows(queries_joins.deduplicated(d)) == rows(dedup.one_row_per_key(product, "CREDIT_CARD_NO"))
    expected = dedup.rows_with_duplicate_key(product, "CREDIT_CARD_NO")
    found = queries_joins.duplicates_with_rows(d)
    assert found.columns == expected.columns and rows(found) == rows(expected)
    counted = dedup.duplicate_values(queries_reports.match_counts(d), "CREDIT_CARD_NO", copies="matches")
    assert rows(counted) == rows(dedup.duplicate_values(product, "CREDIT_CARD_NO"))
    different = queries_reports.match_counts(d).drop("matches")
    assert profile.distinct_rows(different, "different_matches").first()[0] == profile.distinct_rows(product).first()[0] == 2 + 2 + 1 + 1 + 1 + 2 + 1


def test_empty_tables(spark):
    for customers, zips, n in [([], ZIPS, 0), (CUSTOMERS, [], len(CUSTOMERS) - 1)]:
        d = Data(spark, customers, zips)
        assert joins.with_crosswalk_rows(d.raw_customers, d.crosswalk).count() == len(customers)
        assert profile.distinct_rows(queries_reports.match_counts(d).drop("matches"), "different_matches").first()[0] == n


def test_product_of_many_copies_is_dealt_by_its_rows(spark, monkeypatch):
    monkeypatch.setattr(joins, "ROWS_A_TASK", 10_000)
    d = Data(spark, [("1", i, "10001") for i in range(40)], [("10001", "NY", "c", "c", "9", "5", "Y")] * 2_500)
    product = joins.with_crosswalk_rows(d.raw_customers, d.crosswalk)
    assert product.count() == 100_000
    per_task = product.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
    assert max(per_task) <= 30_000


def test_no_query_but_the_product_itself_reads_it(spark, monkeypatch):
    d = Data(spark, [("1", 1, "10001")] * 100, [("10001", "NY", "c", "c", "9", "5", "Y")] * 100)
    def never(*args):
        raise AssertionError("the product was asked for")
    monkeypatch.setattr(joins, "with_crosswalk_rows", never)
    assert queries_joins.deduplicated(d).count() == 1
    assert dedup.duplicate_values(queries_reports.match_counts(d), "CREDIT_CARD_NO", copies="matches").first()[1] == 10_000
    assert {"dedup_by_key", "agg_distinct_rows", "agg_duplicate_cards"} <= QUERIES.keys()


def test_copies_come_in_blocks_of_any_sum(spark, monkeypatch):
    """Every number of copies is the sum of its blocks, and who meets none of them still comes once."""
    wanted = [1, 2, 7, 8, 9, 10, 64, 65, 72, 73, 511, 512, 513, 584, 1025, 5000]
    zips = [(f"{20000 + n}", "NY", f"c{k}", None, None, "5", "Y") for n in wanted for k in (0, 1) for _ in range(n + k)]
    customers = [("1", n, f"{20000 + n}") for n in wanted] + [("2", 0, "501"), ("3", 0, None), ("4", 0, " ")]
    for most in (joins.ROWS_A_TASK, 500):
        monkeypatch.setattr(joins, "ROWS_A_TASK", most)
        product = joins.with_crosswalk_rows(spark.createDataFrame(customers, CUSTOMER), spark.createDataFrame(zips, CROSSWALK))
        found = {(r.SSN, r.right_CUST_CITY): r["count"] for r in product.groupBy("SSN", "right_CUST_CITY").count().collect()}
        assert found == {(n, f"c{k}"): n + k for n in wanted for k in (0, 1)} | {(0, None): 3}


def test_finished_rows_are_repeated_behind_the_join(spark):
    """An explode above the join would build each of the equal rows from its columns again."""
    for build, n in ((queries_joins.fan_out, 600 * (9 + 1 + 3) + 3), (queries_joins.duplicates_with_rows, 600 * (9 + 1))):
        product = build(Data(spark, CUSTOMERS, ZIPS * 600))
        plan = final_plan(product)
        assert "CartesianProduct" in plan and "Generate" not in plan
        assert product.count() == n
