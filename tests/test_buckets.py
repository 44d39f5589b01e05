"""Tables stored by card: no shuffle on the card, hot cards apart."""

from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from ledgerloom.plans import reports
from ledgerloom.session import new_path
from ledgerloom.sources import buckets
from tests.helpers import final_plan, rows
from tests.test_card_tables import scanned_rows

N, BUCKETS = 30_000, 8


@pytest.fixture(scope="module")
def stored(spark):
    """Transactions of which a third are on one card, holders of whom one has very many rows, and null cards."""
    card = F.when(F.col("id") % 3 == 0, 5).when(F.col("id") % 50 != 1, F.col("id") % 701)
    transactions = spark.range(0, N, 1, 8).select(
        F.concat(F.lit("c"), card).alias("CREDIT_CARD_NO"), F.date_format(F.date_add(F.lit("2018-01-01").cast("date"), (F.col("id") % 365).cast("int")), "yyyyMMdd").alias("TIMEID"),
        F.lit(1.25).alias("TRANSACTION_VALUE"), F.col("id").alias("TRANSACTION_ID"),
    )
    holders = spark.range(701 + 300).select(
        F.concat(F.lit("c"), F.when(F.col("id") < 701, F.col("id")).otherwise(9)).alias("CREDIT_CARD_NO"), F.col("id").alias("SSN"),
        F.lit("A").alias("FIRST_NAME"), F.lit("B").alias("LAST_NAME"),
    )
    names = []
    for df in (transactions, holders):
        name = f"by_card_{uuid.uuid4().hex}"
        path = new_path(spark, name)
        buckets.write_bucketed(df, name, path, "CREDIT_CARD_NO", BUCKETS)
        names.append((name, path))
    return transactions, holders, names


def test_hot_cards_are_kept_apart_and_no_row_is_lost(spark, stored):
    transactions, holders, ((t, _), (h, _)) = stored
    assert rows(buckets.read_bucketed(spark, t)) == rows(transactions) and rows(buckets.read_bucketed(spark, h)) == rows(holders)
    assert rows(buckets.parts_bucketed(spark, t)[1].select("CREDIT_CARD_NO").distinct()) == [("c5",)]
    assert rows(buckets.parts_bucketed(spark, h)[1].select("CREDIT_CARD_NO").distinct()) == [("c9",)]
    files = [n for _, n in rows(spark.table(t).groupBy(F.input_file_name()).count())]
    assert len(files) == BUCKETS and max(files) < N / 3


def test_joins_and_bills_need_no_shuffle_on_the_card(spark, stored, settings):
    transactions, holders, ((t, _), (h, _)) = stored
    settings(**{"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"})
    joined = buckets.join_bucketed(spark, t, h, "CREDIT_CARD_NO", BUCKETS, ["SSN", "FIRST_NAME"])
    assert rows(joined) == rows(transactions.join(holders.drop("LAST_NAME"), "CREDIT_CARD_NO").select(joined.columns))
    bucketed = spark.table(t).join(spark.table(h), "CREDIT_CARD_NO")
    assert "Exchange" not in final_plan(bucketed)
    # the bucketed tables are read where they are; only hot rows may be in a shuffle, and here all of one side's are broadcast
    shuffled = [part.split("FileScan")[1:2] for part in final_plan(joined).split("Initial Plan")[0].split("Exchange hashpartitioning(CREDIT_CARD_NO")[1:]]
    assert all("_hot" in scan[0].split("Batched")[0] for scan in shuffled if scan)
    bills = reports.monthly_bills_bucketed(spark, t, h, BUCKETS)
    assert rows(bills) == rows(reports.monthly_bills(transactions, holders).select(bills.columns))
    # only sums of hot cards meet in a shuffle, never the rows of a card
    lines = [line for line in final_plan(bills).split("Initial Plan")[0].splitlines() if "Exchange hashpartitioning(CREDIT_CARD_NO" in line]
    assert all("_groupingexpression" in line or "SSN" in line for line in lines)


def test_stored_tables_open_in_another_session(spark, stored):
    transactions, _, ((t, path), _) = stored
    name = f"again_{uuid.uuid4().hex}"
    buckets.open_bucketed(spark, name, path, "CREDIT_CARD_NO", BUCKETS)
    assert rows(buckets.read_bucketed(spark, name)) == rows(transactions)
    one = spark.table(name).filter("CREDIT_CARD_NO = 'c17'")
    assert scanned_rows(one) < N / BUCKETS


def test_empty_tables_are_stored_too(spark):
    names = []
    for i in range(2):
        names.append(f"empty_{uuid.uuid4().hex}")
        buckets.write_bucketed(spark.range(0).select(F.col("id").cast("string").alias("k"), F.col("id").alias(f"v{i}")), names[-1], new_path(spark, names[-1]), "k", 4)
    assert buckets.join_bucketed(spark, *names, "k", 4, ["v1"]).count() == 0
