"""Tables laid out by card, and statements that meet only the months they ask for."""

from __future__ import annotations

import datetime as dt
import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ledgerloom.plans import reports
from ledgerloom.session import new_path
from ledgerloom.sources import readers, writers
from tests.helpers import rows

N, CARDS = 60_000, 997
DAYS = 365


@pytest.fixture(scope="module")
def transactions(spark):
    """Two thirds of the rows on many cards, a third on one."""
    card = F.when(F.col("id") % 3 == 0, 5).otherwise((F.col("id") * 7919) % CARDS)
    day = F.date_add(F.lit("2018-01-01").cast("date"), (F.col("id") % DAYS).cast("int"))
    df = spark.range(0, N, 1, 8).select(
        F.col("id").alias("TRANSACTION_ID"),
        F.format_string("4%015d", card).alias("CREDIT_CARD_NO"),
        F.date_format(day, "yyyyMMdd").alias("TIMEID"),
        F.element_at(F.array(F.lit("Bills"), F.lit("Gas")), (F.col("id") % 2 + 1).cast("int")).alias("TRANSACTION_TYPE"),
        (F.col("id") % 100).cast("double").alias("TRANSACTION_VALUE"),
    )
    return df.withColumn("TXN_MONTH", F.substring("TIMEID", 1, 6))


@pytest.fixture(scope="module")
def clustered(spark, transactions):
    path = new_path(spark, "clustered")
    order = ["CREDIT_CARD_NO", "TIMEID", "TRANSACTION_ID"]
    writers.overwrite_clustered(transactions, path, order, ["TXN_MONTH"], row_group_bytes=16 * 1024)
    return path


def row_groups(path: str, card: str) -> tuple[int, int]:
    """Row groups whose bounds admit ``card``, and all."""
    admit = every = 0
    for file in glob.glob(f"{path}/**/*.parquet", recursive=True):
        meta = pq.ParquetFile(file).metadata
        at = next(i for i in range(meta.num_columns) if meta.schema.column(i).name == "CREDIT_CARD_NO")
        for g in range(meta.num_row_groups):
            bounds = meta.row_group(g).column(at).statistics
            every += 1
            admit += bounds.min <= card <= bounds.max
    return admit, every


def scans_of(df, path: str) -> int:
    """How often a query reads the files of a table."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(path in str(leaves.apply(i).relation().location().rootPaths()) for i in range(leaves.size()) if "LogicalRelation" in leaves.apply(i).getClass().getSimpleName())


def scanned_rows(df) -> int:
    """Rows that left the scan of a finished query."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.finalPhysicalPlan().collectLeaves() if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()) if "FileSource" in leaves.apply(i).getClass().getSimpleName())


def test_a_card_is_in_few_row_groups(spark, transactions, clustered):
    card = f"4{123:015d}"
    admit, every = row_groups(clustered, card)
    months = 12
    assert every > 10 * months and admit <= 2 * months
    flat = new_path(spark, "flat")
    writers.overwrite_rows(transactions, flat, ["TXN_MONTH"])
    assert rows(spark.read.parquet(clustered)) == rows(spark.read.parquet(flat))
    stored = readers.read_table(spark, clustered)
    own = stored.filter(F.col("CREDIT_CARD_NO") == card)
    assert rows(own.select("TRANSACTION_ID")) == rows(transactions.filter(F.col("CREDIT_CARD_NO") == card).select("TRANSACTION_ID"))
    assert scanned_rows(own.select("TRANSACTION_ID")) < N / 10
    bill = stored.filter("TXN_MONTH = '201803'").filter(F.col("CREDIT_CARD_NO") == card).select("TRANSACTION_VALUE")
    assert scanned_rows(bill) < N / 100


def test_a_card_with_a_third_of_all_rows_fills_many_files(spark, clustered):
    per_file = spark.read.parquet(clustered).filter("CREDIT_CARD_NO = '4000000000000005'").groupBy(F.input_file_name()).count()
    counts = [n for _, n in rows(per_file)]
    assert len(counts) >= 12 and max(counts) < N / 3 / 6


def test_clustering_keeps_null_partitions_and_empty_tables(spark, transactions):
    path = new_path(spark, "clustered")
    some = transactions.limit(50).withColumn("TXN_MONTH", F.when(F.col("TRANSACTION_ID") % 2 == 0, F.col("TXN_MONTH")))
    some = writers.land(some.withColumn("CREDIT_CARD_NO", F.when(F.col("TRANSACTION_ID") % 3 == 0, F.col("CREDIT_CARD_NO"))), "some")
    writers.overwrite_clustered(some, path, ["CREDIT_CARD_NO"], ["TXN_MONTH"])
    stored = spark.read.parquet(path).withColumn("TXN_MONTH", F.col("TXN_MONTH").cast("string"))
    assert rows(stored.select(*sorted(some.columns))) == rows(some.select(*sorted(some.columns)))
    writers.overwrite_clustered(some.limit(0), path, ["CREDIT_CARD_NO"])
    assert spark.read.parquet(path).count() == 0


# ---- statements ------------------------------------------------------------------------


def requests_for_hot_card(spark, n):
    first = F.date_add(F.lit("2017-12-15").cast("date"), (F.col("id") % 350).cast("int"))
    return spark.range(n).select(
        F.lit("4000000000000005").alias("CREDIT_CARD_NO"), first.alias("first_date"), F.date_add(first, (F.col("id") % 40).cast("int")).alias("last_date")
    )


def test_statements_of_a_hot_card_meet_only_their_months(spark, transactions, clustered):
    asked = requests_for_hot_card(spark, 10_000).distinct()
    n_asked = asked.count()
    stored = readers.read_table(spark, clustered)
    statements = reports.card_statements(asked, stored)
    day = F.to_date("TIMEID", "yyyyMMdd")
    hot = transactions.filter("CREDIT_CARD_NO = '4000000000000005'").select(day.alias("day"))
    per_day = {r["day"]: r["n"] for r in hot.groupBy("day").agg(F.count(F.lit(1)).alias("n")).collect()}
    per_month: dict = {}
    for d, n in per_day.items():
        per_month[d.year, d.month] = per_month.get((d.year, d.month), 0) + n
    wanted = pairs = 0
    for r in asked.collect():
        days = [r["first_date"] + dt.timedelta(i) for i in range((r["last_date"] - r["first_date"]).days + 1)]
        wanted += sum(per_day.get(d, 0) for d in days)
        pairs += sum(per_month.get(m, 0) for m in {(d.year, d.month) for d in days})
    assert statements.filter("outcome = 'found'").count() == wanted

    numbered = asked.withColumn("request", F.monotonically_increasing_id())
    own = reports._asked_transactions(numbered, stored)
    hits = reports._request_months(numbered, reports._card_months(own))
    met = reports.statement_pairs(hits, own).count()
    assert wanted <= met <= pairs
    assert n_asked * hot.count() > 5 * met


def test_statements_read_the_transactions_once(spark, clustered, monkeypatch):
    """Only the table of narrow rows is made from the stored one."""
    plans = []

    def land(df, name):
        plans.append((name, scans_of(df, clustered)))
        return writers.land(df, name)

    monkeypatch.setattr(reports, "land", land)
    statements = reports.card_statements(requests_for_hot_card(spark, 50), readers.read_table(spark, clustered))
    assert [(n, scans) for n, scans in plans if scans] == [("asked-transactions", 1)]
    assert statements.count() > 0 and scans_of(statements, clustered) == 0


def test_statements_for_any_period(spark):
    own = [("a", "20180131", 1.0), ("a", "20180201", 2.0), ("a", "20180228", 3.0), ("a", "20180430", 4.0), ("a", "2018xx01", 9.0), ("b", "nothing", 5.0), ("c", None, 6.0)]
    table = spark.createDataFrame([(c, t, "Bills", v) for c, t, v in own], "CREDIT_CARD_NO string, TIMEID string, TRANSACTION_TYPE string, TRANSACTION_VALUE double")
    d = dt.date
    asked = [
        ("a", d(1, 1, 1), d(9999, 12, 31)), ("a", d(2018, 1, 31), d(2018, 2, 1)), ("a", d(2018, 2, 2), d(2018, 2, 27)), ("a", d(2018, 3, 1), d(2018, 3, 31)),
        ("a", d(2018, 4, 30), d(2018, 4, 1)), ("a", None, d(2018, 4, 30)), ("b", d(2018, 1, 1), d(2018, 12, 31)), ("c", d(2018, 1, 1), d(2018, 12, 31)),
        ("d", d(2018, 1, 1), d(2018, 12, 31)), (None, d(2018, 1, 1), d(2018, 12, 31)), ("a", d(2018, 2, 1), d(2018, 2, 28)), ("a", d(2018, 2, 1), d(2018, 2, 28)),
    ]
    requests = spark.createDataFrame(asked, "CREDIT_CARD_NO string, first_date date, last_date date")
    got = reports.card_statements(requests, table)
    found = {}
    for r in got.collect():
        key = (r["CREDIT_CARD_NO"], r["first_date"], r["last_date"])
        found.setdefault(key, []).append((r["outcome"], r["TRANSACTION_VALUE"], r["card_first_date"], r["card_last_date"]))
    span = (d(2018, 1, 31), d(2018, 4, 30))
    expected = {
        asked[0]: [("found", v, None, None) for v in (1.0, 2.0, 3.0, 4.0)], asked[1]: [("found", v, None, None) for v in (1.0, 2.0)],
        asked[2]: [("outside_range", None, *span)], asked[3]: [("outside_range", None, *span)], asked[4]: [("outside_range", None, *span)], asked[5]: [("outside_range", None, *span)],
        asked[6]: [("outside_range", None, None, None)], asked[7]: [("no_transactions", None, None, None)], asked[8]: [("no_transactions", None, None, None)],
        asked[9]: [("no_transactions", None, None, None)], asked[10]: [("found", v, None, None) for v in (2.0, 3.0)],
    }
    assert {k: sorted(v, key=repr) for k, v in found.items()} == expected
