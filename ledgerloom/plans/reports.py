"""Reports over the loaded tables.

Money is summed as ``decimal(18,2)``, so totals do not depend on the order of rows, and
returned as a double. Joins come after the first aggregation wherever the result
allows it: a card or branch with very many rows is then one row per day or month.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.functions.cleaning import time_id_month, time_id_to_date
from ledgerloom.functions.labels import currency_label, month_name, state_name, thousands_label
from ledgerloom.functions.predicates import all_equal, equals_ignoring_case
from ledgerloom.operators.hotkeys import broadcast_if_at_most
from ledgerloom.operators.joins import features_with_counts
from ledgerloom.operators.ranking import top_k, top_k_with_ties
from ledgerloom.sources.buckets import parts_bucketed
from ledgerloom.sources.writers import land

BRANCH_BROADCAST_ROWS = 100_000
STATEMENT_CARDS = 100_000
HOT_TOTALS = 1_000_000


def exact_sum(amount: str | Column) -> Column:
    column = F.col(amount) if isinstance(amount, str) else amount
    return F.sum(column.cast("decimal(18,2)"))


def as_amount(total: str) -> Column:
    return F.col(total).cast("double")


def percent(part: Column, whole: Column) -> Column:
    return F.round(F.lit(100.0).cast("double") * part / whole, 1)


# ---- periods -------------------------------------------------------------------------


def in_period(transactions: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """Transactions from ``first`` to ``last``, both included.

    ``TIMEID`` sorts as a date does, so the range is on the stored column and reaches
    the Parquet scan; text in that range that is no date is dropped. On a table
    partitioned by ``TXN_MONTH`` whole months are skipped.
    """
    kept = transactions.filter(F.col("TIMEID").between(f"{first:%Y%m%d}", f"{last:%Y%m%d}"))
    if "TXN_MONTH" in transactions.columns:
        kept = kept.filter(F.col("TXN_MONTH").between(f"{first:%Y%m}", f"{last:%Y%m}"))
    return kept.filter(time_id_to_date(F.col("TIMEID")).isNotNull())


def in_month(transactions: DataFrame, year: int, month: int) -> DataFrame:
    first = dt.date(year, month, 1)
    next_month = dt.date(year + month // 12, month % 12 + 1, 1)
    return in_period(transactions, first, next_month - dt.timedelta(days=1))


# ---- counts and rankings -------------------------------------------------------------


def count_by(df: DataFrame, key: str, name: str) -> DataFrame:
    """Non-null values of ``key`` for each value of it; the null group therefore counts 0."""
    return df.groupBy(key).agg(F.count(key).alias(name))


def transactions_by_type(transactions: DataFrame) -> DataFrame:
    return count_by(transactions, "TRANSACTION_TYPE", "transactions").orderBy(
        F.desc("transactions"), "TRANSACTION_TYPE"
    )


def axis_bounds(counts: DataFrame, metric: str) -> DataFrame:
    """Lower and upper limit of a chart axis: a tenth below the least, a tenth above the most."""
    return counts.agg((F.min(metric) * F.lit(0.9)).alias("axis_low"), (F.max(metric) * F.lit(1.1)).alias("axis_high"))


def customers_by_state(customers: DataFrame) -> DataFrame:
    return count_by(customers, "CUST_STATE", "customers").orderBy(F.desc("customers"), "CUST_STATE")


def top_states(customers: DataFrame, k: int = 10) -> DataFrame:
    return top_k(count_by(customers, "CUST_STATE", "customers"), k, F.desc("customers"), "CUST_STATE")


def top_states_with_ties(customers: DataFrame, k: int = 10) -> DataFrame:
    return top_k_with_ties(count_by(customers, "CUST_STATE", "customers"), k, "customers")


def _ranked_total(df: DataFrame, key: str, name: str, k: int) -> DataFrame:
    totals = df.groupBy(key).agg(exact_sum("TRANSACTION_VALUE").alias(name))
    return top_k(totals, k, F.desc(name), key).withColumn(name, as_amount(name))


def top_customers_by_value(transactions: DataFrame, k: int = 10) -> DataFrame:
    return _ranked_total(transactions, "CUST_SSN", "total_value", k)


def top_customers_by_count(transactions: DataFrame, k: int = 10) -> DataFrame:
    counts = transactions.groupBy("CUST_SSN").agg(F.count("TRANSACTION_VALUE").alias("transactions"))
    return top_k(counts, k, F.desc("transactions"), "CUST_SSN")


def top_branches_for_type(transactions: DataFrame, kind: str = "healthcare", k: int = 5) -> DataFrame:
    wanted = transactions.filter(equals_ignoring_case(F.col("TRANSACTION_TYPE"), kind))
    return _ranked_total(wanted, "BRANCH_CODE", "total_value", k)


def monthly_totals(transactions: DataFrame) -> DataFrame:
    """Value and number of transactions for each month of the year, over all years."""
    return (
        transactions.withColumn("month", time_id_month(F.col("TIMEID")))
        .groupBy("month")
        .agg(exact_sum("TRANSACTION_VALUE").alias("total_value"), F.count("TRANSACTION_VALUE").alias("transactions"))
    )


def top_months_by_value(transactions: DataFrame, k: int = 3) -> DataFrame:
    best = top_k(monthly_totals(transactions), k, F.desc("total_value"), "month")
    return best.select("month", as_amount("total_value").alias("total_value"))


def top_months_by_count(transactions: DataFrame, k: int = 3) -> DataFrame:
    return top_k(monthly_totals(transactions), k, F.desc("transactions"), "month").select("month", "transactions")


def report_top_months(transactions: DataFrame, k: int = 3) -> DataFrame:
    """Top months by value and by number, named and labelled.

    Both rankings carry both measures, so they share one aggregation of the transactions.
    """
    totals = monthly_totals(transactions)

    def ranking(measure: str, label: Column) -> DataFrame:
        return top_k(totals, k, F.desc(measure), "month").select(
            F.lit(measure).alias("measure"),
            month_name(F.col("month")).alias("month_name"),
            as_amount("total_value").alias("total_value"),
            "transactions",
            label.alias("label"),
        )

    by_value = ranking("total_value", currency_label(F.col("total_value")))
    by_count = ranking("transactions", thousands_label(F.col("transactions")))
    return by_value.unionByName(by_count)


def report_state_map(customers: DataFrame, features: DataFrame) -> DataFrame:
    """Customers of each map feature, joined on the full state name."""
    named = count_by(customers, "CUST_STATE", "customers").withColumn("name", state_name(F.col("CUST_STATE")))
    return features_with_counts(features, named, "name", "customers")


# ---- loans ---------------------------------------------------------------------------


def loans_by_status(loans: DataFrame) -> DataFrame:
    return loans.groupBy("Application_Status").agg(F.count(F.lit(1)).alias("applications"))


def loans_by_status_where(loans: DataFrame, **wanted: str) -> DataFrame:
    return loans_by_status(loans.filter(all_equal(**wanted)))


COHORTS = {
    "self_employed": {"Self_Employed": "Yes"},
    "married_male": {"Gender": "Male", "Married": "Yes"},
}


def _status_counts(loans: DataFrame) -> DataFrame:
    members = {name: F.count_if(all_equal(**wanted)) for name, wanted in COHORTS.items()}
    return loans.groupBy("Application_Status").agg(
        F.count(F.lit(1)).alias("all_applicants"), *[count.alias(name) for name, count in members.items()]
    )


def _with_shares(counts: DataFrame, cohorts: list[str]) -> DataFrame:
    """Add the percentage of each status in each cohort; the window sees one row for each status."""
    everything = Window.partitionBy()
    return counts.select("*", *[percent(F.col(n), F.sum(n).over(everything)).alias(f"{n}_share") for n in cohorts])


def status_shares(loans: DataFrame) -> DataFrame:
    """Applications and percentage of each status in each cohort, from one pass over the loans."""
    cohorts = ["all_applicants", *COHORTS]
    counts = _with_shares(_status_counts(loans), cohorts)
    rows = [
        F.struct(F.lit(name).alias("cohort"), F.col(name).alias("applications"), F.col(f"{name}_share").alias("share"))
        for name in cohorts
    ]
    return counts.select("Application_Status", F.inline(F.array(*rows))).filter(F.col("applications") > 0)


def approval_comparison(loans: DataFrame) -> DataFrame:
    """Self-employed next to all applicants (who include them), from one pass over the loans."""
    cohorts = ["self_employed", "all_applicants"]
    counts = _with_shares(_status_counts(loans), cohorts)
    return counts.select("Application_Status", *cohorts, *[f"{name}_share" for name in cohorts])


# ---- cards, bills and statements -----------------------------------------------------


HOLDER = ["SSN", "FIRST_NAME", "LAST_NAME", "CREDIT_CARD_NO"]


def _spending_by_day(located: DataFrame) -> DataFrame:
    """Total by card, branch ZIP and day of transactions that carry their ``BRANCH_ZIP``.

    Grouped by the date itself: all ``TIMEID`` texts that are no date are one group.
    """
    dated = located.withColumn("transaction_date", time_id_to_date(F.col("TIMEID")))
    return dated.groupBy("CREDIT_CARD_NO", "BRANCH_ZIP", "transaction_date").agg(exact_sum("TRANSACTION_VALUE").alias("total"))


def _daily_columns(df: DataFrame) -> DataFrame:
    return df.select(
        *HOLDER,
        "BRANCH_ZIP",
        "transaction_date",
        F.dayofmonth("transaction_date").alias("transaction_day"),
        as_amount("total").alias("total_transaction_value"),
    )


def daily_totals(transactions: DataFrame, customers: DataFrame, branches: DataFrame) -> DataFrame:
    """Spending by customer, branch ZIP and day over the whole table.

    Customers are grouped on their own side rather than after the join: nothing then
    relies on the partitioning by card, and AQE is free to split a card with very many
    rows. Copies of a customer row count once each, as in a plain join.
    """
    located = transactions.join(branches.select("BRANCH_CODE", "BRANCH_ZIP"), "BRANCH_CODE")
    holders = customers.groupBy(*HOLDER).agg(F.count(F.lit(1)).alias("copies"))
    spending = _spending_by_day(located).join(holders, "CREDIT_CARD_NO")
    return _daily_columns(spending.withColumn("total", F.col("total") * F.col("copies")))


def daily_totals_for_zip(
    transactions: DataFrame, customers: DataFrame, branches: DataFrame, zip_code: str, year: int, month: int
) -> DataFrame:
    """Spending at the branches of one ZIP in one month, newest first.

    The branches of one ZIP are few as a rule; they are broadcast only after a count
    says so, which drops other branches' transactions before any shuffle.
    """
    here = branches.select("BRANCH_CODE", "BRANCH_ZIP").filter(F.col("BRANCH_ZIP") == zip_code)
    located = in_month(transactions, year, month).join(
        broadcast_if_at_most(here, BRANCH_BROADCAST_ROWS), "BRANCH_CODE"
    )
    spending = _spending_by_day(located).join(customers.select(*HOLDER), "CREDIT_CARD_NO")
    totals = spending.groupBy(*HOLDER, "BRANCH_ZIP", "transaction_date").agg(F.sum("total").alias("total"))
    newest_first = [F.desc("transaction_date"), F.desc("transaction_day"), "CREDIT_CARD_NO", "SSN"]
    return _daily_columns(totals).orderBy(*newest_first)


def card_count(transactions: DataFrame, card: str) -> DataFrame:
    """Number of transactions of one card; zero tells that it has none."""
    return transactions.filter(F.col("CREDIT_CARD_NO") == card).agg(F.count(F.lit(1)).alias("transactions"))


def cards_with_transactions(customers: DataFrame, transactions: DataFrame) -> DataFrame:
    """The same question for every customer at once."""
    counts = transactions.groupBy("CREDIT_CARD_NO").agg(F.count(F.lit(1)).alias("transactions"))
    return customers.select("CREDIT_CARD_NO").join(counts, "CREDIT_CARD_NO", "left").fillna(0, ["transactions"])


def customer_of_card(customers: DataFrame, card: str) -> DataFrame:
    return customers.filter(F.col("CREDIT_CARD_NO") == card)


def monthly_bill(transactions: DataFrame, customers: DataFrame, card: str, month: int, year: int) -> DataFrame:
    """Amount billed to one card in one month; no row when there was no transaction."""
    own = in_month(transactions.filter(F.col("CREDIT_CARD_NO") == card), year, month)
    total = own.groupBy("CREDIT_CARD_NO").agg(exact_sum("TRANSACTION_VALUE").alias("total"))
    holders = customers.select("CREDIT_CARD_NO", "SSN", "FIRST_NAME", "LAST_NAME")
    billed = total.join(holders, "CREDIT_CARD_NO").groupBy("SSN", "FIRST_NAME", "LAST_NAME")
    return billed.agg(F.sum("total").cast("double").alias("total_bill"))


def monthly_bills(transactions: DataFrame, customers: DataFrame) -> DataFrame:
    """The bill of every card for every month.

    Both sides are added up before they meet, so nothing is grouped behind the join: equal holders of a card are one row with their number.
    """
    dated = transactions.withColumn("bill_month", F.trunc(time_id_to_date(F.col("TIMEID")), "MM"))
    totals = dated.groupBy("CREDIT_CARD_NO", "bill_month").agg(exact_sum("TRANSACTION_VALUE").alias("total"))
    holders = customers.groupBy(*HOLDER).agg(F.count(F.lit(1)).alias("copies"))
    bills = totals.join(holders, "CREDIT_CARD_NO").withColumn("total", F.col("total") * F.col("copies"))
    return bills.select("CREDIT_CARD_NO", "bill_month", "SSN", "FIRST_NAME", "LAST_NAME", as_amount("total").alias("total_bill"))


def monthly_bills_bucketed(spark: SparkSession, transactions: str, customers: str, buckets: int) -> DataFrame:
    """The same from tables stored by card (see ``buckets``): neither the transactions nor the customers are shuffled.

    Both sides are added up before they meet: a bucket holds whole groups, and the sums of the hot cards, a row for
    each of their months, are broadcast after a count.
    """
    month = F.trunc(time_id_to_date(F.col("TIMEID")), "MM").alias("bill_month")

    def totals(rows: DataFrame) -> DataFrame:
        return rows.groupBy("CREDIT_CARD_NO", month).agg(exact_sum("TRANSACTION_VALUE").alias("total"))

    def holders(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*HOLDER).agg(F.count(F.lit(1)).alias("copies"))

    def bills(total: DataFrame, holder: DataFrame) -> DataFrame:
        billed = total.join(holder, "CREDIT_CARD_NO").withColumn("total", F.col("total") * F.col("copies"))
        return billed.select("CREDIT_CARD_NO", "bill_month", "SSN", "FIRST_NAME", "LAST_NAME", as_amount("total").alias("total_bill"))

    (spent, spent_hot), (owned, owned_hot) = parts_bucketed(spark, transactions), parts_bucketed(spark, customers)
    total, total_hot = totals(spent), broadcast_if_at_most(totals(spent_hot), HOT_TOTALS)
    holder, holder_hot = holders(owned), broadcast_if_at_most(holders(owned_hot), HOT_TOTALS)
    whole = bills(total, holder).unionByName(bills(total_hot, holder))
    return whole.unionByName(bills(total, holder_hot)).unionByName(bills(total_hot, holder_hot))


def card_date_range(transactions: DataFrame, card: str) -> DataFrame:
    """First and last transaction date of one card; nulls when it has none."""
    day = time_id_to_date(F.col("TIMEID"))
    own = transactions.filter(F.col("CREDIT_CARD_NO") == card)
    return own.agg(F.min(day).alias("first_date"), F.max(day).alias("last_date"))


def card_date_ranges(transactions: DataFrame) -> DataFrame:
    """First and last transaction date of every card."""
    day = time_id_to_date(F.col("TIMEID"))
    return transactions.groupBy("CREDIT_CARD_NO").agg(F.min(day).alias("first_date"), F.max(day).alias("last_date"))


def card_transactions(transactions: DataFrame, card: str, first: dt.date, last: dt.date) -> DataFrame:
    """Transactions of one card in a period, newest first."""
    own = in_period(transactions.filter(F.col("CREDIT_CARD_NO") == card), first, last)
    return own.select(
        time_id_to_date(F.col("TIMEID")).alias("transaction_date"),
        "TRANSACTION_TYPE",
        "TRANSACTION_VALUE",
        "TIMEID",
    ).orderBy(F.desc("TIMEID"), "TRANSACTION_TYPE", "TRANSACTION_VALUE")


# ---- statements for many requests ----------------------------------------------------


def _asked_transactions(asked: DataFrame, transactions: DataFrame) -> DataFrame:
    """The dated-or-not transactions of the cards asked for: narrow rows with their month and date.

    Few cards are broadcast, after a count, so that other cards' rows are dropped in the scan stage.
    """
    own = transactions.filter(F.col("TIMEID").isNotNull()).select(
        "CREDIT_CARD_NO",
        F.substring("TIMEID", 1, 6).alias("month"),
        time_id_to_date(F.col("TIMEID")).alias("day"),
        "TRANSACTION_TYPE",
        "TRANSACTION_VALUE",
    )
    cards = asked.select("CREDIT_CARD_NO").distinct()
    few = cards.limit(STATEMENT_CARDS + 1).count() <= STATEMENT_CARDS
    return own.join(F.broadcast(cards), "CREDIT_CARD_NO", "left_semi") if few else own


def _card_months(own: DataFrame) -> DataFrame:
    """One row for each card and month: its first and last date, and a bit for each day with a transaction.

    A fixed-size aggregate, so a card's month is one row per map task before the shuffle, however much it holds.
    """
    bit = F.expr("shiftleft(1, dayofmonth(day) - 1)")
    grouped = own.groupBy("CREDIT_CARD_NO", "month")
    return grouped.agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.bit_or(bit).alias("days"))


def _request_months(asked: DataFrame, card_months: DataFrame) -> DataFrame:
    """The months in which a request has a transaction; ``whole`` where every date of the month is asked for.

    Requests are cut to the time their card was used, so a request for all times has no more months than its card.
    """
    spans = card_months.groupBy("CREDIT_CARD_NO").agg(F.min("first_day").alias("lo"), F.max("last_day").alias("hi"))
    dated = asked.filter(F.col("first_date").isNotNull() & F.col("last_date").isNotNull())
    cut = dated.join(spans, "CREDIT_CARD_NO").select(
        *asked.columns, F.greatest("first_date", "lo").alias("from_day"), F.least("last_date", "hi").alias("to_day")
    )
    cut = cut.filter(F.col("from_day") <= F.col("to_day"))
    starts = F.sequence(F.trunc("from_day", "MM"), F.trunc("to_day", "MM"), F.expr("interval 1 month"))
    months = cut.select("*", F.explode(starts).alias("start")).select(
        "*",
        F.date_format("start", "yyyyMM").alias("month"),
        F.when(F.trunc("from_day", "MM") == F.col("start"), F.dayofmonth("from_day")).otherwise(1).alias("first"),
        F.when(F.trunc("to_day", "MM") == F.col("start"), F.dayofmonth("to_day")).otherwise(31).alias("last"),
    )
    used = months.join(card_months.select("CREDIT_CARD_NO", "month", "days"), ["CREDIT_CARD_NO", "month"])
    asked_days = F.expr("shiftleft(1L, last) - shiftleft(1L, first - 1)")
    hits = used.filter(F.col("days").bitwiseAND(asked_days) != 0)
    whole = (F.col("first") == 1) & (F.col("last") == 31)
    return hits.select("request", "CREDIT_CARD_NO", "first_date", "last_date", "month", "from_day", "to_day", whole.alias("whole"))


def statement_pairs(request_months: DataFrame, own: DataFrame) -> DataFrame:
    """Requests next to their card's transactions of the months they ask for, and of no others."""
    return request_months.join(own, ["CREDIT_CARD_NO", "month"])


def card_statements(requests: DataFrame, transactions: DataFrame) -> DataFrame:
    """Statements for a table of requests (``CREDIT_CARD_NO``, ``first_date``, ``last_date``).

    Each distinct request gets its transactions in the period with ``outcome`` ``found``; or
    else one row with ``no_transactions`` if the card has none at all, or ``outside_range``
    together with the card's first and last date.

    A range join by month buckets: requests are laid out over the months in which their card has a transaction for them,
    and joined on card and month, so that a date is compared only in the first and last month of a request. The transactions are
    read once, and their narrow rows written; which months and days a card has comes from one grouped pass over
    these. Both sides of the large join are written tables, so AQE may split a card with very many requests or transactions.
    """
    distinct = requests.select("CREDIT_CARD_NO", "first_date", "last_date").distinct()
    asked = land(distinct.withColumn("request", F.monotonically_increasing_id()), "statement-requests")
    own = land(_asked_transactions(asked, transactions), "asked-transactions")
    card_months = land(_card_months(own), "card-months")
    hits = land(_request_months(asked, card_months), "request-months")

    dated = own.filter(F.col("day").isNotNull())
    inside = F.col("whole") | F.col("day").between(F.col("from_day"), F.col("to_day"))
    found = statement_pairs(hits, dated).filter(inside).select(
        "CREDIT_CARD_NO",
        "first_date",
        "last_date",
        F.lit("found").alias("outcome"),
        F.col("day").alias("transaction_date"),
        "TRANSACTION_TYPE",
        "TRANSACTION_VALUE",
        F.lit(None).cast("date").alias("card_first_date"),
        F.lit(None).cast("date").alias("card_last_date"),
    )

    spans = card_months.groupBy("CREDIT_CARD_NO").agg(F.min("first_day").alias("lo"), F.max("last_day").alias("hi"), F.lit(True).alias("used"))
    left = asked.join(hits.select("request").distinct(), "request", "left_anti").join(spans, "CREDIT_CARD_NO", "left")
    empty = left.select(
        "CREDIT_CARD_NO",
        "first_date",
        "last_date",
        F.when(F.col("used"), "outside_range").otherwise("no_transactions").alias("outcome"),
        F.lit(None).cast("date").alias("transaction_date"),
        F.lit(None).cast("string").alias("TRANSACTION_TYPE"),
        F.lit(None).cast("double").alias("TRANSACTION_VALUE"),
        F.col("lo").alias("card_first_date"),
        F.col("hi").alias("card_last_date"),
    )
    return found.unionByName(empty)
