"""Load jobs: raw feed in, cleaned target table out.

The ``clean_*`` functions are plain DataFrame transformations; the ``load_*`` functions
add the read and the write.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import schemas
from ledgerloom.functions import cleaning as c
from ledgerloom.operators.dedup import one_row_per_key
from ledgerloom.operators.joins import with_area_code
from ledgerloom.operators.ranking import rank_exceeds_one
from ledgerloom.sources import readers, snapshots, writers
from ledgerloom.sources.large_json import read_large_json


def clean_branches(raw: DataFrame) -> DataFrame:
    """Narrow: runs in the scan stage."""
    return raw.withColumns(
        {
            "BRANCH_ZIP": c.restore_zip_zero(F.col("BRANCH_ZIP"), F.col("BRANCH_STATE")),
            "BRANCH_PHONE": c.format_ten_digit_phone(F.col("BRANCH_PHONE")),
            "BRANCH_CITY": c.split_joined_words(F.col("BRANCH_CITY")),
            "LAST_UPDATED": c.parse_iso_timestamp(F.col("LAST_UPDATED")),
        }
    ).select(*schemas.BRANCH.names)


def clean_transactions(raw: DataFrame) -> DataFrame:
    """Narrow: runs in the scan stage."""
    dated = raw.withColumn("TIMEID", c.time_id(F.col("YEAR"), F.col("MONTH"), F.col("DAY")))
    return dated.drop("YEAR", "MONTH", "DAY").select(*schemas.TRANSACTION.names)


def disambiguate_emails(customers: DataFrame) -> DataFrame:
    """A generated address for customers who share one, except those first by middle name.

    The generated address uses the names as delivered. Two customers who also share the
    middle name get the same address again. Where a name is missing the old one stays.
    """
    generated = c.generated_email(F.col("FIRST_NAME"), F.col("MIDDLE_NAME"), F.col("LAST_NAME"))
    flagged = rank_exceeds_one(customers, "CUST_EMAIL", "MIDDLE_NAME", "__shared")
    email = F.when(F.col("__shared"), F.coalesce(generated, F.col("CUST_EMAIL"))).otherwise(F.col("CUST_EMAIL"))
    return flagged.withColumn("CUST_EMAIL", email).select(*customers.columns)


def standardise_customers(customers: DataFrame) -> DataFrame:
    """Names, address and time stamp; narrow."""
    return customers.withColumns(
        {
            "LAST_NAME": c.fix_mc_surname(F.col("LAST_NAME")),
            "MIDDLE_NAME": c.lower_name(F.col("MIDDLE_NAME")),
            "FULL_STREET_ADDRESS": c.street_address(F.col("APT_NO"), F.col("STREET_NAME")),
            "LAST_UPDATED": c.parse_iso_timestamp(F.col("LAST_UPDATED")),
        }
    ).drop("APT_NO", "STREET_NAME")


def complete_phones(customers: DataFrame, crosswalk: DataFrame, keep_unmatched: bool = False) -> DataFrame:
    """Seven-digit numbers with the area code of the ZIP.

    Without an area code the phone becomes null, or stays as delivered with
    ``keep_unmatched``.
    """
    phone = c.phone_with_area_code(F.col("AREA_CODE"), F.col("CUST_PHONE"))
    if keep_unmatched:
        phone = F.coalesce(phone, c.as_text(F.col("CUST_PHONE")))
    return with_area_code(customers, crosswalk).withColumn("CUST_PHONE", phone).drop("AREA_CODE")


def clean_customers(raw: DataFrame, crosswalk: DataFrame, keep_unmatched: bool = False) -> DataFrame:
    """The customer table: one row for each credit card."""
    cities = raw.withColumn("CUST_CITY", c.split_joined_words(F.col("CUST_CITY")))
    named = standardise_customers(disambiguate_emails(cities))
    reachable = complete_phones(named, crosswalk, keep_unmatched).select(*schemas.CUSTOMER.names)
    return one_row_per_key(reachable, "CREDIT_CARD_NO")


def load_branches(
    spark: SparkSession, feed: str, target: str, multiline: bool = True, only_new: bool = False, batch: str | None = None
) -> None:
    """Append the cleaned branch feed; with ``only_new``, just branches not stored yet.

    With ``batch``, the name of this delivery, the target is a table under manifests (see ``snapshots``) and a rerun replaces what
    the same delivery brought before.
    """
    branches = clean_branches(readers.read_json_records(spark, feed, schemas.BRANCH_FEED, multiline))
    if batch is not None:
        snapshots.append_batch(branches, target, batch)
    elif only_new:
        writers.append_new_rows(branches, target, ["BRANCH_CODE"])
    else:
        writers.append_rows(branches, target)


def load_transactions(spark: SparkSession, feed: str, target: str, multiline: bool = True, ranges: bool = False) -> None:
    """Replace the transaction table: a partition for each year and month, in it files by ranges of the card.

    Date reports skip whole months, reports on one card nearly all row groups of a month. With ``ranges`` a feed of few
    large files is read by as many tasks as it has ranges.
    """
    if ranges:
        raw = read_large_json(spark, feed, schemas.TRANSACTION_FEED)
    else:
        raw = readers.read_json_records(spark, feed, schemas.TRANSACTION_FEED, multiline)
    monthly = clean_transactions(raw).withColumn("TXN_MONTH", F.substring("TIMEID", 1, 6))
    writers.overwrite_clustered(monthly, target, ["CREDIT_CARD_NO", "TIMEID", "TRANSACTION_ID"], ["TXN_MONTH"])


def load_customers(
    spark: SparkSession, feed: str, crosswalk_feed: str, target: str, multiline: bool = True, null_value: str = ""
) -> None:
    """Replace the customer table, in files by ranges of the card; ``null_value`` is what the crosswalk feed writes for null.

    Resolving shared addresses reads the customers more than once, so the feed is landed
    as Parquet first.
    """
    raw = readers.read_json_records(spark, feed, schemas.CUSTOMER_FEED, multiline)
    crosswalk = readers.read_crosswalk(spark, crosswalk_feed, null_value)
    landed = writers.land(raw, "customer-feed")
    writers.overwrite_clustered(clean_customers(landed, crosswalk), target, ["CREDIT_CARD_NO"])


def load_loans(
    spark: SparkSession,
    feed: str,
    table: str,
    path: str | None = None,
    multiline: bool = False,
    only_new: bool = False,
) -> None:
    """Append the loan feed to its typed table, creating the table first if needed."""
    loans = readers.read_loans(spark, feed, multiline)
    writers.ensure_table(spark, table, schemas.LOAN, path)
    if only_new:
        loans = writers.new_rows(loans, spark.table(table), ["Application_ID"])
    writers.append_to_table(loans, table)
