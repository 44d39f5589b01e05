"""Scans, sinks and projections."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks import feeds
from checks.registry import add, as_feed
from ledgerloom import schemas
from ledgerloom.functions import cleaning as c
from ledgerloom.operators.ranking import top_k
from ledgerloom.plans import loads, reports
from ledgerloom.session import new_path
from ledgerloom.sources import large_json, readers, snapshots, writers


# ---- scans ---------------------------------------------------------------------------


def scan_transactions(d):
    raw = as_feed(d.raw_transactions, schemas.TRANSACTION_FEED)
    path = feeds.write_json_arrays(raw, "transaction-feed")
    return readers.read_json_records(d.spark, path, schemas.TRANSACTION_FEED)


def scan_branches(d):
    raw = as_feed(d.raw_branches, schemas.BRANCH_FEED)
    path = feeds.write_json_arrays(raw, "branch-feed")
    return readers.read_json_records(d.spark, path, schemas.BRANCH_FEED)


def scan_customers(d):
    raw = as_feed(d.raw_customers, schemas.CUSTOMER_FEED)
    path = feeds.write_json_arrays(raw, "customer-feed")
    return readers.read_json_records(d.spark, path, schemas.CUSTOMER_FEED)


add("scan_json_multiline", scan_transactions, "select * from rv_tx")
add(
    "scan_json_multiline_branch",
    scan_branches,
    "select * replace (cast(BRANCH_ZIP as varchar) as BRANCH_ZIP) from rv_branch",
)
add(
    "scan_json_multiline_customer",
    scan_customers,
    "select * replace (cast(CUST_PHONE as varchar) as CUST_PHONE) from rv_cust",
)


def scan_ranges(d):
    """One large file as many tasks read it."""
    raw = as_feed(d.raw_transactions, schemas.TRANSACTION_FEED)
    path = feeds.write_json_arrays(raw, "transaction-feed", compression="none")
    return large_json.read_large_json(d.spark, path, schemas.TRANSACTION_FEED)


add("scan_json_ranges", scan_ranges, "select * from rv_tx")
add(
    "scan_csv_headerless",
    lambda d: readers.read_crosswalk(d.spark, feeds.write_headerless_csv(d.crosswalk, "crosswalk-feed"), feeds.NULL_VALUE),
    "select * from rv_zip",
)
add(
    "scan_records_inferred",
    lambda d: readers.read_records_inferred(d.spark, feeds.write_json_lines(d.loans, "loan-feed")),
    "select * from rv_loan",
)
add(
    "scan_records_typed",
    lambda d: readers.read_loans(d.spark, feeds.write_json_lines(d.loans, "loan-feed")),
    "select * from rv_loan",
)

STATE_NAME_CASE = """
    case code when 'NY' then 'New York' when 'NJ' then 'New Jersey' when 'CT' then 'Connecticut'
    when 'MA' then 'Massachusetts' when 'VT' then 'Vermont' when 'TX' then 'Texas' when 'PA' then 'Pennsylvania'
    when 'FL' then 'Florida' when 'GA' then 'Georgia' when 'IL' then 'Illinois' when 'OH' then 'Ohio'
    when 'MI' then 'Michigan' when 'WA' then 'Washington' when 'OR' then 'Oregon' when 'AZ' then 'Arizona'
    when 'CO' then 'Colorado' when 'NC' then 'North Carolina' when 'VA' then 'Virginia' when 'MN' then 'Minnesota'
    when 'WI' then 'Wisconsin' when 'IN' then 'Indiana' when 'TN' then 'Tennessee' when 'MO' then 'Missouri'
    when 'CA' then 'California' end"""
FEATURES_SQL = f"""
    select distinct {STATE_NAME_CASE} as name
    from (select CUST_STATE as code from rv_cust union select BRANCH_STATE from rv_branch) as codes
    where code not in ('PR', 'DC')"""


def scan_features(d):
    path = feeds.write_state_features(d.raw_customers, d.raw_branches, "state-features")
    return readers.read_feature_names(d.spark, path)


add("scan_geojson_names", scan_features, FEATURES_SQL)


def scan_stored_month(d):
    path = new_path(d.spark, "transactions")
    monthly = d.transactions.withColumn("TXN_MONTH", F.substring("TIMEID", 1, 6))
    writers.overwrite_rows(monthly, path, ["TXN_MONTH"])
    stored = readers.read_table(d.spark, path, ["TRANSACTION_ID", "TIMEID", "TRANSACTION_VALUE", "TXN_MONTH"])
    return reports.in_month(stored, 1998, 3).drop("TXN_MONTH")


add(
    "scan_table",
    scan_stored_month,
    "select TRANSACTION_ID, TIMEID, TRANSACTION_VALUE from dated where year(txn_date) = 1998 and month(txn_date) = 3",
)

# ---- sinks ---------------------------------------------------------------------------


def append_twice(d):
    path = new_path(d.spark, "branches")
    writers.append_rows(d.branches, path)
    writers.append_rows(d.branches, path)
    return readers.read_table(d.spark, path)


def append_once(d):
    path = new_path(d.spark, "branches")
    writers.append_rows(d.branches, path)
    writers.append_new_rows(d.branches, path, ["BRANCH_CODE"])
    return readers.read_table(d.spark, path)


def append_batches(d):
    """Two batches, one of them again, as after a failure."""
    path = new_path(d.spark, "branches")
    for batch, odd in (("a", 0), ("b", 1), ("a", 0)):
        snapshots.append_batch(d.branches.filter(F.col("BRANCH_CODE") % 2 == odd), path, batch)
    return snapshots.read_snapshot(d.spark, path)


def overwrite_twice(d):
    path = new_path(d.spark, "transactions")
    writers.overwrite_rows(d.transactions, path)
    writers.overwrite_rows(d.transactions, path)
    return readers.read_table(d.spark, path)


def _loan_table(d, feed: str):
    table = f"loan_application_{uuid.uuid4().hex}"
    loads.load_loans(d.spark, feed, table, new_path(d.spark, table))
    return table


def typed_table(d):
    table = f"loan_application_{uuid.uuid4().hex}"
    path = new_path(d.spark, table)
    writers.ensure_table(d.spark, table, schemas.LOAN, path)
    writers.ensure_table(d.spark, table, schemas.LOAN, path)
    writers.append_to_table(d.loans, table)
    return d.spark.table(table)


add("sink_append", append_twice, "select * from br union all select * from br")
add("sink_append_new_rows", append_once, "select * from br")
add("sink_append_batch", append_batches, "select * from br")
add("sink_overwrite", overwrite_twice, "select * from tx")
add("ensure_table", typed_table, "select * from rv_loan")
add(
    "preview",
    lambda d: top_k(d.raw_branches, 10, F.col("BRANCH_CODE")),
    "select * from rv_branch order by BRANCH_CODE limit 10",
)

# ---- projections ---------------------------------------------------------------------

add(
    "project_reorder",
    lambda d: d.raw_branches.select(*schemas.BRANCH_FEED.names),
    "select BRANCH_CODE, BRANCH_NAME, BRANCH_STREET, BRANCH_CITY, BRANCH_STATE, BRANCH_ZIP, BRANCH_PHONE, LAST_UPDATED"
    " from rv_branch",
)
add(
    "project_drop",
    lambda d: d.raw_transactions.drop("YEAR", "MONTH", "DAY"),
    "select * exclude (YEAR, MONTH, DAY) from rv_tx",
)
add(
    "project_rename",
    lambda d: d.raw_branches.withColumn("FORMATTED", c.format_ten_digit_phone(F.col("BRANCH_PHONE")))
    .drop("BRANCH_PHONE")
    .withColumnRenamed("FORMATTED", "BRANCH_PHONE")
    .select("BRANCH_CODE", "BRANCH_PHONE"),
    "select BRANCH_CODE, BRANCH_PHONE from br",
)


def qualified(d):
    original, updated = d.raw_customers.alias("original"), loads.standardise_customers(d.raw_customers).alias("updated")
    return original.join(updated, F.col("original.SSN") == F.col("updated.SSN")).select(
        "original.SSN",
        F.col("original.LAST_NAME").alias("delivered_name"),
        F.col("updated.LAST_NAME").alias("stored_name"),
        *[f"updated.{name}" for name in ("FULL_STREET_ADDRESS", "MIDDLE_NAME")],
    )


add(
    "project_alias_qualified",
    qualified,
    """select o.SSN, o.LAST_NAME as delivered_name, u.LAST_NAME as stored_name, u.FULL_STREET_ADDRESS, u.MIDDLE_NAME
       from rv_cust o join cust_all u on o.SSN = u.SSN""",
)
add(
    "project_with_column",
    lambda d: d.raw_transactions.withColumns(
        {"MONTH": c.pad_date_part(F.col("MONTH")), "ID_TEXT": c.as_text(F.col("TRANSACTION_ID"))}
    ),
    """select * replace (lpad(cast(MONTH as varchar), 2, '0') as MONTH), cast(TRANSACTION_ID as varchar) as ID_TEXT
       from rv_tx""",
)

# ---- load jobs -----------------------------------------------------------------------


def load_loans(d):
    return d.spark.table(_loan_table(d, feeds.write_json_lines(d.loans, "loan-feed")))


def loaded(name):
    """The whole job: feed in, table out, and the table read back."""
    return lambda d: readers.read_table(d.spark, d.load(name))


add("etl_branch", loaded("branches"), "select * from br")
add("etl_transactions", lambda d: loaded("transactions")(d).drop("TXN_MONTH"), "select * from tx")
add("etl_customers", loaded("customers"), "select * from cu")
add("etl_loans", load_loans, "select * from rv_loan")
