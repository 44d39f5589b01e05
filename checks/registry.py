"""Registration of queries: a Spark callable and, where SQL can say it, the SQL to check it by."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import feeds
from checks.role_views import VIEWS, frame, view_sql
from ledgerloom import schemas
from ledgerloom.plans import loads
from ledgerloom.session import new_path
from ledgerloom.sources import readers, snapshots
from ledgerloom.sources.buckets import write_bucketed


# Tables that a load job has written, by application, data and name: inputs of reports, made once per session.
_STAGED: dict[tuple[str, str, str], str] = {}


def as_feed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """A role view in the column types of its feed."""
    return df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])


class BankData:
    """The role views of one scale factor, raw and cleaned."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark = spark
        self.sf_dir = sf_dir

    def view(self, name: str) -> DataFrame:
        return frame(self.spark, self.sf_dir, name)

    @cached_property
    def raw_transactions(self) -> DataFrame:
        return self.view("rv_tx")

    @cached_property
    def transactions(self) -> DataFrame:
        return loads.clean_transactions(self.raw_transactions)

    @cached_property
    def raw_branches(self) -> DataFrame:
        return self.view("rv_branch")

    @cached_property
    def branches(self) -> DataFrame:
        return loads.clean_branches(self.raw_branches)

    @cached_property
    def raw_customers(self) -> DataFrame:
        return self.view("rv_cust")

    @cached_property
    def crosswalk(self) -> DataFrame:
        return self.view("rv_zip")

    @cached_property
    def customers(self) -> DataFrame:
        return loads.clean_customers(self.raw_customers, self.crosswalk)

    def load(self, name: str) -> str:
        """Run a load job from a feed in its own format, and return the path of the table."""
        path = new_path(self.spark, name)
        if name == "branches":
            feed = feeds.write_json_arrays(as_feed(self.raw_branches, schemas.BRANCH_FEED), "branch-feed")
            loads.load_branches(self.spark, feed, path)
        elif name == "transactions":
            feed = feeds.write_json_arrays(as_feed(self.raw_transactions, schemas.TRANSACTION_FEED), "transaction-feed")
            loads.load_transactions(self.spark, feed, path)
        else:
            feed = feeds.write_json_arrays(as_feed(self.raw_customers, schemas.CUSTOMER_FEED), "customer-feed")
            zips = feeds.write_headerless_csv(self.crosswalk, "crosswalk-feed")
            loads.load_customers(self.spark, feed, zips, path, null_value=feeds.NULL_VALUE)
        return path

    def stored(self, name: str) -> DataFrame:
        """The table of a load job as reports and updates find it."""
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        if key not in _STAGED:
            _STAGED[key] = self.load(name)
        return readers.read_table(self.spark, _STAGED[key])

    def bucketed(self, name: str, buckets: int) -> str:
        """The same table stored by card, in the catalog of the session."""
        key = (self.spark.sparkContext.applicationId, self.sf_dir, f"{name} in {buckets} buckets")
        if key not in _STAGED:
            table = f"{name}_{uuid.uuid4().hex}"
            write_bucketed(self.stored(name), table, new_path(self.spark, table), "CREDIT_CARD_NO", buckets)
            _STAGED[key] = table
        return _STAGED[key]

    def snapshot(self, name: str) -> str:
        """The same table under manifests, as a copy of the caller's own: no file of it is copied."""
        key = (self.spark.sparkContext.applicationId, self.sf_dir, f"{name} snapshot")
        if key not in _STAGED:
            self.stored(name)
            _STAGED[key] = new_path(self.spark, f"{name}-snapshot")
            snapshots.adopt(self.spark, _STAGED[(*key[:2], name)], _STAGED[key])
        own = new_path(self.spark, f"{name}-copy")
        snapshots.clone(self.spark, _STAGED[key], own)
        return own

    @cached_property
    def loans(self) -> DataFrame:
        return self.view("rv_loan")

    @cached_property
    def requests(self) -> DataFrame:
        """Change requests, which arrive as a file of one record per line."""
        path = feeds.write_json_lines(self.view("rv_req"), "change-requests")
        return readers.read_json_records(self.spark, path, schemas.CHANGE_REQUEST, multiline=False)


# Cleaned tables in SQL, written independently of the DataFrame code.
CLEANED = {
    "tx": """
        select TRANSACTION_ID, CREDIT_CARD_NO,
               cast(YEAR as varchar) || lpad(cast(MONTH as varchar), 2, '0') || lpad(cast(DAY as varchar), 2, '0') as TIMEID,
               CUST_SSN, BRANCH_CODE, TRANSACTION_TYPE, TRANSACTION_VALUE
        from rv_tx""",
    "dated": "select *, cast(strptime(TIMEID, '%Y%m%d') as date) as txn_date from tx",
    "br": """
        select BRANCH_CODE, BRANCH_NAME, BRANCH_STREET,
               regexp_replace(BRANCH_CITY, '([a-z])([A-Z])', '\\1 \\2', 'g') as BRANCH_CITY, BRANCH_STATE,
               case when length(cast(BRANCH_ZIP as varchar)) = 4
                     and BRANCH_STATE in ('NJ', 'CT', 'NH', 'MA', 'VT', 'RI', 'ME')
                    then '0' || cast(BRANCH_ZIP as varchar) else cast(BRANCH_ZIP as varchar) end as BRANCH_ZIP,
               case when length(BRANCH_PHONE) = 10
                    then '(' || substr(BRANCH_PHONE, 1, 3) || ')' || substr(BRANCH_PHONE, 4, 3) || '-' || substr(BRANCH_PHONE, 7, 4)
                    else 'Invalid phone number length' end as BRANCH_PHONE,
               strftime(cast(LAST_UPDATED as timestamptz) at time zone 'UTC', '%Y-%m-%d %H:%M:%S') as LAST_UPDATED
        from rv_branch""",
    "cust_ranked": """
        select *, rank() over (partition by CUST_EMAIL order by MIDDLE_NAME nulls first) as email_rank from rv_cust""",
    "cust_email": """
        select * exclude (CUST_EMAIL, CUST_CITY, email_rank), CUST_EMAIL as OLD_EMAIL,
               regexp_replace(CUST_CITY, '([a-z])([A-Z])', '\\1 \\2', 'g') as CUST_CITY,
               coalesce(case when email_rank > 1
                             then substr(FIRST_NAME, 1, 1) || substr(MIDDLE_NAME, 1, 1) || LAST_NAME || '@example.com' end,
                        CUST_EMAIL) as CUST_EMAIL
        from cust_ranked""",
    "zip_area": """
        select CUST_ZIP as area_zip, split_part(min(AREA_CODE), '/', 1) as area_code from rv_zip where trim(CUST_ZIP) <> '' group by CUST_ZIP""",
    "cust_all": """
        select SSN, FIRST_NAME, lower(MIDDLE_NAME) as MIDDLE_NAME,
               case when starts_with(LAST_NAME, 'Mc') and length(LAST_NAME) >= 3
                    then 'Mc' || upper(substr(LAST_NAME, 3, 1)) || lower(substr(LAST_NAME, 4)) else LAST_NAME end as LAST_NAME,
               CREDIT_CARD_NO, APT_NO || ' ' || STREET_NAME as FULL_STREET_ADDRESS,
               CUST_CITY, CUST_STATE, CUST_COUNTRY, CUST_ZIP,
               '(' || area_code || ')' || substr(cast(CUST_PHONE as varchar), 1, 3) || '-'
                   || substr(cast(CUST_PHONE as varchar), 4, 4) as CUST_PHONE,
               CUST_EMAIL,
               strftime(cast(LAST_UPDATED as timestamptz) at time zone 'UTC', '%Y-%m-%d %H:%M:%S') as LAST_UPDATED
        from cust_email left join zip_area on CUST_ZIP = area_zip""",
    "cu": """
        select * from cust_all
        qualify row_number() over (partition by CREDIT_CARD_NO order by SSN nulls first, FIRST_NAME nulls first,
            MIDDLE_NAME nulls first, LAST_NAME nulls first, FULL_STREET_ADDRESS nulls first, CUST_CITY nulls first,
            CUST_STATE nulls first, CUST_COUNTRY nulls first, CUST_ZIP nulls first, CUST_PHONE nulls first,
            CUST_EMAIL nulls first, LAST_UPDATED nulls first) = 1""",
    "by_type": "select TRANSACTION_TYPE, count(TRANSACTION_TYPE) as transactions from tx group by TRANSACTION_TYPE",
    "by_state": "select CUST_STATE, count(CUST_STATE) as customers from rv_cust group by CUST_STATE",
    "by_month": """
        select substr(TIMEID, 5, 2) as month, cast(sum(cast(TRANSACTION_VALUE as decimal(18, 2))) as double) as total_value,
               count(TRANSACTION_VALUE) as transactions
        from tx group by 1""",
}


def with_views(sql: str) -> str:
    """Put the views a statement needs in front of it."""
    known = {**{name: view_sql(name) for name in VIEWS}, **CLEANED}
    needed: list[str] = []

    def visit(statement: str) -> None:
        for name in known:
            if name not in needed and re.search(rf"\b{name}\b", statement):
                visit(known[name])
                if name not in needed:
                    needed.append(name)

    visit(sql)
    if not needed:
        return sql.strip()
    prefix = ",\n".join(f"{name} as ({known[name].strip()})" for name in needed)
    body = sql.strip()
    if body.lower().startswith("with "):
        return f"with {prefix},\n{body[5:]}"
    return f"with {prefix}\n{body}"


def comparable(df: DataFrame) -> DataFrame:
    """Dates, time stamps and decimals in a form both engines print alike."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        columns.append(column.alias(field.name))
    return df.select(*columns)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def add(name: str, build: Callable[[BankData], DataFrame], sql: str | None = None) -> None:
    if name in QUERIES:
        raise ValueError(f"query {name} is registered twice")

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(build(BankData(spark, sf_dir)))

    QUERIES[name] = run
    if sql is not None:
        SQL[name] = with_views(sql)
