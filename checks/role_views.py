"""Bank data derived from the given Parquet tables.

Each view is one FROM clause and one formula per column. The formulas use only functions
that Spark and DuckDB share, so the same text serves both: ``frame`` evaluates it
in Spark, ``view_sql`` puts it in front of the SQL a query is checked against.
"""

from __future__ import annotations

import os
import re

from pyspark.sql import DataFrame, SparkSession


def pick(index: str, *values: str) -> str:
    """The value at ``index``, counted from 0."""
    cases = " ".join(f"when {i} then '{v}'" for i, v in enumerate(values))
    return f"(case {index} {cases} end)"


def text(expr: str) -> str:
    return f"cast({expr} as varchar(20))"


def card(key: str) -> str:
    return f"concat('4', lpad({text(key)}, 15, '0'))"


def stamp(key: str) -> str:
    return f"concat('2018-04-', lpad(cast(1 + {key} % 28 as varchar(2)), 2, '0'), 'T16:51:47.000-04:00')"


# 25 codes for the 25 nation keys; PR and DC are not among the fifty states.
STATES = (
    "NY NJ CT MA VT TX PA FL GA IL OH MI WA OR AZ CO NC VA MN WI IN TN MO PR DC".split()
)

_first = pick("c_custkey % 7", "Alec", "Etta", "Wilber", "Eugenio", "Amy", "Beth", "Carl")
_middle = f"(case when c_custkey % 11 = 0 then null else {pick('c_custkey % 3', 'Wm', 'Brendan', 'Ezequiel')} end)"
_last_stem = pick("c_custkey % 5", "Mcdonald", "Hooper", "Holman", "Mckinney", "Dunham")
_last_tail = (
    "(case when c_custkey % 13 = 0 then '' "
    "else substring('abcdefghijklmnopqrstuvwxyz', cast(1 + c_custkey % 26 as int), 1) end)"
)
_last = f"concat({_last_stem}, {_last_tail})"
_street = "'Main Street North'"

_requested_field = pick(
    "o_orderkey % 10",
    "FIRST_NAME",
    "LAST_NAME",
    "FULL_STREET_ADDRESS",
    "CUST_CITY",
    "CUST_STATE",
    "CUST_COUNTRY",
    "CUST_ZIP",
    "CUST_PHONE",
    "CUST_EMAIL",
    "CREDIT_CARD_NO",
)
_valid_value = (
    "(case o_orderkey % 10 when 0 then 'Maria Jose' when 1 then 'Zoe' when 2 then '12 Elm Street' "
    "when 3 then 'New York' when 4 then 'NY' when 5 then 'Canada' "
    "when 6 then cast(20000 + o_orderkey % 7000 as varchar(5)) when 7 then '(201)555-0100' "
    "when 8 then concat('c', cast(o_custkey as varchar(20)), '@example.org') else 'x' end)"
)
_invalid_value = (
    "(case o_orderkey % 10 when 0 then 'R2D2' when 1 then '  ' when 2 then repeat('long street ', 9) "
    "when 3 then 'City-7' when 4 then 'TEX' when 5 then repeat('country ', 7) "
    "when 6 then '1234' when 7 then '2015550100' when 8 then 'no at sign' else 'y' end)"
)
_equal_value = (
    f"(case o_orderkey % 10 when 0 then {_first} when 1 then 'Same' "
    f"when 2 then concat({text('c_custkey % 900')}, ' ', {_street}) when 3 then 'Natchez' "
    f"when 4 then {pick('c_nationkey % 25', *STATES)} when 5 then 'United States' "
    "when 6 then cast(10000 + c_custkey % 400 as varchar(5)) else 'z' end)"
)

VIEWS: dict[str, tuple[str, dict[str, str]]] = {
    # card transactions; TRANSACTION_ID repeats
    "rv_tx": (
        "lineitem join orders on l_orderkey = o_orderkey",
        {
            "TRANSACTION_ID": "l_orderkey * 10 + l_linenumber",
            "CREDIT_CARD_NO": card("o_custkey"),
            "DAY": "cast(day(l_shipdate) as int)",
            "MONTH": "cast(month(l_shipdate) as int)",
            "YEAR": "cast(year(l_shipdate) as int)",
            "CUST_SSN": "123450000 + o_custkey",
            "BRANCH_CODE": "l_suppkey",
            "TRANSACTION_TYPE": "(case concat(l_returnflag, l_linestatus) "
            "when 'RF' then 'Healthcare' when 'RO' then 'Bills' when 'AF' then 'Gas' "
            "when 'AO' then 'Grocery' when 'NF' then 'Education' when 'NO' then 'Test' end)",
            "TRANSACTION_VALUE": "l_extendedprice",
        },
    ),
    # branches; four-digit ZIPs in the north-east, joined city names, some short phones
    "rv_branch": (
        "supplier",
        {
            "BRANCH_CODE": "s_suppkey",
            "BRANCH_NAME": "'Example Bank'",
            "BRANCH_STREET": f"concat({text('s_suppkey')}, ' Main St')",
            "BRANCH_CITY": pick("s_suppkey % 4", "LakeTown", "ElPaso", "Dover", "KingofPrussia"),
            "BRANCH_STATE": pick("s_suppkey % 8", "NJ", "CT", "MA", "VT", "TX", "CA", "NY", "PA"),
            "BRANCH_ZIP": "(case when s_suppkey % 8 < 4 then 7000 + s_suppkey % 40 else 70000 + s_suppkey % 40 end)",
            "BRANCH_PHONE": "(case when s_suppkey % 10 = 0 then '123456789' "
            f"else {text('(200 + s_suppkey % 7) * 10000000 + 4560000 + s_suppkey')} end)",
            "LAST_UPDATED": stamp("s_suppkey"),
        },
    ),
    # customers; null middle names, Mc names, shared e-mails with ties, SSNs of two people, blank and odd ZIPs
    "rv_cust": (
        "customer",
        {
            "CREDIT_CARD_NO": card("c_custkey"),
            "SSN": "123450000 + c_custkey - (case when c_custkey % 50 = 1 then 1 else 0 end)",
            "CUST_EMAIL": f"concat(substring({_first}, 1, 1), {_last}, '@example.com')",
            "CUST_PHONE": "1000000 + (c_custkey * 7919) % 9000000",
            "FIRST_NAME": _first,
            "MIDDLE_NAME": _middle,
            "LAST_NAME": _last,
            "APT_NO": text("c_custkey % 900"),
            "STREET_NAME": _street,
            "CUST_CITY": pick("c_custkey % 3", "ElPaso", "Natchez", "KingofPrussia"),
            "CUST_ZIP": "(case when c_custkey % 97 = 0 then '' when c_custkey % 89 = 0 then '501-1' "
            "else cast(10000 + c_custkey % 400 as varchar(5)) end)",
            "CUST_STATE": pick("c_nationkey % 25", *STATES),
            "CUST_COUNTRY": "'United States'",
            "LAST_UPDATED": stamp("c_custkey"),
        },
    ),
    # ZIP crosswalk; several rows for each ZIP, some ZIPs of customers missing
    "rv_zip": (
        "part",
        {
            "CUST_ZIP": "(case when p_partkey % 59 = 0 then ' ' when p_partkey % 53 = 0 then '501-1' "
            "when p_partkey % 61 = 0 then '' else cast(10000 + p_partkey % 350 as varchar(5)) end)",
            "CUST_STATE": pick("p_partkey % 25", *STATES),
            "CUST_CITY": "concat('City', cast(p_partkey % 60 as varchar(5)))",
            "CUST_COUNTY": "concat('County', cast(p_partkey % 30 as varchar(5)))",
            "AREA_CODE": "(case p_partkey % 3 when 0 then '201/551' "
            "when 1 then cast(300 + p_partkey % 50 as varchar(3)) else '914' end)",
            "TIME_ZONE": "cast(5 + p_partkey % 4 as varchar(2))",
            "DST": pick("p_partkey % 2", "Y", "N"),
        },
    ),
    # loan applications
    "rv_loan": (
        "orders join customer on o_custkey = c_custkey",
        {
            "Application_ID": f"concat('LP', {text('o_orderkey')})",
            "Application_Status": "(case when o_orderstatus in ('F', 'O') then 'Y' else 'N' end)",
            "Credit_History": "o_orderkey % 2",
            "Dependents": pick("o_orderkey % 4", "0", "1", "2", "3+"),
            "Education": pick("o_custkey % 2", "Graduate", "Not Graduate"),
            "Gender": pick("o_custkey % 2", "Male", "Female"),
            "Income": "(case when c_acctbal < 3000 then 'low' when c_acctbal < 7000 then 'medium' else 'high' end)",
            "Married": "(case when o_custkey % 3 = 0 then 'No' else 'Yes' end)",
            "Property_Area": pick("o_orderkey % 3", "Rural", "Semiurban", "Urban"),
            "Self_Employed": "(case when o_orderpriority = '1-URGENT' then 'Yes' else 'No' end)",
        },
    ),
    # change requests; valid, invalid, equal to the stored value, for an unknown card or none, or without a number
    "rv_req": (
        "orders join customer on o_custkey = c_custkey",
        {
            "REQUEST_ID": "(case when o_orderkey % 43 = 0 then null else o_orderkey end)",
            "CREDIT_CARD_NO": "(case when o_orderkey % 41 = 0 then null when floor(o_orderkey / 10) % 4 = 3 "
            f"then concat('9', lpad({text('o_custkey')}, 15, '0')) else {card('o_custkey')} end)",
            "FIELD": _requested_field,
            "NEW_VALUE": f"(case floor(o_orderkey / 10) % 4 when 1 then {_invalid_value} "
            f"when 2 then {_equal_value} else {_valid_value} end)",
        },
    ),
    # report parameters typed by users
    "rv_param": (
        "orders",
        {
            "PARAM_ID": "o_orderkey",
            "ZIP_CODE": "cast(o_orderkey % 200000 as varchar(10))",
            "PERIOD": "concat(cast(o_orderkey % 15 as varchar(2)), "
            "(case when o_orderkey % 7 = 0 then '-' else '/' end), cast(o_orderkey % 3000 as varchar(4)))",
        },
    ),
    # statement requests: a 60-day period for every customer, unknown cards among them
    "rv_stmt": (
        "customer",
        {
            "CREDIT_CARD_NO": f"(case when c_custkey % 9 = 0 then concat('9', lpad({text('c_custkey')}, 15, '0')) "
            f"else {card('c_custkey')} end)",
            "first_date": "cast(concat(cast(1995 + c_custkey % 7 as varchar(4)), '-0', "
            "cast(1 + c_custkey % 9 as varchar(1)), '-01') as date)",
            "last_date": "cast(concat(cast(1995 + c_custkey % 7 as varchar(4)), '-0', "
            "cast(1 + c_custkey % 9 as varchar(1)), '-28') as date)",
        },
    ),
}

# The columns the views use; with a schema given, opening a table reads no file.
TABLES = {
    "lineitem": "l_orderkey bigint, l_suppkey bigint, l_linenumber int, l_extendedprice double, l_returnflag string, "
    "l_linestatus string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderpriority string",
    "customer": "c_custkey bigint, c_nationkey int, c_acctbal double",
    "supplier": "s_suppkey bigint",
    "part": "p_partkey bigint",
}
JOIN = re.compile(r"(\w+) join (\w+) on (\w+) = (\w+)")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(os.path.join(sf_dir, f"{name}.parquet"))


def frame(spark: SparkSession, sf_dir: str, view: str) -> DataFrame:
    """A role view as a DataFrame: scans and joins here, formulas as column expressions.

    Orders and customers grow with the data, so they are joined as they have to be on a
    large table, by sort-merge, even where a small copy could be broadcast.
    """
    source, columns = VIEWS[view]
    join = JOIN.fullmatch(source)
    if join:
        left, right, left_key, right_key = join.groups()
        df, other = _table(spark, sf_dir, left), _table(spark, sf_dir, right)
        df = df.join(other.hint("merge"), df[left_key] == other[right_key])
    else:
        df = _table(spark, sf_dir, source)
    return df.selectExpr(*[f"{formula} as {name}" for name, formula in columns.items()])


def view_sql(view: str) -> str:
    source, columns = VIEWS[view]
    return "select " + ", ".join(f"{formula} as {name}" for name, formula in columns.items()) + f" from {source}"
