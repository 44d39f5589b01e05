"""Filters, scalar functions and validators."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from checks.registry import add
from ledgerloom.functions import cleaning as c
from ledgerloom.functions import labels, validation
from ledgerloom.functions import predicates as p
from ledgerloom.plans import loads, reports

CARD = "4" + "42".zfill(15)

# ---- filters -------------------------------------------------------------------------

add(
    "filter_point",
    lambda d: reports.customer_of_card(d.stored("customers"), CARD),
    f"select * from cu where CREDIT_CARD_NO = '{CARD}'",
)
add(
    "filter_conjunction",
    lambda d: d.loans.filter(p.all_equal(Gender="Male", Married="Yes")),
    "select * from rv_loan where Gender = 'Male' and Married = 'Yes'",
)
add(
    "filter_date_between",
    lambda d: reports.card_transactions(d.stored("transactions"), CARD, dt.date(1997, 1, 1), dt.date(1999, 12, 31)),
    f"""select cast(txn_date as varchar) as transaction_date, TRANSACTION_TYPE, TRANSACTION_VALUE, TIMEID
        from dated where CREDIT_CARD_NO = '{CARD}' and txn_date between date '1997-01-01' and date '1999-12-31'
        order by TIMEID desc""",
)
add(
    "filter_year_month",
    lambda d: reports.in_month(d.stored("transactions"), 1998, 2).drop("TXN_MONTH"),
    "select * exclude (txn_date) from dated where year(txn_date) = 1998 and month(txn_date) = 2",
)
add(
    "filter_null_or_blank",
    lambda d: d.raw_customers.filter(p.is_missing(F.col("MIDDLE_NAME")) | p.is_missing(F.col("CUST_PHONE"))).select(
        "SSN", "MIDDLE_NAME", "CUST_PHONE"
    ),
    """select SSN, MIDDLE_NAME, CUST_PHONE from rv_cust
       where MIDDLE_NAME is null or MIDDLE_NAME = '' or CUST_PHONE is null or cast(CUST_PHONE as varchar) = ''""",
)
add(
    "filter_invalid_email",
    lambda d: d.raw_customers.filter(p.is_unexpected_email(F.col("CUST_EMAIL"))).select("SSN", "CUST_EMAIL"),
    r"""select SSN, CUST_EMAIL from rv_cust
        where not regexp_matches(CUST_EMAIL, '^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.example\.com$')""",
)


def not_title_case(d):
    named = d.raw_customers.withColumn("LAST_NAME", c.fix_mc_surname(F.col("LAST_NAME")))
    odd = p.is_not_title_case(F.col("FIRST_NAME")) | p.is_not_title_case(F.col("LAST_NAME"))
    return named.filter(odd).select("SSN", "FIRST_NAME", "LAST_NAME")


add(
    "filter_not_title_case",
    not_title_case,
    """select SSN, FIRST_NAME, LAST_NAME from cust_all
       where not regexp_matches(FIRST_NAME, '^[A-Z][a-z]+$') or not regexp_matches(LAST_NAME, '^[A-Z][a-z]+$')""",
)
add(
    "filter_prefix",
    lambda d: d.raw_customers.filter(F.col("LAST_NAME").startswith("Mc")).select("SSN", "LAST_NAME"),
    "select SSN, LAST_NAME from rv_cust where starts_with(LAST_NAME, 'Mc')",
)
add(
    "filter_in_list",
    lambda d: d.raw_branches.filter(F.col("BRANCH_STATE").isin(c.NORTH_EAST_STATES)).select(
        "BRANCH_CODE", "BRANCH_STATE", "BRANCH_ZIP"
    ),
    """select BRANCH_CODE, BRANCH_STATE, BRANCH_ZIP from rv_branch
       where BRANCH_STATE in ('NJ', 'CT', 'NH', 'MA', 'VT', 'RI', 'ME')""",
)
add(
    "filter_length",
    lambda d: d.raw_branches.filter(F.length(c.as_text(F.col("BRANCH_ZIP"))) < 5).select(
        "BRANCH_CITY", "BRANCH_STATE", "BRANCH_ZIP"
    ),
    "select BRANCH_CITY, BRANCH_STATE, BRANCH_ZIP from rv_branch where length(cast(BRANCH_ZIP as varchar)) < 5",
)
add(
    "filter_ci_equals",
    lambda d: d.transactions.filter(p.equals_ignoring_case(F.col("TRANSACTION_TYPE"), "healthcare")),
    "select * from tx where lower(TRANSACTION_TYPE) = 'healthcare'",
)


def cross_column(d):
    original, updated = d.raw_customers.alias("original"), loads.disambiguate_emails(d.raw_customers).alias("updated")
    same = [F.col(f"original.{key}") == F.col(f"updated.{key}") for key in ("SSN", "CREDIT_CARD_NO")]
    differ = F.col("original.CUST_EMAIL") != F.col("updated.CUST_EMAIL")
    return original.join(updated, same).filter(differ).select(
        "original.SSN", "original.CUST_EMAIL", F.col("updated.CUST_EMAIL").alias("generated_email")
    )


add(
    "filter_cross_column_ne",
    cross_column,
    "select SSN, OLD_EMAIL as CUST_EMAIL, CUST_EMAIL as generated_email from cust_email where OLD_EMAIL <> CUST_EMAIL",
)

# ---- scalar functions ----------------------------------------------------------------

add(
    "fn_split_camel_city",
    lambda d: d.raw_branches.select("BRANCH_CODE", c.split_joined_words(F.col("BRANCH_CITY")).alias("city")),
    "select BRANCH_CODE, BRANCH_CITY as city from br",
)
add(
    "fn_zip_leading_zero",
    lambda d: d.raw_branches.select(
        "BRANCH_CODE", c.restore_zip_zero(F.col("BRANCH_ZIP"), F.col("BRANCH_STATE")).alias("zip")
    ),
    "select BRANCH_CODE, BRANCH_ZIP as zip from br",
)
add(
    "fn_lpad_date_part",
    lambda d: d.raw_transactions.select(
        "TRANSACTION_ID",
        c.pad_date_part(F.col("DAY")).alias("day_text"),
        c.pad_date_part(F.col("MONTH")).alias("month_text"),
    ),
    """select TRANSACTION_ID, lpad(cast(DAY as varchar), 2, '0') as day_text,
              lpad(cast(MONTH as varchar), 2, '0') as month_text from rv_tx""",
)
add(
    "fn_time_id",
    lambda d: d.raw_transactions.select(
        "TRANSACTION_ID", c.time_id(F.col("YEAR"), F.col("MONTH"), F.col("DAY")).alias("time_id")
    ),
    "select TRANSACTION_ID, TIMEID as time_id from tx",
)
add(
    "fn_time_id_to_date",
    lambda d: d.transactions.select("TRANSACTION_ID", c.time_id_to_date(F.col("TIMEID")).alias("txn_day")),
    "select TRANSACTION_ID, cast(txn_date as varchar) as txn_day from dated",
)


def date_fields(d):
    dated = d.transactions.withColumn("day", c.time_id_to_date(F.col("TIMEID")))
    return dated.select(
        "TRANSACTION_ID",
        F.year("day").cast("long").alias("y"),
        F.month("day").cast("long").alias("m"),
        F.dayofmonth("day").cast("long").alias("d"),
    )


add(
    "fn_year_month_day",
    date_fields,
    "select TRANSACTION_ID, year(txn_date) as y, month(txn_date) as m, day(txn_date) as d from dated",
)
add(
    "fn_month_substring",
    lambda d: d.transactions.select("TRANSACTION_ID", c.time_id_month(F.col("TIMEID")).alias("mon")),
    "select TRANSACTION_ID, substr(TIMEID, 5, 2) as mon from tx",
)
add(
    "fn_parse_iso_timestamp",
    lambda d: d.raw_branches.select("BRANCH_CODE", c.parse_iso_timestamp(F.col("LAST_UPDATED")).alias("updated")),
    "select BRANCH_CODE, LAST_UPDATED as updated from br",
)
add(
    "fn_full_address",
    lambda d: d.raw_customers.select("SSN", c.street_address(F.col("APT_NO"), F.col("STREET_NAME")).alias("address")),
    "select SSN, APT_NO || ' ' || STREET_NAME as address from rv_cust",
)
add(
    "fn_first_area_code",
    lambda d: d.crosswalk.select("CUST_ZIP", c.first_area_code(F.col("AREA_CODE")).alias("area_code")),
    "select CUST_ZIP, split_part(AREA_CODE, '/', 1) as area_code from rv_zip",
)
add(
    "fn_phone_from_parts",
    lambda d: loads.complete_phones(d.raw_customers, d.crosswalk).select("SSN", F.col("CUST_PHONE").alias("phone")),
    "select SSN, CUST_PHONE as phone from cust_all",
)
add(
    "fn_lower_middle_name",
    lambda d: d.raw_customers.select("SSN", c.lower_name(F.col("MIDDLE_NAME")).alias("middle")),
    "select SSN, lower(MIDDLE_NAME) as middle from rv_cust",
)
add(
    "fn_initials",
    lambda d: d.raw_customers.select(
        "SSN", c.initial(F.col("FIRST_NAME")).alias("first_initial"), c.initial(F.col("MIDDLE_NAME")).alias("middle_initial")
    ),
    "select SSN, substr(FIRST_NAME, 1, 1) as first_initial, substr(MIDDLE_NAME, 1, 1) as middle_initial from rv_cust",
)
add(
    "fn_coalesce",
    lambda d: d.raw_customers.select(
        "SSN",
        F.coalesce(
            c.generated_email(F.col("FIRST_NAME"), F.col("MIDDLE_NAME"), F.col("LAST_NAME")), F.col("CUST_EMAIL")
        ).alias("email"),
    ),
    """select SSN, coalesce(substr(FIRST_NAME, 1, 1) || substr(MIDDLE_NAME, 1, 1) || LAST_NAME || '@example.com',
                            CUST_EMAIL) as email from rv_cust""",
)
add(
    "fn_currency_label",
    lambda d: d.transactions.select(
        "TRANSACTION_ID",
        "CUST_SSN",
        labels.currency_label(F.col("TRANSACTION_VALUE").cast("decimal(18,2)")).alias("label"),
        labels.currency_label(F.col("TRANSACTION_VALUE").cast("decimal(18,2)") - 20000, 0).alias("whole_label"),
    ),
    """select TRANSACTION_ID, CUST_SSN,
              '$' || format('{:,}', cast(floor(cast(TRANSACTION_VALUE as decimal(18, 2))) as bigint)) || '.'
                  || lpad(cast(cast(cast(TRANSACTION_VALUE as decimal(18, 2)) * 100 as bigint) % 100 as varchar), 2, '0')
              as label,
              '$' || case when whole = 0 and TRANSACTION_VALUE < 20000 then '-' else '' end || format('{:,}', whole) as whole_label
       from (select *, cast(round_even(cast(TRANSACTION_VALUE as decimal(18, 2)) - 20000, 0) as bigint) as whole from tx) as t""",
)
add(
    "fn_thousands_label",
    lambda d: d.transactions.select(
        "TRANSACTION_ID", "CUST_SSN", labels.thousands_label(F.col("TRANSACTION_ID")).alias("label"),
        labels.thousands_label(F.col("TRANSACTION_VALUE") - 20000).alias("value_label"),
    ),
    """select TRANSACTION_ID, CUST_SSN, format('{:,}', TRANSACTION_ID) as label,
              format('{:,}', cast(trunc(TRANSACTION_VALUE - 20000) as bigint)) as value_label from tx""",
)
add(
    "fn_length",
    lambda d: d.raw_customers.select(
        "SSN", F.length("LAST_NAME").cast("long").alias("name_length"), F.length("MIDDLE_NAME").cast("long").alias("middle_length")
    ),
    "select SSN, length(LAST_NAME) as name_length, length(MIDDLE_NAME) as middle_length from rv_cust",
)

# ---- former row functions and validators ---------------------------------------------

add(
    "udf_format_phone",
    lambda d: d.raw_branches.select("BRANCH_CODE", c.format_ten_digit_phone(F.col("BRANCH_PHONE")).alias("phone")),
    "select BRANCH_CODE, BRANCH_PHONE as phone from br",
)
add(
    "udf_fix_mc_name",
    lambda d: d.raw_customers.select("SSN", c.fix_mc_surname(F.col("LAST_NAME")).alias("surname")),
    "select SSN, LAST_NAME as surname from cust_all",
)

REASON_SQL = r"""
    case when FIELD not in ('FIRST_NAME', 'LAST_NAME', 'FULL_STREET_ADDRESS', 'CUST_CITY', 'CUST_STATE', 'CUST_COUNTRY',
                            'CUST_ZIP', 'CUST_PHONE', 'CUST_EMAIL') then 'Invalid field: ' || FIELD
         when not case
             when FIELD in ('FIRST_NAME', 'LAST_NAME', 'CUST_CITY', 'CUST_COUNTRY')
                 then length(NEW_VALUE) <= 50 and regexp_full_match(replace(NEW_VALUE, ' ', ''), '\p{L}+')
             when FIELD = 'FULL_STREET_ADDRESS' then length(NEW_VALUE) <= 100
             when FIELD = 'CUST_STATE' then length(NEW_VALUE) = 2 and regexp_full_match(NEW_VALUE, '\p{L}+')
             when FIELD = 'CUST_ZIP' then regexp_full_match(NEW_VALUE, '[0-9]{5}')
             when FIELD = 'CUST_PHONE' then regexp_full_match(NEW_VALUE, '\([0-9]{3}\)[0-9]{3}-[0-9]{4}')
             when FIELD = 'CUST_EMAIL' then regexp_full_match(NEW_VALUE, '[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}')
             end then 'Invalid value for ' || FIELD end"""

add(
    "validate_field_change",
    lambda d: d.requests.withColumn("reason", validation.rejection_reason(F.col("FIELD"), F.col("NEW_VALUE"))),
    f"select *, {REASON_SQL} as reason from rv_req",
)
add(
    "validate_request_params",
    lambda d: d.view("rv_param").select(
        "*",
        validation.is_zip_parameter(F.col("ZIP_CODE")).alias("zip_ok"),
        validation.is_month_parameter(F.col("PERIOD")).alias("period_ok"),
    ),
    r"""select *, regexp_full_match(ZIP_CODE, '[0-9]{5}') as zip_ok,
               PERIOD like '%/____' and try_cast(split_part(PERIOD, '/', 1) as int) between 1 and 12
               and try_cast(split_part(PERIOD, '/', 2) as int) >= 1 as period_ok from rv_param""",
)
