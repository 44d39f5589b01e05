"""Aggregations, profiles and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.queries_columns import CARD
from checks.queries_joins import BUCKETS, FANOUT_SQL, match_counts
from checks.registry import add
from ledgerloom.operators import dedup, profile
from ledgerloom.plans import reports

MONEY = "cast(sum(cast(TRANSACTION_VALUE as decimal(18, 2))) as double)"
ZIP, YEAR, MONTH = "07003", 1998, 3

# ---- counts --------------------------------------------------------------------------

add(
    "agg_count_rows",
    lambda d: profile.row_totals(d.transactions),
    "select count(*) as row_count from tx",
)
add(
    "agg_count_exists",
    lambda d: reports.card_count(d.stored("transactions"), CARD),
    f"select count(*) as transactions from tx where CREDIT_CARD_NO = '{CARD}'",
)
add(
    "agg_count_exists_all",
    lambda d: reports.cards_with_transactions(d.raw_customers, d.transactions),
    """select c.CREDIT_CARD_NO, coalesce(n.transactions, 0) as transactions from rv_cust c
       left join (select CREDIT_CARD_NO, count(*) as transactions from tx group by 1) as n
       on c.CREDIT_CARD_NO = n.CREDIT_CARD_NO""",
)
add("agg_count_by_type", lambda d: reports.transactions_by_type(d.transactions), "select * from by_type")
add("agg_count_by_state", lambda d: reports.customers_by_state(d.raw_customers), "select * from by_state")
add(
    "agg_sum_by_customer",
    lambda d: reports.top_customers_by_value(d.transactions),
    f"select CUST_SSN, {MONEY} as total_value from tx group by 1 order by 2 desc, 1 limit 10",
)
add(
    "agg_count_by_customer",
    lambda d: reports.top_customers_by_count(d.transactions),
    "select CUST_SSN, count(TRANSACTION_VALUE) as transactions from tx group by 1 order by 2 desc, 1 limit 10",
)
add(
    "agg_sum_by_month",
    lambda d: reports.top_months_by_value(d.transactions),
    "select month, total_value from by_month order by 2 desc, 1 limit 3",
)
add(
    "agg_count_by_month",
    lambda d: reports.top_months_by_count(d.transactions),
    "select month, transactions from by_month order by 2 desc, 1 limit 3",
)
add(
    "agg_healthcare_by_branch",
    lambda d: reports.top_branches_for_type(d.transactions),
    f"""select BRANCH_CODE, {MONEY} as total_value from tx where lower(TRANSACTION_TYPE) = 'healthcare'
        group by 1 order by 2 desc, 1 limit 5""",
)

# ---- loans ---------------------------------------------------------------------------

STATUS_SQL = "select Application_Status, count(*) as applications from rv_loan"

add(
    "agg_status_self_employed",
    lambda d: reports.loans_by_status_where(d.loans, Self_Employed="Yes"),
    f"{STATUS_SQL} where Self_Employed = 'Yes' group by 1",
)
add("agg_status_all", lambda d: reports.loans_by_status(d.loans), f"{STATUS_SQL} group by 1")
add(
    "agg_status_married_male",
    lambda d: reports.loans_by_status_where(d.loans, Gender="Male", Married="Yes").orderBy(
        F.desc("applications"), "Application_Status"
    ),
    f"{STATUS_SQL} where Gender = 'Male' and Married = 'Yes' group by 1 order by 2 desc",
)


def _share_sql(cohort: str, condition: str) -> str:
    return f"""
        select '{cohort}' as cohort, Application_Status, count(*) as applications,
               round(cast(100 as double) * count(*) / sum(count(*)) over (), 1) as share
        from rv_loan where {condition} group by Application_Status"""


add(
    "agg_percent_share",
    lambda d: reports.status_shares(d.loans),
    " union all ".join(
        [
            _share_sql("all_applicants", "true"),
            _share_sql("self_employed", "Self_Employed = 'Yes'"),
            _share_sql("married_male", "Gender = 'Male' and Married = 'Yes'"),
        ]
    ),
)
add(
    "agg_approval_comparison",
    lambda d: reports.approval_comparison(d.loans),
    """select Application_Status, self_employed, all_applicants,
              round(cast(100 as double) * self_employed / sum(self_employed) over (), 1) as self_employed_share,
              round(cast(100 as double) * all_applicants / sum(all_applicants) over (), 1) as all_applicants_share
       from (select Application_Status, count(*) filter (where Self_Employed = 'Yes') as self_employed,
                    count(*) as all_applicants from rv_loan group by 1) as n""",
)

# ---- daily totals, bills, statements -------------------------------------------------

DAILY_SQL = f"""
    select c.SSN, c.FIRST_NAME, c.LAST_NAME, c.CREDIT_CARD_NO, b.BRANCH_ZIP,
           cast(t.txn_date as varchar) as transaction_date, cast(day(t.txn_date) as int) as transaction_day,
           {MONEY} as total_transaction_value
    from dated t join rv_cust c on t.CREDIT_CARD_NO = c.CREDIT_CARD_NO join br b on t.BRANCH_CODE = b.BRANCH_CODE
    where {{condition}}
    group by c.SSN, c.FIRST_NAME, c.LAST_NAME, c.CREDIT_CARD_NO, b.BRANCH_ZIP, t.txn_date"""

add(
    "agg_zip_month_daily",
    lambda d: reports.daily_totals_for_zip(d.stored("transactions"), d.raw_customers, d.branches, ZIP, YEAR, MONTH),
    DAILY_SQL.format(
        condition=f"b.BRANCH_ZIP = '{ZIP}' and year(t.txn_date) = {YEAR} and month(t.txn_date) = {MONTH}"
    ),
)
add(
    "agg_daily_all",
    lambda d: reports.daily_totals(d.transactions, d.raw_customers, d.branches),
    DAILY_SQL.format(condition="true"),
)
add(
    "agg_monthly_bill",
    lambda d: reports.monthly_bill(d.stored("transactions"), d.raw_customers, CARD, 3, 1996),
    f"""select SSN, FIRST_NAME, LAST_NAME, {MONEY} as total_bill
        from dated t join rv_cust c on t.CREDIT_CARD_NO = c.CREDIT_CARD_NO
        where t.CREDIT_CARD_NO = '{CARD}' and year(txn_date) = 1996 and month(txn_date) = 3
        group by SSN, FIRST_NAME, LAST_NAME""",
)
add(
    "agg_monthly_bill_all",
    lambda d: reports.monthly_bills(d.transactions, d.raw_customers),
    f"""select t.CREDIT_CARD_NO, cast(cast(date_trunc('month', txn_date) as date) as varchar) as bill_month,
               SSN, FIRST_NAME, LAST_NAME, {MONEY} as total_bill
        from dated t join rv_cust c on t.CREDIT_CARD_NO = c.CREDIT_CARD_NO
        group by t.CREDIT_CARD_NO, date_trunc('month', txn_date), SSN, FIRST_NAME, LAST_NAME""",
)


def bills_stored_by_card(d):
    names = d.bucketed("transactions", BUCKETS), d.bucketed("customers", BUCKETS)
    return reports.monthly_bills_bucketed(d.spark, *names, BUCKETS)


add(
    "agg_monthly_bill_bucketed",
    bills_stored_by_card,
    f"""select t.CREDIT_CARD_NO, cast(cast(date_trunc('month', txn_date) as date) as varchar) as bill_month,
               SSN, FIRST_NAME, LAST_NAME, {MONEY} as total_bill
        from dated t join cu c on t.CREDIT_CARD_NO = c.CREDIT_CARD_NO
        group by t.CREDIT_CARD_NO, date_trunc('month', txn_date), SSN, FIRST_NAME, LAST_NAME""",
)
RANGE_SQL = "cast(min(txn_date) as varchar) as first_date, cast(max(txn_date) as varchar) as last_date from dated"
add(
    "agg_card_date_range",
    lambda d: reports.card_date_range(d.stored("transactions"), CARD),
    f"select {RANGE_SQL} where CREDIT_CARD_NO = '{CARD}'",
)
add(
    "agg_card_date_range_all",
    lambda d: reports.card_date_ranges(d.transactions),
    f"select CREDIT_CARD_NO, {RANGE_SQL} group by CREDIT_CARD_NO",
)
add(
    "report_card_statement",
    lambda d: reports.card_statements(d.view("rv_stmt"), d.transactions),
    """with ranges as (select CREDIT_CARD_NO, min(txn_date) as lo, max(txn_date) as hi from dated group by 1)
       select s.CREDIT_CARD_NO, cast(s.first_date as varchar) as first_date, cast(s.last_date as varchar) as last_date,
              case when t.txn_date is not null then 'found' when r.lo is not null then 'outside_range'
                   else 'no_transactions' end as outcome,
              cast(t.txn_date as varchar) as transaction_date, t.TRANSACTION_TYPE, t.TRANSACTION_VALUE,
              case when t.txn_date is null then cast(r.lo as varchar) end as card_first_date,
              case when t.txn_date is null then cast(r.hi as varchar) end as card_last_date
       from rv_stmt s
       left join dated t on s.CREDIT_CARD_NO = t.CREDIT_CARD_NO and t.txn_date between s.first_date and s.last_date
       left join ranges r on s.CREDIT_CARD_NO = r.CREDIT_CARD_NO""",
)
add(
    "report_top_months",
    lambda d: reports.report_top_months(d.transactions),
    """select * from (
           select 'total_value' as measure, monthname(make_date(2000, cast(month as int), 1)) as month_name,
                  total_value, transactions,
                  '$' || format('{:,}', cast(floor(total_value) as bigint)) || '.'
                      || lpad(cast(cast(round(total_value * 100) as bigint) % 100 as varchar), 2, '0') as label
           from by_month order by total_value desc, month limit 3) as v
       union all
       select * from (
           select 'transactions', monthname(make_date(2000, cast(month as int), 1)), total_value, transactions,
                  format('{:,}', transactions) from by_month order by transactions desc, month limit 3) as n""",
)

# ---- profiles ------------------------------------------------------------------------

CUSTOMER_COLUMNS = [
    "CREDIT_CARD_NO", "SSN", "CUST_EMAIL", "CUST_PHONE", "FIRST_NAME", "MIDDLE_NAME", "LAST_NAME", "APT_NO",
    "STREET_NAME", "CUST_CITY", "CUST_ZIP", "CUST_STATE", "CUST_COUNTRY", "LAST_UPDATED",
]


def _per_column(template: str, columns: list[str]) -> str:
    return " union all ".join(template.replace("{c}", c) for c in columns)


def ten_digits(df, *names):
    """Floating-point results rounded to the digits that do not depend on row order.

    Sixteen-digit card numbers leave two for their deviation.
    """

    def text(n):
        card = (F.col("column_name") == "CREDIT_CARD_NO") & F.lit(n == "stddev")
        return F.when(F.col(n).isNotNull(), F.when(card, F.format_string("%.1e", n)).otherwise(F.format_string("%.9e", n)))

    return df.withColumns({n: text(n) for n in names})


add(
    "agg_axis_bounds",
    lambda d: reports.axis_bounds(reports.count_by(d.transactions, "TRANSACTION_TYPE", "transactions"), "transactions"),
    """select min(transactions) * cast(0.9 as double) as axis_low, max(transactions) * cast(1.1 as double) as axis_high
       from by_type""",
)
add(
    "agg_count_distinct",
    lambda d: profile.distinct_per_column(d.raw_customers),
    _per_column("select '{c}' as column_name, count(distinct {c}) as distinct_values from rv_cust", CUSTOMER_COLUMNS),
)
add(
    "agg_distinct_rows",
    lambda d: profile.distinct_rows(match_counts(d).drop("matches"), "different_matches"),
    f"select count(*) as distinct_rows from (select distinct * from ({FANOUT_SQL}) as f) as u",
)
add(
    "agg_one_to_one_check",
    lambda d: profile.one_to_one(d.raw_transactions, "CREDIT_CARD_NO", "CUST_SSN"),
    """select *, left_values = pairs and right_values = pairs as one_to_one from (
           select count(distinct CREDIT_CARD_NO) as left_values, count(distinct CUST_SSN) as right_values,
                  count(distinct CREDIT_CARD_NO || '/' || cast(CUST_SSN as varchar)) as pairs from rv_tx) as n""",
)
add(
    "agg_duplicate_emails",
    lambda d: dedup.duplicate_values(d.raw_customers, "CUST_EMAIL"),
    "select CUST_EMAIL, count(*) as num_records from rv_cust group by 1 having count(*) > 1",
)
add(
    "agg_duplicate_zips",
    lambda d: dedup.duplicate_values(d.crosswalk, "CUST_ZIP"),
    "select CUST_ZIP, count(*) as num_records from rv_zip group by 1 having count(*) > 1",
)
add(
    "agg_duplicate_cards",
    lambda d: dedup.duplicate_values(match_counts(d), "CREDIT_CARD_NO", copies="matches"),
    f"select CREDIT_CARD_NO, count(*) as num_records from ({FANOUT_SQL}) as f group by 1 having count(*) > 1",
)
MISSING = "count(*) filter (where {c} is null or cast({c} as varchar) = '') as missing"
add(
    "agg_missing_per_column",
    lambda d: profile.missing_per_column(d.raw_customers),
    _per_column(f"select '{{c}}' as column_name, {MISSING} from rv_cust", CUSTOMER_COLUMNS),
)
DESCRIBE = """count({c}) as filled, printf('%.9e', avg(try_cast({c} as double))) as mean,
    printf(case when '{c}' = 'CREDIT_CARD_NO' then '%.1e' else '%.9e' end, stddev_samp(try_cast({c} as double))) as stddev,
    cast(min({c}) as varchar) as lowest, cast(max({c}) as varchar) as highest"""
add(
    "agg_describe",
    lambda d: ten_digits(profile.describe_columns(d.raw_customers, CUSTOMER_COLUMNS), "mean", "stddev"),
    _per_column(f"select '{{c}}' as column_name, {DESCRIBE} from rv_cust", CUSTOMER_COLUMNS),
)
add(
    "profile_table",
    lambda d: ten_digits(profile.profile_table(d.raw_customers, CUSTOMER_COLUMNS), "mean", "stddev"),
    _per_column(
        f"""select '{{c}}' as column_name, {DESCRIBE}, {MISSING}, count(distinct {{c}}) as distinct_values,
                   count(*) as table_rows, (select count(*) from (select distinct * from rv_cust) as u) as table_distinct_rows
            from rv_cust""",
        CUSTOMER_COLUMNS,
    ),
)
add(
    "agg_length_histogram",
    lambda d: d.branches.groupBy(F.length("BRANCH_ZIP").cast("long").alias("zip_len")).agg(
        F.count(F.lit(1)).alias("branches")
    ),
    "select length(BRANCH_ZIP) as zip_len, count(*) as branches from br group by 1",
)
add(
    "agg_prefix_histogram",
    lambda d: d.raw_branches.groupBy(F.substring("BRANCH_PHONE", 1, 3).alias("first_phone"))
    .agg(F.count(F.lit(1)).alias("branches"))
    .orderBy("branches", "first_phone"),
    "select substr(BRANCH_PHONE, 1, 3) as first_phone, count(*) as branches from rv_branch group by 1 order by 2",
)
add(
    "agg_count_by_name",
    lambda d: d.raw_branches.groupBy("BRANCH_NAME").agg(F.count(F.lit(1)).alias("branches")).orderBy("branches", "BRANCH_NAME"),
    "select BRANCH_NAME, count(*) as branches from rv_branch group by 1 order by 2",
)
