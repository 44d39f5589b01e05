"""Joins, windows, deduplication, sorting and updates."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import feeds
from checks.queries_columns import REASON_SQL
from checks.queries_sources import FEATURES_SQL, STATE_NAME_CASE
from checks.registry import add
from checks.role_views import VIEWS
from ledgerloom.functions import labels
from ledgerloom.operators import dedup, joins, ranking, updates
from ledgerloom.plans import loads, reports
from ledgerloom.sources import buckets, readers, snapshots

# ---- joins ---------------------------------------------------------------------------

add(
    "join_three_way",
    lambda d: joins.with_customers_and_branches(d.transactions, d.raw_customers, d.branches),
    """select t.*, c.SSN, c.FIRST_NAME, c.LAST_NAME, b.BRANCH_ZIP
       from tx t join rv_cust c on t.CREDIT_CARD_NO = c.CREDIT_CARD_NO join br b on t.BRANCH_CODE = b.BRANCH_CODE""",
)
add(
    "join_two_way",
    lambda d: joins.with_customers(d.transactions, d.raw_customers),
    """select t.*, c.SSN, c.FIRST_NAME, c.LAST_NAME
       from tx t join rv_cust c on t.CREDIT_CARD_NO = c.CREDIT_CARD_NO""",
)
BUCKETS = 16


def join_stored_by_card(d):
    names = d.bucketed("transactions", BUCKETS), d.bucketed("customers", BUCKETS)
    joined = buckets.join_bucketed(d.spark, *names, "CREDIT_CARD_NO", BUCKETS, ["SSN", "FIRST_NAME", "LAST_NAME"])
    return joined.drop("TXN_MONTH")


add(
    "join_two_way_bucketed",
    join_stored_by_card,
    """select t.*, c.SSN, c.FIRST_NAME, c.LAST_NAME
       from tx t join cu c on t.CREDIT_CARD_NO = c.CREDIT_CARD_NO""",
)
add(
    "join_self_audit",
    lambda d: joins.changed_values(
        d.raw_customers,
        loads.disambiguate_emails(d.raw_customers),
        ["SSN", "CREDIT_CARD_NO"],
        "CUST_EMAIL",
        ["FIRST_NAME", "MIDDLE_NAME", "LAST_NAME"],
    ),
    """select o.SSN, o.CREDIT_CARD_NO, o.FIRST_NAME, o.MIDDLE_NAME, o.LAST_NAME, o.CUST_EMAIL as original_value, u.CUST_EMAIL as updated_value
       from rv_cust o join cust_email u on o.SSN = u.SSN and o.CREDIT_CARD_NO = u.CREDIT_CARD_NO
       where o.CUST_EMAIL <> u.CUST_EMAIL""",
)


def left_patch(d):
    keys = ["SSN", "CREDIT_CARD_NO"]
    changed = joins.changed_values(d.raw_customers, loads.disambiguate_emails(d.raw_customers), keys, "CUST_EMAIL", [])
    updated = changed.select(*keys, F.col("updated_value").alias("CUST_EMAIL"))
    return joins.patch_column(d.raw_customers, updated, keys, "CUST_EMAIL").select("SSN", "LAST_NAME", "CUST_EMAIL")


add(
    "join_left_patch",
    left_patch,
    """select o.SSN, o.LAST_NAME, coalesce(u.CUST_EMAIL, o.CUST_EMAIL) as CUST_EMAIL
       from rv_cust o left join cust_email u on o.SSN = u.SSN and o.CREDIT_CARD_NO = u.CREDIT_CARD_NO""",
)

FANOUT_SQL = """
    select c.*, z.CUST_CITY as "right_CUST_CITY", z.CUST_STATE as "right_CUST_STATE",
           z.CUST_COUNTY as "right_CUST_COUNTY", z.AREA_CODE as "right_AREA_CODE"
    from rv_cust c left join rv_zip z on c.CUST_ZIP = z.CUST_ZIP and trim(c.CUST_ZIP) <> ''"""


def fan_out(d):
    return joins.with_crosswalk_rows(d.raw_customers, d.crosswalk)


def match_counts(d):
    return joins.with_match_counts(d.raw_customers, d.crosswalk)


def duplicates_with_rows(d):
    """Cards are counted before their customers are repeated."""
    repeated = dedup.rows_with_duplicate_key(match_counts(d).drop("different_matches"), "CREDIT_CARD_NO", "matches")
    return joins.with_crosswalk_rows(repeated, d.crosswalk)


add("join_left_crosswalk", fan_out, FANOUT_SQL)
add(
    "join_back_duplicates",
    duplicates_with_rows,
    f"""select * from (select *, count(*) over (partition by CREDIT_CARD_NO) as num_records from ({FANOUT_SQL}) as f) as n
        where num_records > 1""",
)
add(
    "join_lookup_month",
    lambda d: reports.monthly_totals(d.transactions).select(
        "month", labels.month_name(F.col("month")).alias("month_name"), "transactions"
    ),
    """select month, monthname(make_date(2000, cast(month as int), 1)) as month_name, transactions from by_month""",
)
add(
    "join_lookup_state",
    lambda d: reports.count_by(d.raw_customers, "CUST_STATE", "customers").withColumn(
        "state_name", labels.state_name(F.col("CUST_STATE"))
    ),
    f"""select CUST_STATE, customers, {STATE_NAME_CASE.replace('case code', 'case CUST_STATE')} as state_name
        from by_state""",
)


def _features(d):
    path = feeds.write_state_features(d.raw_customers, d.raw_branches, "state-features")
    return readers.read_feature_names(d.spark, path)


NAMED_COUNTS_SQL = f"""
    select f.name, n.customers from ({FEATURES_SQL}) as f
    left join (select {STATE_NAME_CASE.replace('case code', 'case CUST_STATE')} as name, customers from by_state) as n
    on f.name = n.name"""


def geo_join(d):
    counts = reports.count_by(d.raw_customers, "CUST_STATE", "customers")
    named = counts.select(labels.state_name(F.col("CUST_STATE")).alias("name"), "customers")
    return joins.features_with_counts(_features(d), named, "name", "customers")


add("join_geo_feature", geo_join, NAMED_COUNTS_SQL)
add("report_state_map", lambda d: reports.report_state_map(d.raw_customers, _features(d)), NAMED_COUNTS_SQL)

# ---- windows and deduplication -------------------------------------------------------

add(
    "window_rank_email",
    lambda d: ranking.rank_within(d.raw_customers, "CUST_EMAIL", "MIDDLE_NAME", "email_rank").select(
        "SSN", "CUST_EMAIL", "MIDDLE_NAME", "email_rank"
    ),
    "select SSN, CUST_EMAIL, MIDDLE_NAME, email_rank from cust_ranked",
)
add(
    "window_email_disambiguate",
    lambda d: loads.disambiguate_emails(d.raw_customers).select("SSN", "CUST_EMAIL"),
    "select SSN, CUST_EMAIL from cust_email",
)
add(
    "window_top_with_ties",
    lambda d: reports.top_states_with_ties(d.raw_customers),
    """select CUST_STATE, customers from by_state qualify rank() over (order by customers desc) <= 10""",
)


def deduplicated(d):
    return dedup.one_row_per_key(joins.with_first_crosswalk_row(d.raw_customers, d.crosswalk), "CREDIT_CARD_NO")


OTHER_COLUMNS = [c for c in VIEWS["rv_cust"][1] if c != "CREDIT_CARD_NO"] + [
    f"right_{c}" for c in ("CUST_CITY", "CUST_STATE", "CUST_COUNTY", "AREA_CODE")
]


add(
    "dedup_by_key",
    deduplicated,
    f"""select * from ({FANOUT_SQL}) as f
        qualify row_number() over (
            partition by CREDIT_CARD_NO order by {", ".join(f'"{c}" nulls first' for c in OTHER_COLUMNS)}) = 1""",
)

# ---- sorting and top-k ---------------------------------------------------------------

add(
    "sort_asc",
    lambda d: reports.count_by(d.transactions, "TRANSACTION_TYPE", "transactions").orderBy("TRANSACTION_TYPE"),
    "select * from by_type order by TRANSACTION_TYPE",
)
add("sort_desc", lambda d: reports.transactions_by_type(d.transactions), "select * from by_type order by transactions desc")
add(
    "sort_multi_desc",
    lambda d: d.transactions.orderBy(F.desc("TIMEID"), F.desc("TRANSACTION_VALUE"), F.desc("TRANSACTION_ID")),
    "select * from tx order by TIMEID desc, TRANSACTION_VALUE desc, TRANSACTION_ID desc",
)
add(
    "topk_limit",
    lambda d: reports.top_customers_by_value(d.transactions, 3),
    """select CUST_SSN, cast(sum(cast(TRANSACTION_VALUE as decimal(18, 2))) as double) as total_value
       from tx group by CUST_SSN order by 2 desc, 1 limit 3""",
)
add(
    "topk_states",
    lambda d: reports.top_states(d.raw_customers),
    "select * from by_state order by customers desc, CUST_STATE limit 10",
)

# ---- updates -------------------------------------------------------------------------

FIELDS = updates.FIELDS
LATEST_SQL = "select CREDIT_CARD_NO, " + ", ".join(
    f"last(NEW_VALUE order by REQUEST_ID nulls first, NEW_VALUE) filter (where FIELD = '{f}') as new_{f}" for f in FIELDS
) + f" from rv_req where ({REASON_SQL}) is null group by CREDIT_CARD_NO"
UPDATED_SQL = "select cu.* replace (" + ", ".join(
    f"case when cu.{f} <> l.new_{f} then l.new_{f} else cu.{f} end as {f}" for f in FIELDS
) + f") from cu left join ({LATEST_SQL}) as l on cu.CREDIT_CARD_NO = l.CREDIT_CARD_NO"


def update_files(d):
    path = d.snapshot("customers")
    updates.update_stored(d.spark, path, d.requests)
    return snapshots.read_snapshot(d.spark, path)


add("update_customer_field", update_files, UPDATED_SQL)
add("update_customer_snapshot", lambda d: updates.apply_changes(d.stored("customers"), d.requests), UPDATED_SQL)

STORED_SQL = "case FIELD " + " ".join(f"when '{f}' then cu.{f}" for f in FIELDS) + " end"
AUDIT_SQL = f"""
    with judged as (select *, {REASON_SQL} as reason from rv_req),
    chained as (
        select *, lag(NEW_VALUE) over (partition by CREDIT_CARD_NO, FIELD order by REQUEST_ID nulls first, NEW_VALUE) as earlier
        from judged where reason is null),
    joined as (
        select j.REQUEST_ID, j.CREDIT_CARD_NO, FIELD, NEW_VALUE, cu.CREDIT_CARD_NO is not null as account,
               case when {STORED_SQL} is not null then coalesce(earlier, {STORED_SQL}) end as value_before
        from chained j left join cu on j.CREDIT_CARD_NO = cu.CREDIT_CARD_NO)
    select REQUEST_ID, CREDIT_CARD_NO, FIELD, NEW_VALUE, value_before,
           case when value_before <> NEW_VALUE then NEW_VALUE else value_before end as value_after,
           case when not account then 'no_account' when value_before <> NEW_VALUE then 'changed' else 'unchanged' end as status,
           cast(null as varchar) as reason
    from joined
    union all
    select REQUEST_ID, CREDIT_CARD_NO, FIELD, NEW_VALUE, null, null, 'rejected', reason from judged where reason is not null"""

add("update_before_after", lambda d: updates.audit_changes(d.stored("customers"), d.requests), AUDIT_SQL)
