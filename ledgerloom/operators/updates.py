"""Batch updates of customer fields from a table of change requests, with an audit trail.

Requests are applied in ``REQUEST_ID`` order. A field that is null is not updated
unless ``null_safe`` is set, as a comparison with null is never true.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.validation import FIELD_RULES, rejection_reason
from ledgerloom.operators.running_totals import with_previous_value
from ledgerloom.sources import snapshots
from ledgerloom.sources.writers import land

FIELDS = list(FIELD_RULES)
BLOCK_ROWS = 1_000_000
LISTED_CARDS = 1_000


def accepted_requests(requests: DataFrame) -> DataFrame:
    return requests.filter(rejection_reason(F.col("FIELD"), F.col("NEW_VALUE")).isNull())


def _latest_values(requests: DataFrame) -> DataFrame:
    """One row per card with the last accepted value of each field, null where there is none."""

    def latest(field: str) -> Column:
        asked = F.col("FIELD") == field
        newest = F.max(F.when(asked, F.struct("REQUEST_ID", "NEW_VALUE")))
        return newest.getField("NEW_VALUE").alias(f"__{field}")

    return accepted_requests(requests).groupBy("CREDIT_CARD_NO").agg(*[latest(field) for field in FIELDS])


def apply_changes(customers: DataFrame, requests: DataFrame, null_safe: bool = False) -> DataFrame:
    """The next snapshot of the customer table."""
    return _with_values(customers, _latest_values(requests), null_safe)


def _with_values(customers: DataFrame, latest: DataFrame, null_safe: bool) -> DataFrame:
    joined = customers.join(latest, "CREDIT_CARD_NO", "left")

    def value(column: str) -> Column:
        if column not in FIELDS:
            return F.col(column)
        new = F.col(f"__{column}")
        replace = new.isNotNull() if null_safe else new.isNotNull() & F.col(column).isNotNull()
        return F.when(replace, new).otherwise(F.col(column)).alias(column)

    return joined.select(*[value(column) for column in customers.columns])


def _changes(column: str, null_safe: bool) -> Column:
    """Whether a stored value is to become another one."""
    new = F.col(f"__{column}")
    differs = ~F.col(column).eqNullSafe(new) if null_safe else F.col(column) != new
    return F.coalesce(new.isNotNull() & differs, F.lit(False))


def update_stored(spark: SparkSession, path: str, requests: DataFrame, null_safe: bool = False) -> list[str]:
    """Apply change requests to a stored customer table (see ``snapshots``), and return the files that were rewritten.

    Copy on write, by file: only files with a row that really changes are read whole and written anew; all others
    stay as they are, under their names. Which files these are is asked of the columns that can change; the cards of
    a small batch are pushed into that scan, which skips what cannot hold them where the table is laid out by card. The driver
    sees names of files. Nothing is committed when nothing changes; if another job commits first, this one fails and changes nothing.
    """
    state = snapshots.current(spark, path)
    if state is None:
        raise FileNotFoundError(f"no table at {path}")
    latest = land(_latest_values(requests.filter(F.col("CREDIT_CARD_NO").isNotNull())), "latest-values")
    stored = snapshots.read_state(spark, state)
    held = stored.select("CREDIT_CARD_NO", *FIELDS, F.col("_metadata.file_path").alias("__file")) if state.files else None
    if held is None:
        return []
    cards = [r[0] for r in latest.select("CREDIT_CARD_NO").limit(LISTED_CARDS + 1).collect()]
    if len(cards) <= LISTED_CARDS:
        held = held.filter(F.col("CREDIT_CARD_NO").isin(cards))
    changed = reduce(lambda a, b: a | b, [_changes(field, null_safe) for field in FIELDS])
    touched = held.join(latest, "CREDIT_CARD_NO").filter(changed).select("__file").distinct().collect()
    files = sorted(snapshots.plain_path(spark, r[0]) for r in touched)
    if files:
        rewritten = _with_values(snapshots.read_state(spark, state, files), latest, null_safe)
        ordered = rewritten.repartitionByRange(len(files), "CREDIT_CARD_NO").sortWithinPartitions("CREDIT_CARD_NO")
        snapshots.replace_files(spark, path, state, files, ordered)
    return files


def _with_previous_request(requests: DataFrame, block_rows: int) -> DataFrame:
    """Add ``previous``: the value of the last earlier request for the same card and field.

    One card may hold a large part of all requests, so the look-back runs over ranges of about ``block_rows`` requests, as
    many as there need to be. Requests without a number come first, requests of one number in order
    of their value. A request without a card has none before it.
    """
    nobody = requests.filter("CREDIT_CARD_NO is null").withColumn("previous", F.lit(None).cast("string"))
    of_cards = requests.filter("CREDIT_CARD_NO is not null")
    order = [F.col("REQUEST_ID").asc_nulls_first(), F.col("NEW_VALUE").asc_nulls_first()]
    ranges = of_cards.count() // block_rows + 1
    found = with_previous_value(of_cards, ["CREDIT_CARD_NO", "FIELD"], order, "NEW_VALUE", "previous", ranges)
    return found.unionByName(nobody)


def audit_changes(
    customers: DataFrame, requests: DataFrame, null_safe: bool = False, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """For each request: value before, value after, and what happened to it.

    ``status`` is ``rejected`` (with a reason), ``no_account``, ``unchanged`` or ``changed``. A request without a
    card has no account; one without a number comes before all that have one. The judged requests are written
    first, as they are read several times and their feed should be parsed once.
    """
    judged = land(requests.withColumn("reason", rejection_reason(F.col("FIELD"), F.col("NEW_VALUE"))), "judged-requests")
    refused = judged.filter(F.col("reason").isNotNull()).select(
        *requests.columns,
        F.lit(None).cast("string").alias("value_before"),
        F.lit(None).cast("string").alias("value_after"),
        F.lit("rejected").alias("status"),
        "reason",
    )

    accepted = _with_previous_request(judged.filter(F.col("reason").isNull()).drop("reason"), block_rows)
    stored = customers.select("CREDIT_CARD_NO", F.struct(*FIELDS).alias("__stored"))
    joined = accepted.join(stored, "CREDIT_CARD_NO", "left")
    original = F.coalesce(
        *[F.when(F.col("FIELD") == field, F.col("__stored").getField(field)) for field in FIELDS]
    )
    follows = F.col("previous") if null_safe else F.when(original.isNotNull(), F.col("previous"))
    before = F.coalesce(follows, original)
    new = F.col("NEW_VALUE")
    differs = ~before.eqNullSafe(new) if null_safe else F.coalesce(before != new, F.lit(False))
    account = F.col("__stored").isNotNull()
    decided = joined.select(
        *requests.columns,
        F.when(account, before).alias("value_before"),
        F.when(account, F.when(differs, new).otherwise(before)).alias("value_after"),
        F.when(~account, "no_account").when(differs, "changed").otherwise("unchanged").alias("status"),
        F.lit(None).cast("string").alias("reason"),
    )
    return refused.unionByName(decided)


def affected_fields(audit: DataFrame) -> DataFrame:
    """Number of requests by field and outcome."""
    return audit.groupBy("FIELD", "status").agg(F.count(F.lit(1)).alias("requests"))
