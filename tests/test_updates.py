"""Batch updates against applying the requests one by one."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerloom import schemas
from ledgerloom.operators import running_totals, updates
from ledgerloom.session import new_path
from ledgerloom.sources import snapshots, writers
from tests.helpers import rows

COLUMNS = schemas.CUSTOMER.names


def customers_and_requests(seed: int):
    """A few customers with null fields; one card holds a third of the requests."""
    rnd = random.Random(seed)
    customers = []
    for i in range(12):
        row = dict.fromkeys(COLUMNS)
        row.update(SSN=i, CREDIT_CARD_NO=f"c{i}", FIRST_NAME="Amy", CUST_ZIP="10001", CUST_STATE="NY", CUST_CITY="Rye")
        if i % 3 == 0:
            row["CUST_ZIP"] = None
        customers.append(row)
    choices = [
        ("FIRST_NAME", ["Amy", "Beth", "R2"]),
        ("CUST_ZIP", ["10001", "20002", "1"]),
        ("CUST_STATE", ["NY", "TX", "TEX"]),
        ("SSN", ["1"]),
        ("CUST_CITY", ["Rye", "Troy"]),
    ]
    requests = []
    for n in range(400):
        field, values = rnd.choice(choices)
        card = "c1" if rnd.random() < 1 / 3 else f"c{rnd.randrange(15)}"
        requests.append((n * 7, card, field, rnd.choice(values)))
    rnd.shuffle(requests)
    return customers, requests


VALID = {"FIRST_NAME": {"Amy", "Beth"}, "CUST_ZIP": {"10001", "20002"}, "CUST_STATE": {"NY", "TX"}, "CUST_CITY": {"Rye", "Troy"}}


def one_by_one(customers, requests, null_safe):
    state = {c["CREDIT_CARD_NO"]: dict(c) for c in customers}
    audit = []
    for number, card, field, new in sorted(requests):
        if field not in VALID:
            audit.append((number, None, None, "rejected"))
        elif new not in VALID[field]:
            audit.append((number, None, None, "rejected"))
        elif card not in state:
            audit.append((number, None, None, "no_account"))
        else:
            old = state[card][field]
            changes = old != new if null_safe else old is not None and old != new
            if changes:
                state[card][field] = new
            audit.append((number, old, state[card][field], "changed" if changes else "unchanged"))
    return state, audit


@pytest.mark.parametrize("null_safe", [False, True])
@pytest.mark.parametrize("block_rows", [1, 50, 1_000_000])
def test_audit_and_result(spark, null_safe, block_rows):
    customers, requests = customers_and_requests(block_rows)
    table = spark.createDataFrame([[c[name] for name in COLUMNS] for c in customers], schemas.CUSTOMER)
    asked = spark.createDataFrame(requests, schemas.CHANGE_REQUEST)
    state, expected = one_by_one(customers, requests, null_safe)

    audit = updates.audit_changes(table, asked, null_safe, block_rows)
    got = sorted((r["REQUEST_ID"], r["value_before"], r["value_after"], r["status"]) for r in audit.collect())
    assert got == expected
    assert all((r["reason"] is not None) == (r["status"] == "rejected") for r in audit.collect())

    after = {r["CREDIT_CARD_NO"]: r.asDict() for r in updates.apply_changes(table, asked, null_safe).collect()}
    assert after == state
    changed = sum(r["requests"] for r in updates.affected_fields(audit).filter("status = 'changed'").collect())
    assert changed == sum(1 for row in expected if row[3] == "changed")


def test_no_requests_change_nothing(spark):
    customers, _ = customers_and_requests(1)
    table = spark.createDataFrame([[c[name] for name in COLUMNS] for c in customers], schemas.CUSTOMER)
    none = spark.createDataFrame([], schemas.CHANGE_REQUEST)
    assert updates.apply_changes(table, none).exceptAll(table).count() == 0
    assert updates.audit_changes(table, none).count() == 0


def stored_customers(spark, n, files):
    """A table of ``n`` customers in ``files`` files by ranges of the card."""
    columns = {f.name: F.lit("x").cast(f.dataType) if f.name != "LAST_UPDATED" else F.lit(None).cast(f.dataType) for f in schemas.CUSTOMER.fields}
    columns.update(CREDIT_CARD_NO=F.format_string("4%015d", "id"), SSN=F.col("id"), CUST_ZIP=F.lit("10000"), LAST_NAME=F.when(F.col("id") % 10 != 0, "Lee"))
    people = spark.range(0, n, 1, files).select(*[columns[f.name].alias(f.name) for f in schemas.CUSTOMER.fields])
    path = new_path(spark, "customers")
    snapshots.append_batch(people, path, "first")
    return people, path


def asked(spark, *requests):
    return spark.createDataFrame([(i, f"4{card:015d}" if card is not None else None, f, v) for i, (card, f, v) in enumerate(requests)], schemas.CHANGE_REQUEST)


def test_only_files_with_a_change_are_rewritten(spark):
    people, path = stored_customers(spark, 8000, 8)
    before = snapshots.current(spark, path)
    requests = asked(
        spark, (17, "CUST_ZIP", "20000"), (1501, "LAST_NAME", "Moe"), (17, "CUST_ZIP", "30000"), (2500, "CUST_ZIP", "10000"), (3500, "CUST_ZIP", "no zip"),
        (5010, "LAST_NAME", "Roe"), (99999, "CUST_ZIP", "20000"), (None, "CUST_ZIP", "20000"),
    )
    rewritten = updates.update_stored(spark, path, requests)
    after = snapshots.current(spark, path)
    assert len(before.files) == 8 and len(rewritten) == 2
    assert set(before.files) - set(after.files) == set(rewritten) and len(set(before.files) & set(after.files)) == 6
    assert rows(snapshots.read_snapshot(spark, path)) == rows(updates.apply_changes(people, requests))
    assert rows(snapshots.read_state(spark, before)) == rows(people)
    # a null field is filled only on demand, and then its file is one more
    assert len(updates.update_stored(spark, path, requests, null_safe=True)) == 1
    assert rows(snapshots.read_snapshot(spark, path)) == rows(updates.apply_changes(people, requests, null_safe=True))
    assert updates.update_stored(spark, path, requests, null_safe=True) == [] and snapshots.current(spark, path).version == 2


def test_updates_of_many_cards_and_of_none(spark, monkeypatch):
    monkeypatch.setattr(updates, "LISTED_CARDS", 3)
    people, path = stored_customers(spark, 400, 4)
    requests = spark.range(400).select(
        "id", F.format_string("4%015d", "id"), F.lit("CUST_ZIP"), F.format_string("2%04d", "id")
    ).toDF(*schemas.CHANGE_REQUEST.names)
    assert len(updates.update_stored(spark, path, requests)) == 4
    assert rows(snapshots.read_snapshot(spark, path)) == rows(updates.apply_changes(people, requests))
    assert updates.update_stored(spark, path, requests.limit(0)) == []


def test_a_commit_after_another_one_fails_and_changes_nothing(spark):
    people, path = stored_customers(spark, 40, 2)
    state = snapshots.current(spark, path)
    snapshots.append_batch(people.limit(1), path, "second")
    with pytest.raises(snapshots.ConcurrentCommit):
        snapshots.replace_files(spark, path, state, list(state.files), people.limit(5))
    assert snapshots.read_snapshot(spark, path).count() == 41


@pytest.mark.parametrize("block_rows", [7, 500, 100_000])
def test_values_are_carried_over_ranges_of_any_size(spark, block_rows):
    """One card holds most requests, and its ranges stay small."""
    card = F.when(F.col("id") % 5 > 0, "hot").when(F.col("id") % 7 == 0, None).otherwise(F.concat(F.lit("c"), F.col("id") % 13))
    requests = writers.land(spark.range(0, 3000, 1, 3).select(
        F.when(F.col("id") % 11 != 0, F.col("id") % 900).alias("REQUEST_ID"), card.alias("CREDIT_CARD_NO"),
        F.when(F.col("id") % 3 == 0, "A").otherwise("B").alias("FIELD"), F.when(F.col("id") % 17 != 0, (F.col("id") % 29).cast("string")).alias("NEW_VALUE"),
    ), "requests")
    got = rows(updates._with_previous_request(requests, block_rows))
    order = Window.partitionBy("CREDIT_CARD_NO", "FIELD").orderBy(F.col("REQUEST_ID").asc_nulls_first(), F.col("NEW_VALUE").asc_nulls_first())
    plain = requests.withColumn("previous", F.when(F.col("CREDIT_CARD_NO").isNotNull(), F.lag("NEW_VALUE").over(order)))
    assert got == rows(plain)


def test_ranges_of_a_hot_card_are_bounded(spark, monkeypatch):
    sizes = []

    def land(df, name):
        out = writers.land(df, name)
        if name == "ranges":
            sizes.extend(n for _, n in rows(out.groupBy("__range").count()))
        return out

    monkeypatch.setattr(running_totals, "land", land)
    requests = spark.range(0, 20_000, 1, 4).select(
        F.col("id").alias("REQUEST_ID"), F.lit("hot").alias("CREDIT_CARD_NO"), F.lit("CUST_ZIP").alias("FIELD"), F.lit("10000").alias("NEW_VALUE")
    )
    assert updates._with_previous_request(requests, 50).filter("previous is null").count() == 1
    assert len(sizes) > 300 and max(sizes) < 50 * 10
