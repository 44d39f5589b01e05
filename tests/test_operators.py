"""Operators against brute force in Python, with nulls, ties and keys that dominate the table."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import dedup, hotkeys, joins, profile, ranking
from tests.helpers import rows


def people(seed: int, n: int = 400):
    """Names with one address holding a third of all rows, nulls, and repeated rows."""
    rnd = random.Random(seed)
    middles = [None, "", "Ann", "Anna", "Bo", "bo", "Zoë", "Émile", "Wm"]
    return [
        (i, "hot@example.com" if rnd.random() < 1 / 3 else rnd.choice([None, *[f"u{k}@x" for k in range(60)]]),
         rnd.choice(middles))
        for i in range(n)
    ]


def order_key(value):
    return (value is not None, (value or "").encode())


def brute_ranks(data):
    groups = defaultdict(list)
    for _, email, middle in data:
        groups[email].append(order_key(middle))
    return {i: 1 + sum(k < order_key(m) for k in groups[e]) for i, e, m in data}


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("threshold", ["-1", "10485760"])
def test_rank_without_a_window_over_rows(spark, settings, seed, threshold):
    settings(**{"spark.sql.autoBroadcastJoinThreshold": threshold})
    data = people(seed)
    df = spark.createDataFrame(data, "id int, email string, middle string")
    ranks = brute_ranks(data)
    got = {r["id"]: r["rank"] for r in ranking.rank_within(df, "email", "middle").collect()}
    assert got == ranks
    flags = {r["id"]: r["later"] for r in ranking.rank_exceeds_one(df, "email", "middle", "later").collect()}
    assert flags == {i: r > 1 for i, r in ranks.items()}


@pytest.mark.parametrize("parts", [1, 4, 1000])
def test_attach_covers_hot_and_cold_keys(spark, monkeypatch, parts):
    """However many keys count as hot, every row comes back once with its key's value."""
    monkeypatch.setattr(hotkeys, "HOT_KEY_PARTS", parts)
    data = people(7)
    df = spark.createDataFrame(data, "id int, email string, middle string")
    counts = Counter(e for _, e, _ in data)
    per_key = df.groupBy("email").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 5)
    left = hotkeys.attach_by_key(df, per_key, ["email"], ["n"], weight="n")
    assert sorted((r["id"], r["n"]) for r in left.collect()) == sorted(
        (i, counts[e] if counts[e] > 5 else None) for i, e, _ in data
    )
    inner = hotkeys.attach_by_key(df, per_key, ["email"], ["n"], weight="n", how="inner")
    assert sorted(r["id"] for r in inner.collect()) == [i for i, e, _ in data if counts[e] > 5]


def test_attach_on_an_empty_table(spark):
    df = spark.createDataFrame([], "id int, email string, middle string")
    assert ranking.rank_within(df, "email", "middle").count() == 0
    assert ranking.rank_exceeds_one(df, "email", "middle", "later").count() == 0


def test_broadcast_only_within_the_limit(spark):
    df = spark.range(10).toDF("k")
    hinted = hotkeys.broadcast_if_at_most(df, 10)._jdf.queryExecution().analyzed().toString()
    plain = hotkeys.broadcast_if_at_most(df, 9)._jdf.queryExecution().analyzed().toString()
    assert "broadcast" in hinted and "broadcast" not in plain


def test_top_k_with_ties(spark):
    df = spark.createDataFrame([("a", 5), ("b", 4), ("c", 4), ("d", 1)], "state string, n long")
    assert rows(ranking.top_k_with_ties(df, 2, "n")) == [("a", 5), ("b", 4), ("c", 4)]
    assert ranking.top_k_with_ties(df, 10, "n").count() == 4
    assert rows(ranking.top_k(df, 2, F.desc("n"), "state")) == [("a", 5), ("b", 4)]


def test_one_row_per_key(spark):
    data = [("k1", 2, "x"), ("k1", 1, "z"), ("k1", 1, None), ("k2", None, "y"), ("k2", 0, "a"), (None, 3, "n"), (None, 3, "m")]
    for order in (data, data[::-1]):
        df = spark.createDataFrame(order, "k string, a int, b string").repartition(3)
        assert rows(dedup.one_row_per_key(df, "k")) == sorted(
            [("k1", 1, None), ("k2", None, "y"), (None, 3, "m")], key=repr
        )


def test_rows_with_duplicate_key(spark):
    data = [("a", 1), ("a", 1), ("a", 2), ("b", 3), (None, 4), (None, 5)]
    df = spark.createDataFrame(data, "k string, v int")
    assert rows(dedup.duplicate_values(df, "k")) == sorted([("a", 3), (None, 2)], key=repr)
    assert rows(dedup.rows_with_duplicate_key(df, "k")) == [("a", 3, 1), ("a", 3, 1), ("a", 3, 2)]


def test_snapshots(spark):
    before = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "d")], "k int, e string")
    after = spark.createDataFrame([(1, "a"), (2, "B"), (3, "c"), (5, "z")], "k int, e string")
    assert rows(joins.changed_values(before, after, "k", "e", [])) == [(2, "b", "B")]
    assert rows(joins.patch_column(before, after, "k", "e")) == [(1, "a"), (2, "B"), (3, "c"), (4, "d")]


def test_crosswalk_forms(spark):
    customers = spark.createDataFrame([(1, "7501"), (2, "10001"), (3, "99999"), (4, None)], "id int, CUST_ZIP string")
    crosswalk = spark.createDataFrame(
        [("07501", "NJ", "Paterson", "Passaic", "973/862", "5", "Y"), ("10001", "NY", "NYC", "NY", "646/212", "5", "Y"),
         ("10001", "NY", "NYC", "NY", "212/646", "5", "Y"), ("10001", "NY", "NYC", "NY", None, "5", "Y"),
         ("1234567", "XX", "X", "X", "999", "5", "Y")],
        "CUST_ZIP string, CUST_STATE string, CUST_CITY string, CUST_COUNTY string, AREA_CODE string, TIME_ZONE string, DST string",
    )
    assert joins.with_crosswalk_rows(customers, crosswalk).count() == 1 + 3 + 1 + 1
    got = joins.with_area_code(customers, crosswalk).select("id", "AREA_CODE")
    assert rows(got) == sorted([(1, "973"), (2, "212"), (3, None), (4, None)], key=repr)


def test_profile_agrees_with_its_parts_and_with_describe(spark):
    data = [(1, 10.5, "7", "a"), (2, 0.5, "30", ""), (None, 2.0, "x", None), (3, 2.0, "30", "b"), (3, 2.0, "30", "b")]
    df = spark.createDataFrame(data, "i long, d double, t string, s string")
    whole = {r["column_name"]: r.asDict() for r in profile.profile_table(df).collect()}
    for part in (profile.describe_columns, profile.missing_per_column, profile.distinct_per_column):
        for r in part(df).collect():
            for measure, value in r.asDict().items():
                known = whole[r["column_name"]][measure]
                assert known == (pytest.approx(value) if isinstance(value, float) else value)
    assert {r["table_rows"] for r in whole.values()} == {5}
    assert {r["table_distinct_rows"] for r in whole.values()} == {4}
    assert whole["s"]["missing"] == 2 and whole["i"]["missing"] == 1
    described = {r["summary"]: r.asDict() for r in df.describe().collect()}
    for column in df.columns:
        assert str(whole[column]["filled"]) == described["count"][column]
        assert whole[column]["lowest"] == described["min"][column]
        assert whole[column]["highest"] == described["max"][column]
        for measure in ("mean", "stddev"):
            value = described[measure][column]
            assert whole[column][measure] == (None if value is None else pytest.approx(float(value)))


def test_one_to_one(spark):
    good = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "l string, r int")
    bad = spark.createDataFrame([("a", 1), ("a", 2), ("b", 2)], "l string, r int")
    assert rows(profile.one_to_one(good, "l", "r")) == [(2, 2, 2, True)]
    assert rows(profile.one_to_one(bad, "l", "r")) == [(2, 2, 3, False)]
