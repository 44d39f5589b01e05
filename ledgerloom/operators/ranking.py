"""Ranks, top-k and ties without gathering a group, or the whole table, in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.hotkeys import attach_by_key
from ledgerloom.operators.running_totals import with_running_total


def rank_within(df: DataFrame, group: str, order: str, name: str = "rank") -> DataFrame:
    """``rank() OVER (PARTITION BY group ORDER BY order NULLS FIRST)``.

    A row's rank is one plus the number of rows of its group that sort before it, so it follows from the running total of
    counts of distinct (group, order) pairs. These are dealt by ranges of both columns: a group whose
    values are many fills as many ranges as it needs. No window ever sees the rows themselves.
    """
    counted = df.groupBy(group, order).agg(F.count(F.lit(1)).alias("__n"))
    running = with_running_total(counted, [group], [F.col(order).asc_nulls_first()], "__n", "__before")
    ranked = running.select(group, order, "__n", (F.lit(1) + F.col("__before")).alias(name))
    return attach_by_key(df, ranked, [group, order], [name], weight="__n")


def rank_exceeds_one(df: DataFrame, group: str, order: str, name: str) -> DataFrame:
    """Flag rows whose rank within the group is above one.

    That is the case exactly when some row of the group sorts before it, so the
    smallest value of the group is all that is needed. Groups in which every value is
    the same never reach the join.
    """
    value = F.col(order)
    extremes = df.groupBy(group).agg(
        F.count(F.lit(1)).alias("__n"),
        F.min(value).alias("__low"),
        F.max(value).alias("__high"),
        F.max(value.isNull()).alias("__has_null"),
    )
    mixed = extremes.filter((F.col("__low") < F.col("__high")) | (F.col("__has_null") & F.col("__low").isNotNull()))
    rows = attach_by_key(df, mixed, [group], ["__low", "__has_null"], weight="__n")
    later = value.isNotNull() & (F.col("__has_null") | (value > F.col("__low")))
    return rows.withColumn(name, F.coalesce(later, F.lit(False))).drop("__low", "__has_null")


def top_k(df: DataFrame, k: int, by: Column, *tie_break: str) -> DataFrame:
    """The first ``k`` rows by ``by``; ties are settled by the named columns."""
    return df.orderBy(by, *tie_break).limit(k)


def top_k_with_ties(df: DataFrame, k: int, metric: str) -> DataFrame:
    """All rows whose metric is at least the k-th highest; all rows if there are fewer."""
    kth_highest = df.select(metric).orderBy(F.desc(metric)).limit(k).agg(F.min(metric)).scalar()
    return df.filter(F.col(metric) >= kth_highest)
