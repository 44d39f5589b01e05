"""Duplicate keys: finding them, showing their rows, keeping one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.hotkeys import attach_by_key


def duplicate_values(df: DataFrame, key: str, name: str = "num_records", copies: str | None = None) -> DataFrame:
    """Values of ``key`` that occur more than once, with their number of rows.

    A row counts as many times as the column ``copies`` says, if there is one.
    """
    return df.groupBy(key).agg((F.sum(copies) if copies else F.count(F.lit(1))).alias(name)).filter(F.col(name) > 1)


def rows_with_duplicate_key(df: DataFrame, key: str, copies: str | None = None) -> DataFrame:
    """Full rows of every repeated key, with ``num_records``; null keys are not compared.

    The rows are read twice, once for their counts and once to be returned; what makes them is not written in between.
    With ``copies`` a row counts as often as that column says, and comes once, without it: what repeats it follows later.
    """
    known = df.filter(F.col(key).isNotNull()).groupBy(key)
    records = F.sum(copies) if copies else F.count(F.lit(1))
    repeated = known.agg(records.alias("num_records"), F.count(F.lit(1)).alias("__n")).filter("num_records > 1")
    rows = attach_by_key(df, repeated, [key], ["num_records"], "__n", "inner")
    return rows.select(key, "num_records", *[c for c in df.columns if c not in (key, copies)])


def one_row_per_key(df: DataFrame, *keys: str) -> DataFrame:
    """One row for each key: the smallest in column order, nulls first.

    ``min`` over a struct is an aggregate, so copies of a key are reduced before the
    shuffle, and the choice does not depend on how the rows were partitioned.
    """
    rest = [c for c in df.columns if c not in keys]
    smallest = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("__row"))
    return smallest.select(*keys, "__row.*").select(df.columns)
