"""Joining a per-key table back to its rows when one key may hold much of the table.

A plain shuffle join sends all rows of a key to one task, and adaptive skew
splitting does not apply when one side is itself an aggregate. Keys that hold more
than a thousandth of the rows in question are therefore served by broadcast; there can be at most
999 of them, whatever the size of the table. All other keys are small by definition and go through an ordinary
join, in which the rows already served are spread by a salt.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.sources.writers import land

HOT_KEY_PARTS = 1000
SPREAD = 1 << 20


def null_safe_match(left: list[str], right: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right)])


def attach_by_key(
    df: DataFrame, per_key: DataFrame, keys: list[str], values: list[str], weight: str, how: str = "left"
) -> DataFrame:
    """Add the ``values`` columns of ``per_key`` (one row per key) to the rows of ``df``.

    ``weight`` is the column of ``per_key`` with the number of rows that key has in
    ``df``. Null keys match null keys. ``how`` is ``left`` or ``inner``.

    One branch, in which ``df`` is read once: the hot keys and their values are broadcast and serve their rows in place; a served
    row then goes under no key and a number of its own, so that the join for all other keys, if it needs a shuffle, spreads
    the hot rows evenly. ``per_key`` is written to the shared folder first: it is read several times, and Spark
    then knows its size, so that a small one is broadcast and ``df`` not shuffled at all.
    """
    key_names = [f"__key_{i}" for i in range(len(keys))]
    table = land(
        per_key.select(
            *[F.col(k).alias(n) for k, n in zip(keys, key_names)], *values, F.col(weight).alias("__weight")
        ),
        "per-key",
    )
    is_hot = F.col("__weight") * HOT_KEY_PARTS > table.agg(F.sum("__weight")).scalar()

    def side(rows: DataFrame, name: str) -> DataFrame:
        """The values as one column, whose presence tells that the key was there."""
        own = [F.col(n).alias(f"__{name}{n}") for n in key_names]
        return rows.select(*own, F.struct(F.lit(True).alias("served"), *values).alias(f"__{name}"))

    served = df.join(F.broadcast(side(table.filter(is_hot), "hot")), null_safe_match(keys, [f"__hot{n}" for n in key_names]), "left")
    # the number differs between the rows of a partition as their content does, between equal rows as their partitions do
    number = F.lit(1) + F.pmod(F.xxhash64(*df.columns, F.spark_partition_id()), F.lit(SPREAD))
    salted = served.withColumn("__salt", F.when(F.col("__hot").isNotNull(), number).otherwise(0))
    cold = side(table.filter(~is_hot), "cold").withColumn("__cold_salt", F.lit(0).cast("long"))
    on = null_safe_match(keys, [f"__cold{n}" for n in key_names]) & (F.col("__salt") == F.col("__cold_salt"))
    joined = salted.join(cold, on, "left")
    if how == "inner":
        joined = joined.filter(F.col("__hot").isNotNull() | F.col("__cold").isNotNull())
    found = F.coalesce("__hot", "__cold")
    return joined.select(*df.columns, *[found.getField(v).alias(v) for v in values])


def broadcast_if_at_most(df: DataFrame, limit: int) -> DataFrame:
    """Hint a broadcast only after counting that ``df`` has no more than ``limit`` rows.

    The count stops at ``limit`` + 1 rows. A larger table is returned without the
    hint, so that Spark shuffles both sides and AQE may split skewed partitions.
    """
    within = df.limit(limit + 1).count() <= limit
    return F.broadcast(df) if within else df
