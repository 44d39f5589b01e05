"""Running totals, and values carried from row to row, within groups of any size."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.sources.writers import land


def with_running_total(df: DataFrame, groups: list[str], order: list[Column], value: str, name: str) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the rows of the same group that come before, in ``order``.

    Rows are dealt by ranges of (group, order) and written, so a range is a file of bounded size
    however large its group is. Totals are kept within a range by a window, and carried from range to
    range by a window over one row for each group and range. Null groups are groups. Rows that tie in
    ``order`` are placed in any order, so ties must be alike in all that matters.
    """
    keys = [F.col(g).asc_nulls_last() for g in groups]
    ranged = land(df.repartitionByRange(*keys, *order).withColumn("__range", F.spark_partition_id()), "ranges")
    sums = ranged.groupBy(*groups, "__range").agg(F.sum(value).alias("__sum"))
    earlier = (Window.unboundedPreceding, -1)
    over_ranges = Window.partitionBy(*groups).orderBy("__range").rowsBetween(*earlier)
    carried = sums.select(
        *[F.col(g).alias(f"__group_{i}") for i, g in enumerate(groups)],
        F.col("__range").alias("__its_range"),
        F.coalesce(F.sum("__sum").over(over_ranges), F.lit(0)).alias("__carried"),
    )
    in_range = Window.partitionBy("__range", *groups).orderBy(*order).rowsBetween(*earlier)
    within = ranged.withColumn("__before", F.coalesce(F.sum(value).over(in_range), F.lit(0)))
    same = [F.col(g).eqNullSafe(F.col(f"__group_{i}")) for i, g in enumerate(groups)]
    on = reduce(lambda a, b: a & b, same, F.col("__range") == F.col("__its_range"))
    total = (F.col("__before") + F.col("__carried")).alias(name)
    return within.join(land(carried, "carried"), on).select(*df.columns, total)


def with_previous_value(df: DataFrame, groups: list[str], order: list[Column], value: str, name: str, ranges: int) -> DataFrame:
    """Add ``name``: ``value`` in the row of the same group that comes just before, in ``order``; null in the first.

    Rows are dealt to ``ranges`` ranges of (group, order) of about equal numbers of rows and written, so a group of any size is as
    many bounded files as it needs. Within a range the value is carried by a window, and into a range by a window
    over one row for each group and range: the last value there. Null groups are groups. Rows that tie in ``order`` share a range and
    are placed in any order, so ``value`` should be part of the order.
    """
    keys = [F.col(g).asc_nulls_last() for g in groups]
    dealt = df.repartitionByRange(ranges, *keys, *order).sortWithinPartitions(*keys, *order)
    ranged = land(dealt.withColumn("__range", F.spark_partition_id()), "ranges")
    in_range = Window.partitionBy("__range", *groups).orderBy(*order)
    place = F.row_number().over(in_range)
    within = ranged.withColumn("__place", place).withColumn("__within", F.lag(value).over(in_range))
    # structs, so that a last value of null is told from no row
    newest = F.max(F.struct(F.col("__place"), F.col(value).alias("value"))).getField("value")
    last = within.groupBy(*groups, "__range").agg(F.struct(newest.alias("value")).alias("__last"))
    over_ranges = Window.partitionBy(*groups).orderBy("__range")
    carried = last.select(
        *[F.col(g).alias(f"__group_{i}") for i, g in enumerate(groups)],
        F.col("__range").alias("__its_range"),
        F.lag("__last").over(over_ranges).getField("value").alias("__carried"),
    )
    same = [F.col(g).eqNullSafe(F.col(f"__group_{i}")) for i, g in enumerate(groups)]
    on = reduce(lambda a, b: a & b, same, F.col("__range") == F.col("__its_range"))
    own = F.when(F.col("__place") == 1, F.col("__carried")).otherwise(F.col("__within"))
    return within.join(land(carried, "carried"), on).select(*df.columns, own.alias(name))
