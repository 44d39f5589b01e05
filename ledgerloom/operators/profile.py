"""Table profiles: all columns of a table are measured together, not one by one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.sources.writers import land

SEED = 8_191
NUMBER = r"^\s*[-+]?[0-9.]+([eE][-+]?[0-9]+)?\s*$"

# Measures of one column as SQL text: {c} is the column, {number} its value as a number.
MISSING = {"missing": "count_if({c} is null or cast({c} as string) = '')"}
DESCRIPTION = {
    "filled": "count({c})",
    "mean": "avg({number})",
    "stddev": "stddev({number})",
    "lowest": "cast(min({c}) as string)",
    "highest": "cast(max({c}) as string)",
}
ROWS = {"table_rows": "count(1)"}


def _number(name: str, dtype: T.DataType) -> str:
    """A column as a number for mean and deviation; text that is no number is ignored.

    The pattern comes first because a failed cast of text costs far more than a match.
    """
    if isinstance(dtype, T.NumericType):
        return f"cast({name} as double)"
    if isinstance(dtype, T.StringType):
        return f"case when {name} rlike r'{NUMBER}' then try_cast({name} as double) end"
    return "cast(null as double)"


def _one_row_per_column(df: DataFrame, columns: list[str] | None, measures: dict[str, str]) -> DataFrame:
    """One global aggregation, whose single row becomes one row for each column."""
    columns = columns or df.columns
    types = {f.name: f.dataType for f in df.schema.fields}
    aggregates, rows = [], []
    for i, column in enumerate(columns):
        name = f"`{column}`"
        number = _number(name, types[column])
        aggregates += [f"{sql.format(c=name, number=number)} as {m}_{i}" for m, sql in measures.items()]
        fields = ", ".join(f"'{m}', {m}_{i}" for m in measures)
        rows.append(f"named_struct('column_name', '{column}', {fields})")
    return df.selectExpr(*aggregates).selectExpr(f"inline(array({', '.join(rows)}))")


def missing_per_column(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Null or empty values of each column."""
    return _one_row_per_column(df, columns, MISSING)


def describe_columns(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Filled values, mean, deviation, lowest and highest of each column."""
    return _one_row_per_column(df, columns, DESCRIPTION)


def _plain(df: DataFrame, name: str) -> Column:
    """A column in which the two zeros of a floating-point type are one, and nested values are text."""
    column, dtype = F.col(f"`{name}`"), df.schema[name].dataType
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.when(column == 0, F.abs(column)).otherwise(column)
    return column if isinstance(dtype, T.AtomicType) else column.cast("string")


def _identity(*columns: Column) -> list[Column]:
    """128 bits that tell values apart: two hashes from different seeds."""
    return [F.xxhash64(*columns).alias("high"), F.xxhash64(F.lit(SEED), *columns).alias("low")]


def _cells(df: DataFrame, columns: list[str], rows: bool) -> DataFrame:
    """``place, high, low`` of each value that is not null, and with ``rows`` of each whole row, under the place after the last column."""
    cells = [F.when(F.col(f"`{c}`").isNotNull(), F.struct(F.lit(i).alias("place"), *_identity(_plain(df, c).cast("string")))) for i, c in enumerate(columns)]
    if rows:
        # nulls leave a hash as it is, so each column says whether it is one
        parts = [part for c in df.columns for part in (F.col(f"`{c}`").isNull(), _plain(df, c))]
        cells.append(F.struct(F.lit(len(columns)).alias("place"), *_identity(*parts)))
    return df.select(F.inline(F.array_compact(F.array(*cells))))


def _distinct_counts(df: DataFrame, columns: list[str], rows: bool) -> DataFrame:
    """``place, distinct_values`` from one pass over the table: what is shuffled are numbers, each distinct value once per map task."""
    counted = _cells(df, columns, rows).groupBy("place").agg(F.count_distinct("high", "low").alias("distinct_values"))
    places = df.sparkSession.range(len(columns) + rows).select(F.col("id").cast("int").alias("place"))
    return places.join(counted, "place", "left").fillna(0, ["distinct_values"])


def _named(counts: DataFrame, columns: list[str]) -> DataFrame:
    names = F.array(*[F.lit(c) for c in columns])
    return counts.filter(F.col("place") < len(columns)).select(F.get(names, F.col("place")).alias("column_name"), "distinct_values")


def distinct_per_column(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Distinct non-null values of each column.

    Values are compared by 128 bits of their text, so that a column of long texts that are nearly all different shuffles numbers and
    not texts: with 10^12 different values the chance of one being missed is below 10^-14. Several distinct
    aggregates side by side would copy the whole row once for each column. A column of an empty table has 0.
    """
    columns = columns or df.columns
    return _named(_distinct_counts(df, columns, rows=False), columns)


def row_totals(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def distinct_rows(df: DataFrame, copies: str | None = None) -> DataFrame:
    """Number of distinct rows; each counts as many times as the column ``copies``, which all others decide, says, if there is one."""
    if copies:
        return df.distinct().agg(F.coalesce(F.sum(copies), F.lit(0)).cast("long").alias("distinct_rows"))
    return row_totals(df.distinct()).withColumnRenamed("row_count", "distinct_rows")


def one_to_one(df: DataFrame, left: str, right: str) -> DataFrame:
    """Distinct values of two columns and of their pairs, and whether all three agree.

    Pairs are counted first, so the values are counted over distinct pairs only.
    """
    counts = (
        df.select(left, right)
        .distinct()
        .agg(
            F.countDistinct(left).alias("left_values"),
            F.countDistinct(right).alias("right_values"),
            F.count(F.lit(1)).alias("pairs"),
        )
    )
    same = (F.col("left_values") == F.col("pairs")) & (F.col("right_values") == F.col("pairs"))
    return counts.withColumn("one_to_one", same)


def profile_table(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """All of the above for each column, with the table's row and distinct-row counts.

    Two passes over the table: plain measures need no shuffle at all, distinct values and distinct rows share one of numbers. What is
    joined is one row for each column.
    """
    columns = columns or df.columns
    plain = _one_row_per_column(df, columns, {**DESCRIPTION, **MISSING, **ROWS})
    counts = land(_distinct_counts(df, columns, rows=True), "distinct-counts")
    of_rows = counts.filter(F.col("place") == len(columns)).select(F.col("distinct_values").alias("table_distinct_rows"))
    return plain.join(_named(counts, columns), "column_name", "left").select("*", of_rows.scalar().alias("table_distinct_rows"))
