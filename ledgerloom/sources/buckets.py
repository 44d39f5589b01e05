"""Tables stored by the hash of a key, so that joins and groups on it need no shuffle, whatever reads them.

Tables of one key and number of buckets fit together: Spark joins bucket with bucket. A key with more rows than a fair bucket would make
one bucket, and so one task, too large; such keys are told apart when the table is written and kept beside it, unbucketed. There
are fewer of them than buckets, so what another table has for them is small, and broadcast.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.hotkeys import broadcast_if_at_most
from ledgerloom.sources.writers import land

ROWS_A_KEY = 100


def _hot(name: str) -> str:
    return f"{name}_hot"


def write_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int) -> None:
    """Store ``df`` as the catalog table ``name`` in ``buckets`` buckets of ``key``, sorted by it, and its hot keys as ``name``_hot.

    A key is hot if it has more than its share, one of ``buckets`` parts, of the rows: there are fewer than ``buckets`` of those. Every
    bucket is written by one task as one file. The input is written first, as it is read twice.
    """
    rows = land(df, "rows-to-bucket")
    counts = land(rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")), "rows-by-key")
    hot = counts.filter(F.col("n") * buckets > F.lit(rows.count())).select(F.col(key).alias("__hot"))
    marked = rows.join(F.broadcast(hot.withColumn("__is_hot", F.lit(True))), F.col(key).eqNullSafe(F.col("__hot")), "left")
    cold = marked.filter(F.col("__is_hot").isNull()).select(df.columns).repartition(buckets, key)
    cold.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).option("path", f"{path}/buckets").saveAsTable(name)
    marked.filter("__is_hot").select(df.columns).write.mode("overwrite").option("path", f"{path}/hot").saveAsTable(_hot(name))


def open_bucketed(spark: SparkSession, name: str, path: str, key: str, buckets: int) -> None:
    """Make a stored table known to the catalog of another session."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(f"{path}/hot").schema.fields)
    layout = f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet {layout} LOCATION '{path}/buckets'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_hot(name)} ({columns}) USING parquet LOCATION '{path}/hot'")


def read_bucketed(spark: SparkSession, name: str) -> DataFrame:
    """All rows."""
    return spark.table(name).unionByName(spark.table(_hot(name)))


def join_bucketed(spark: SparkSession, left: str, right: str, key: str, buckets: int, right_columns: list[str]) -> DataFrame:
    """Inner join of two tables of the same ``key`` and number of ``buckets``: bucket with bucket, and the hot keys of each by broadcast.

    The columns of ``left`` and ``right_columns``. Neither table is shuffled. A key that is hot on both sides has many rows of each,
    and is left to an ordinary join, whose skew AQE splits.
    """
    more = [c for c in right_columns if c != key]
    a, b = spark.table(left), spark.table(right).select(key, *more)
    hot_a, hot_b = spark.table(_hot(left)), spark.table(_hot(right)).select(key, *more)

    def few(rows: DataFrame, keys: DataFrame) -> DataFrame:
        """Rows of one table for the hot keys of the other: broadcast if they are as few as keys, after a count."""
        own = rows.join(F.broadcast(keys.select(key).distinct()), key, "left_semi")
        return broadcast_if_at_most(own, ROWS_A_KEY * buckets)

    parts = [a.join(b, key), hot_a.join(few(b, hot_a), key), few(a, hot_b).join(hot_b, key), hot_a.join(hot_b, key)]
    return reduce(DataFrame.unionByName, [part.select(*a.columns, *more) for part in parts])


def parts_bucketed(spark: SparkSession, name: str) -> tuple[DataFrame, DataFrame]:
    """The bucketed rows of a table, and those of its hot keys."""
    return spark.table(name), spark.table(_hot(name))
