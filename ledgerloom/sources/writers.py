"""Writers. Parquet is the default target; a database is reached through the JDBC writer."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.session import new_path


def append_rows(df: DataFrame, path: str) -> None:
    """Add rows to a table. Running it twice adds them twice: see ``append_new_rows``."""
    df.write.mode("append").parquet(path)


def new_rows(df: DataFrame, stored: DataFrame | None, keys: list[str]) -> DataFrame:
    """One row for each key that ``stored`` does not hold, the smallest in column order; null is a key like any other.

    Of the stored keys only those between the smallest and the largest of the new ones are read: where keys grow with
    time, or the table is laid out by them, the scan skips nearly all of it. The new rows are written first, as they are read twice.
    """
    rest = [c for c in df.columns if c not in keys]
    once = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("__row")).select(*keys, "__row.*").select(df.columns)
    if stored is None:
        return once
    once = land(once, "new-rows")
    key = F.col(keys[0])
    low, high, nulls = once.agg(F.min(key), F.max(key), F.count_if(key.isNull())).first()
    span = F.lit(False) if low is None else key.between(F.lit(low), F.lit(high))
    stored = stored.filter(span | key.isNull() if nulls else span)
    held = stored.select(*[F.col(k).alias(f"__held_{i}") for i, k in enumerate(keys)])
    return once.join(held, [F.col(k).eqNullSafe(F.col(f"__held_{i}")) for i, k in enumerate(keys)], "left_anti")


def append_new_rows(df: DataFrame, path: str, keys: list[str]) -> None:
    """Add only rows whose key the table does not hold yet, one for each key, so that a rerun changes nothing."""
    try:
        stored = df.sparkSession.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        stored = None
    append_rows(new_rows(df, stored, keys), path)


def land(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    For feeds that are costly to parse and read more than once. The table is plain
    Parquet, so nothing has to be parsed again when an executor is lost.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def overwrite_rows(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Replace a table.

    A partitioned table is rebalanced by its partition columns first: each task then
    writes few directories, and AQE splits a partition that holds too many rows.
    """
    if not partition_by:
        df.write.mode("overwrite").parquet(path)
        return
    df.hint("rebalance", *partition_by).write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def overwrite_clustered(
    df: DataFrame, path: str, cluster_by: list[str], partition_by: list[str] | None = None, row_group_bytes: int | None = None
) -> None:
    """Replace a table, its rows laid out by ranges of ``cluster_by`` within each partition and sorted in every file.

    A file then spans few values of the first cluster column, and so do its row groups and pages: a pushed filter on
    it skips nearly all of them by their bounds, and the bloom filters that are written for it skip the rest. A value with very many
    rows fills as many files as it needs, told apart by the further cluster columns. Ranges come from a sample
    of the rows, which reads them twice, so they are written first.
    """
    keys = [*(partition_by or []), *cluster_by]
    ranged = land(df, "rows-to-cluster").repartitionByRange(*keys).sortWithinPartitions(*keys)
    writer = ranged.write.mode("overwrite").option(f"parquet.bloom.filter.enabled#{cluster_by[0]}", "true")
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def ensure_table(spark: SparkSession, name: str, schema: T.StructType, path: str | None = None) -> None:
    """Create an empty typed table unless it exists; an existing one must have the same columns."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    place = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{place}")
    found = [(f.name.lower(), f.dataType) for f in spark.table(name).schema.fields]
    wanted = [(f.name.lower(), f.dataType) for f in schema.fields]
    if found != wanted:
        raise ValueError(f"table {name} exists with other columns: {found}")


def append_to_table(df: DataFrame, name: str) -> None:
    """Add rows to a catalog table, matching columns by name."""
    df.select(*df.sparkSession.table(name).columns).write.mode("append").insertInto(name)


def jdbc_write_options(url: str, table: str, partitions: int | None = None, batch_rows: int = 10_000) -> dict[str, str]:
    """Options for a batched write, over at most ``partitions`` connections if the database needs such a limit."""
    limit = {} if partitions is None else {"numPartitions": str(partitions)}
    return {"url": url, "dbtable": table, "batchsize": str(batch_rows), **limit}


def write_jdbc(df: DataFrame, url: str, table: str, user: str, password: str, mode: str, **tuning) -> None:
    """Append to or overwrite a database table."""
    options = jdbc_write_options(url, table, **tuning)
    df.write.format("jdbc").mode(mode).options(**options).options(user=user, password=password).save()
