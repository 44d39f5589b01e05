"""Readers. Production reads use the explicit schemas; only ``read_records_inferred`` infers.

A file whose JSON records span lines is read by one task, so large feeds should be
delivered in many files, or one record per line (``multiline=False``), which splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom import schemas

CORRUPT = "_corrupt_record"


def read_json_records(spark: SparkSession, path: str, schema: T.StructType, multiline: bool = True) -> DataFrame:
    """Pretty-printed or array JSON under a fixed schema; a record that does not fit fails the read."""
    return spark.read.schema(schema).option("multiLine", multiline).option("mode", "FAILFAST").json(path)


def read_json_with_rejects(spark: SparkSession, path: str, schema: T.StructType, multiline: bool = True) -> DataFrame:
    """As ``read_json_records``, but broken records are kept as text in ``_corrupt_record``.

    Store the full rows before asking for rejects: Spark checks only columns a query reads.
    """
    checked = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return (
        spark.read.schema(checked)
        .option("multiLine", multiline)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )


def read_crosswalk(spark: SparkSession, path: str, null_value: str = "", multiline: bool = False) -> DataFrame:
    """Headerless ZIP crosswalk, columns named by position; ZIPs stay text, blanks around a value are part of it.

    ``null_value`` is what the feed writes for null. While that is the empty text, as Spark has it, empty values
    are null; a feed with a mark of its own keeps empty, blank and null apart. Values may hold line ends with ``multiline``.
    """
    options = {"header": False, "mode": "FAILFAST", "nullValue": null_value, "multiLine": multiline}
    kept = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    return spark.read.schema(schemas.CROSSWALK).options(**options, **kept).csv(path)


def read_records_inferred(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """JSON records with the schema taken from the data, for a first look at a new feed."""
    return spark.read.option("multiLine", multiline).json(path)


def read_loans(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Loan applications under their fixed schema; a value of the wrong type fails the read."""
    return read_json_records(spark, path, schemas.LOAN, multiline)


def read_feature_names(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """``properties.name`` of every feature of the GeoJSON collections under ``path``."""
    collections = read_json_records(spark, path, schemas.GEOJSON, multiline)
    return collections.select(F.explode("features").alias("feature")).select(F.col("feature.properties.name"))


def read_table(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """A stored table, restricted to the columns asked for."""
    table = spark.read.parquet(path)
    return table.select(*columns) if columns else table


def jdbc_read_options(
    url: str,
    table: str,
    partition_column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    partitions: int | None = None,
    fetch_rows: int = 10_000,
) -> dict[str, str]:
    """Options for a parallel read: one range of ``partition_column`` per connection."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_rows)}
    bounds = {
        "partitionColumn": partition_column,
        "lowerBound": lower,
        "upperBound": upper,
        "numPartitions": partitions,
    }
    given = {name: str(value) for name, value in bounds.items() if value is not None}
    if given and len(given) != len(bounds):
        raise ValueError("a partitioned read needs the column, both bounds and the number of partitions")
    return {**options, **given}


def read_jdbc(spark: SparkSession, url: str, table: str, user: str, password: str, **split) -> DataFrame:
    options = jdbc_read_options(url, table, **split)
    return spark.read.format("jdbc").options(**options).options(user=user, password=password).load()
