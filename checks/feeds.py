"""Raw feeds written by Spark from the role views, in the formats the readers take."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.labels import state_name
from ledgerloom.session import new_path

FILE_RECORDS = 100_000
NULL_VALUE = r"\N"


def write_json_arrays(df: DataFrame, name: str, compression: str = "gzip") -> str:
    """Pretty-printed JSON arrays of at most ``FILE_RECORDS`` records a file, compressed as feeds are delivered.

    A task passes its records on in batches, each behind the one that is held until it is known whether it is the last.
    A feed that is to be read in ranges must not be compressed.
    """
    size = FILE_RECORDS

    def lines(records: pa.Array, first: int, last: bool) -> pa.RecordBatch:
        at = np.arange(first, first + len(records))
        ends = at % size == size - 1
        if last:
            ends[-1] = True
        opening = pa.array(np.where(at % size == 0, "[\n", ""), pa.string())
        closing = pa.array(np.where(ends, "\n]", ","), pa.string())
        return pa.RecordBatch.from_arrays([pc.binary_join_element_wise(opening, records, closing, "")], ["value"])

    def to_arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if held is not None:
                yield lines(held, n, False)
                n += len(held)
            held = batch.column(0)
        if held is not None:
            yield lines(held, n, True)

    path = new_path(df.sparkSession, name)
    records = df.select(F.to_json(F.struct(*df.columns), {"pretty": "true"}).alias("record"))
    arrays = records.mapInArrow(to_arrays, "value string")
    arrays.write.option("maxRecordsPerFile", size).option("compression", compression).text(path)
    return path


def write_json_lines(df: DataFrame, name: str) -> str:
    path = new_path(df.sparkSession, name)
    df.write.json(path)
    return path


def write_headerless_csv(df: DataFrame, name: str) -> str:
    """Values as they are, with ``NULL_VALUE`` for null, so that null, empty and blank stay three things."""
    path = new_path(df.sparkSession, name)
    options = {"header": False, "nullValue": NULL_VALUE, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.options(**options).csv(path)
    return path


def write_state_features(customers: DataFrame, branches: DataFrame, name: str) -> str:
    """GeoJSON collections, one for each initial letter, of the states that occur.

    There are fifty states with a name, which bounds every collection.
    """
    path = new_path(customers.sparkSession, name)
    codes = customers.select(F.col("CUST_STATE").alias("code")).union(branches.select("BRANCH_STATE"))
    names = codes.distinct().select(state_name(F.col("code")).alias("name")).filter(F.col("name").isNotNull())
    feature = F.struct(F.lit("Feature").alias("type"), F.struct("name").alias("properties"))
    collections = names.groupBy(F.substring("name", 1, 1).alias("initial")).agg(F.collect_list(feature).alias("features"))
    documents = collections.select(F.lit("FeatureCollection").alias("type"), "features")
    documents.write.option("maxRecordsPerFile", 1).json(path)
    return path
