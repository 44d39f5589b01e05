"""Tables whose readers see one committed state, for appends that can be repeated and updates that rewrite few files.

A table is a folder of Parquet files and of manifests, numbered from 0. A manifest lists the files of a state, each with the batch
it came with; only files that it lists are read. A job writes its files first and then the next manifest, by one rename that fails
if another job was faster. A job that dies leaves files that no manifest names, and the table as it was. Files are never changed, so a
copy of a table is a manifest in another folder.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

MANIFESTS = "_manifests"


class ConcurrentCommit(RuntimeError):
    """Another job has committed since this one read the table."""


@dataclass(frozen=True)
class State:
    """The files of a table, by path, with the batch of each, and the columns of their rows."""

    version: int
    schema: T.StructType
    files: dict[str, str | None]


def _folder(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def plain_path(spark: SparkSession, uri: str) -> str:
    """The path of a file as manifests have it, from the address Spark tells it by."""
    return spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri)).toString()


def _manifest(path: str, version: int) -> str:
    return f"{path.rstrip('/')}/{MANIFESTS}/{version:012d}.json"


def current(spark: SparkSession, path: str) -> State | None:
    """The last committed state; None where there is no table."""
    system, folder = _folder(spark, f"{path.rstrip('/')}/{MANIFESTS}")
    if not system.exists(folder):
        return None
    names = [status.getPath().getName() for status in system.listStatus(folder)]
    versions = [int(n.removesuffix(".json")) for n in names if n.endswith(".json")]
    if not versions:
        return None
    version = max(versions)
    # one line for each file, so that a long manifest is no single row
    lines = [r[0] for r in spark.read.text(_manifest(path, version)).toLocalIterator()]
    head, *files = [json.loads(line) for line in lines]
    return State(version, T.StructType.fromJson(head["schema"]), {f["path"]: f["batch"] for f in files})


def commit(spark: SparkSession, path: str, state: State) -> None:
    """Make ``state`` the table's next one: its version must be one more than that of the state it was made from."""
    target = _manifest(path, state.version)
    system, place = _folder(spark, target)
    draft = _folder(spark, f"{target}.{uuid.uuid4().hex}.draft")[1]
    lines = [json.dumps({"schema": json.loads(state.schema.json())})]
    lines += [json.dumps({"path": file, "batch": batch}) for file, batch in sorted(state.files.items())]
    stream = system.create(draft, False)
    stream.write(("\n".join(lines) + "\n").encode())
    stream.close()
    if system.exists(place) or not system.rename(draft, place):
        system.delete(draft, False)
        raise ConcurrentCommit(f"version {state.version} of {path} was committed by another job")


def write_files(df: DataFrame, path: str, batch: str | None = None) -> list[str]:
    """Write rows into a fresh folder of the table and return its files; no reader sees them yet."""
    spark = df.sparkSession
    folder = f"{path.rstrip('/')}/data/{uuid.uuid4().hex}"
    df.write.parquet(folder)
    system, place = _folder(spark, folder)
    found = [status.getPath().toString() for status in system.listStatus(place)]
    return [f for f in found if f.endswith(".parquet")]


def read_state(spark: SparkSession, state: State, files: list[str] | None = None) -> DataFrame:
    """The rows of a state, or of some of its files."""
    wanted = list(state.files) if files is None else files
    if not wanted:
        return spark.createDataFrame([], state.schema)
    return spark.read.schema(state.schema).parquet(*wanted)


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the last committed state; a state that is committed later does not change what this frame reads."""
    state = current(spark, path)
    if state is None:
        raise FileNotFoundError(f"no table at {path}")
    return read_state(spark, state)


def _checked(state: State | None, df: DataFrame) -> State:
    nullable = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields])
    if state is None:
        return State(-1, nullable, {})
    if [(f.name, f.dataType) for f in state.schema.fields] != [(f.name, f.dataType) for f in nullable.fields]:
        raise ValueError(f"the table has other columns: {state.schema.simpleString()}")
    return state


def append_batch(df: DataFrame, path: str, batch: str) -> None:
    """Add the rows of ``batch``, or put them in the place of those the batch brought before.

    A job that is run again, after a failure or by mistake, therefore leaves each row once, and nothing that is stored is
    read for it. Rows of other batches stay; the table is made where there is none.
    """
    spark = df.sparkSession
    state = _checked(current(spark, path), df)
    others = {file: b for file, b in state.files.items() if b != batch}
    added = dict.fromkeys(write_files(df, path), batch)
    commit(spark, path, State(state.version + 1, state.schema, others | added))


def replace_files(spark: SparkSession, path: str, state: State, gone: list[str], df: DataFrame) -> None:
    """Commit ``state`` without the files ``gone`` and with the rows of ``df`` instead, which keep no batch."""
    kept = {file: batch for file, batch in state.files.items() if file not in set(gone)}
    added = dict.fromkeys(write_files(df, path), None) if gone else {}
    commit(spark, path, State(state.version + 1, state.schema, kept | added))


def adopt(spark: SparkSession, parquet: str, path: str) -> None:
    """Make a table of the files of a plain Parquet folder, which stay where they are."""
    df = spark.read.parquet(parquet)
    commit(spark, path, State(0, _checked(None, df).schema, dict.fromkeys([plain_path(spark, f) for f in df.inputFiles()], None)))


def clone(spark: SparkSession, path: str, copy: str) -> None:
    """A table with the same rows that can change on its own; no file is copied."""
    state = current(spark, path)
    if state is None:
        raise FileNotFoundError(f"no table at {path}")
    commit(spark, copy, State(0, state.schema, state.files))
