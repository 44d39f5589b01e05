"""Tables under manifests: repeated and broken appends, copies, reads of one state."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerloom.plans import loads
from ledgerloom.session import new_path
from ledgerloom.sources import readers, snapshots, writers
from tests.helpers import rows
from tests.test_card_tables import scanned_rows
from tests.test_loads import BRANCHES, pretty_file


def numbers(spark, start, end, tag="x"):
    return spark.range(start, end, 1, 3).select("id", F.lit(tag).alias("tag"))


def test_a_batch_that_comes_again_replaces_itself(spark):
    path = new_path(spark, "batches")
    snapshots.append_batch(numbers(spark, 0, 30), path, "monday")
    snapshots.append_batch(numbers(spark, 30, 50), path, "tuesday")
    first = snapshots.read_snapshot(spark, path)
    snapshots.append_batch(numbers(spark, 0, 25, "mended"), path, "monday")
    assert rows(snapshots.read_snapshot(spark, path)) == rows(numbers(spark, 0, 25, "mended").union(numbers(spark, 30, 50)))
    assert rows(first) == rows(numbers(spark, 0, 50))
    snapshots.append_batch(numbers(spark, 0, 0), path, "tuesday")
    assert snapshots.read_snapshot(spark, path).count() == 25


def test_a_job_that_dies_half_way_leaves_the_table_as_it_was(spark, monkeypatch):
    path = new_path(spark, "batches")
    snapshots.append_batch(numbers(spark, 0, 10), path, "a")
    snapshots.write_files(numbers(spark, 10, 15), path)

    def fails(id):
        raise RuntimeError("lost")

    broken = numbers(spark, 10, 20).withColumn("id", F.when(F.col("id") == 19, F.raise_error(F.lit("lost"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="lost"):
        snapshots.append_batch(broken, path, "b")
    with monkeypatch.context() as patched:
        patched.setattr(snapshots, "commit", fails)
        with pytest.raises(TypeError):
            snapshots.append_batch(numbers(spark, 10, 20), path, "b")
    assert rows(snapshots.read_snapshot(spark, path)) == rows(numbers(spark, 0, 10))
    for _ in range(2):
        snapshots.append_batch(numbers(spark, 10, 20), path, "b")
    assert rows(snapshots.read_snapshot(spark, path)) == rows(numbers(spark, 0, 20))


def test_other_columns_are_refused_and_missing_tables_told(spark):
    path = new_path(spark, "batches")
    with pytest.raises(FileNotFoundError):
        snapshots.read_snapshot(spark, path)
    snapshots.append_batch(numbers(spark, 0, 10), path, "a")
    with pytest.raises(ValueError):
        snapshots.append_batch(numbers(spark, 0, 10).drop("tag"), path, "b")


def test_copies_share_files_and_change_apart(spark):
    plain, path, copy = (new_path(spark, n) for n in ("plain", "adopted", "copy of it"))
    writers.append_rows(numbers(spark, 0, 10), plain)
    snapshots.adopt(spark, plain, path)
    snapshots.clone(spark, path, copy)
    assert snapshots.current(spark, path).files == snapshots.current(spark, copy).files
    snapshots.append_batch(numbers(spark, 10, 12), copy, "more")
    assert snapshots.read_snapshot(spark, path).count() == 10 and snapshots.read_snapshot(spark, copy).count() == 12


def test_branch_loads_by_delivery_can_be_repeated(spark, tmp_path):
    target = new_path(spark, "branches")
    for name, records in (("mon", BRANCHES[:1]), ("tue", BRANCHES[1:]), ("mon", BRANCHES[:1])):
        loads.load_branches(spark, pretty_file(tmp_path, f"{name}.json", records), target, batch=name)
    stored = snapshots.read_snapshot(spark, target)
    whole = readers.read_json_records(spark, pretty_file(tmp_path, "all.json", BRANCHES), loads.schemas.BRANCH_FEED)
    assert rows(stored) == rows(loads.clean_branches(whole))


def test_new_rows_read_only_stored_keys_in_their_span(spark):
    path = new_path(spark, "keyed")
    writers.overwrite_clustered(spark.range(0, 100_000).select("id", F.lit("old").alias("tag")), path, ["id"], row_group_bytes=16 * 1024)
    fresh = spark.range(99_990, 100_010).select("id", F.lit("new").alias("tag"))
    stored = spark.read.parquet(path)
    added = writers.new_rows(fresh, stored, ["id"])
    assert [r["id"] for r in added.orderBy("id").collect()] == list(range(100_000, 100_010))
    assert scanned_rows(added) < 25_000
    nulls = spark.createDataFrame([(None, "a"), (None, "b"), (5, "c")], "id long, tag string")
    assert rows(writers.new_rows(nulls, stored, ["id"])) == [(None, "a")]
    writers.append_new_rows(nulls, path, ["id"])
    writers.append_new_rows(nulls, path, ["id"])
    assert spark.read.parquet(path).count() == 100_001
