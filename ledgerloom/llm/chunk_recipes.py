"""Exact deduplication by content-defined chunk recipes.

Texts are cut where a rolling hash of the last 32 bytes ends in zeros, so equal passages are cut
alike wherever they stand. A chunk is named by a digest of its bytes. The names are verified: the
chunks of one name meet once, as the smallest and the largest content of that name, and each distinct
chunk of a task is sent once however often it occurs. From then on a document is its ordered list of names,
and only those short lists are grouped; a long document is never moved again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.textbytes import id_and_text, slices
from ledgerloom.operators.hotkeys import attach_by_key, broadcast_if_at_most
from ledgerloom.sources.writers import land

WINDOW = 32
DIGEST_BYTES = 16
BROADCAST_ROWS = 500_000
_GEAR = np.random.default_rng(20_240_501).integers(0, 1 << 32, 256, dtype=np.uint32)


def cut_points(data: np.ndarray, offsets: np.ndarray, mean: int, least: int, most: int) -> list[list[int]]:
    """For each text, where its chunks end (relative to the slice).

    ``least`` must be at least the window, so that no cut depends on the text before.
    """
    rolling = _GEAR[data]
    step = 1
    while step < WINDOW:
        rolling[step:] += rolling[:-step] << np.uint32(step)
        step *= 2
    bits = max(1, mean.bit_length() - 1)
    wanted = np.flatnonzero(rolling >> np.uint32(32 - bits) == 0) + 1
    cuts = []
    for start, end in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        own, at = [], start
        for place in wanted[np.searchsorted(wanted, start) : np.searchsorted(wanted, end)].tolist():
            while place - at > most:
                at += most
                own.append(at)
            if place - at >= least:
                own.append(place)
                at = place
        while end - at > most:
            at += most
            own.append(at)
        if end > at or not own:
            own.append(end)
        cuts.append(own)
    return cuts


def _name(chunk: bytes, size: int) -> bytes:
    """A digest of ``size`` bytes; over 16, followed by a second, unrelated digest."""
    name = hashlib.blake2b(chunk, digest_size=min(size, DIGEST_BYTES)).digest()
    return name if size <= DIGEST_BYTES else name + hashlib.sha256(chunk).digest()


def _chunks(batches: Iterator[pa.RecordBatch], size: int, mean: int, least: int, most: int) -> Iterator[tuple]:
    for part, data, offsets in slices(batches):
        whole = data.tobytes()
        for row, (start, ends) in enumerate(zip(offsets[:-1].tolist(), cut_points(data, offsets, mean, least, most))):
            yield part, row, [whole[a:b] for a, b in zip([start, *ends[:-1]], ends)]


def chunk_table(documents: DataFrame, size: int = DIGEST_BYTES, mean: int = 4096, least: int = 1024, most: int = 65536) -> DataFrame:
    """Every chunk with its name, distinct within a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, bytes] = {}
        volume = 0
        seen: set[tuple[bytes, int]] = set()
        for _, _, chunks in _chunks(batches, size, mean, least, most):
            for chunk in chunks:
                name = _name(chunk, size)
                other = held.get(name)
                if other == chunk:
                    continue
                if other is not None:
                    mark = (name, hash(chunk))
                    if mark not in seen:
                        seen.add(mark)
                        yield pa.RecordBatch.from_pydict({"name": [name], "content": [chunk]})
                    continue
                held[name] = chunk
                volume += len(chunk)
            if volume > 1 << 24:
                yield pa.RecordBatch.from_pydict({"name": list(held), "content": list(held.values())})
                held, volume, seen = {}, 0, set()
        if held:
            yield pa.RecordBatch.from_pydict({"name": list(held), "content": list(held.values())})

    return id_and_text(documents).mapInArrow(run, "name binary, content binary")


def names_clash(documents: DataFrame, **cutting: int) -> bool:
    """Whether two different chunks share a name: every chunk of a name is compared with the others, byte by byte."""
    contents = chunk_table(documents, **cutting).groupBy("name").agg(F.min("content").alias("low"), F.max("content").alias("high"))
    return not contents.filter("low != high").limit(1).isEmpty()


def recipes(documents: DataFrame, size: int = DIGEST_BYTES, mean: int = 4096, least: int = 1024, most: int = 65536) -> DataFrame:
    """One row per document: ``doc_id``, the ordered chunk names, their number and the SHA-256 of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, lists, counts, digests = [], [], [], []
        for part, row, chunks in _chunks(batches, size, mean, least, most):
            ids.append(part.column(0)[row].as_py())
            lists.append(b"".join(_name(chunk, size) for chunk in chunks))
            counts.append(len(chunks))
            whole = hashlib.sha256()
            for chunk in chunks:
                whole.update(chunk)
            digests.append(whole.hexdigest())
            if len(ids) == 5000:
                yield _recipe_batch(ids, lists, counts, digests)
                ids, lists, counts, digests = [], [], [], []
        if ids:
            yield _recipe_batch(ids, lists, counts, digests)

    return id_and_text(documents).mapInArrow(run, "doc_id long, recipe binary, n_chunks int, text_sha256 string")


def _recipe_batch(ids: list, lists: list, counts: list, digests: list) -> pa.RecordBatch:
    arrays = [pa.array(ids, pa.int64()), pa.array(lists, pa.binary()), pa.array(counts, pa.int32()), pa.array(digests, pa.string())]
    return pa.RecordBatch.from_arrays(arrays, ["doc_id", "recipe", "n_chunks", "text_sha256"])


def exact_groups(documents: DataFrame, digest_bytes: int = DIGEST_BYTES, **cutting: int) -> DataFrame:
    """For every row of ``documents (doc_id, text)``: the row of its group that stays.

    Returns ``doc_id, keep_id, group_size, kept, text_sha256, n_chunks, row``. Texts are equal when
    all their bytes are; null counts as empty, and all empty texts are one group. The largest
    ``doc_id`` stays; a null id is smaller than any other. Rows that repeat with id and text are one
    group of which exactly one row is kept. Should two different chunks share a name, all names are
    lengthened and verified again. An empty table gives an empty result; other columns are ignored.
    """
    size = digest_bytes
    while names_clash(documents, size=size, **cutting):
        if size > DIGEST_BYTES:
            raise ValueError("two different chunks share both digests")
        size = DIGEST_BYTES if size < DIGEST_BYTES else DIGEST_BYTES + 1
    rows = land(recipes(documents, size=size, **cutting).withColumn("row", F.monotonically_increasing_id()), "recipes")
    several = (
        rows.groupBy("recipe")
        .agg(F.max(F.struct("doc_id", "row")).alias("stays"), F.count(F.lit(1)).alias("group_size"))
        .filter("group_size > 1")
        .select("recipe", "stays", "group_size", F.col("group_size").alias("__n"))
    )
    joined = attach_by_key(rows, several, ["recipe"], ["stays", "group_size"], "__n")
    single = F.col("group_size").isNull()
    return joined.select(
        "doc_id",
        F.when(single, F.col("doc_id")).otherwise(F.col("stays.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (single | (F.col("stays.row") == F.col("row"))).alias("kept"),
        "text_sha256",
        "n_chunks",
        "row",
    )


def without_copies(documents: DataFrame, **options: int) -> DataFrame:
    """``documents``, all columns, with one row of each group of equal texts."""
    decided = land(exact_groups(documents, **options).select("doc_id", "text_sha256", "kept"), "exact-decisions")
    return keep_decided(documents, decided)


def keep_decided(documents: DataFrame, decided: DataFrame) -> DataFrame:
    """The rows of ``documents`` that ``decided (doc_id, text_sha256, kept)``, one row each, keeps.

    Dropped rows are named by id and digest, as they are fewer. Of rows that repeat in both, as
    many stay as are kept; that costs a second branch only where there are any.
    """
    per_key = decided.groupBy("doc_id", "text_sha256").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("kept").alias("n_kept")
    )
    odd = land(per_key.filter("n_kept < n").select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha"), "n_kept"), "dropped")
    # whole rows travel as one column, so that no name of theirs can clash
    rows = documents.select(
        F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"), F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256).alias("sha")
    )
    same = F.col("id").eqNullSafe(F.col("__id")) & (F.col("sha") == F.col("__sha"))
    # few dropped rows are sent to the texts; many, and the texts are shuffled to them
    kept = rows.join(broadcast_if_at_most(odd.select("__id", "__sha"), BROADCAST_ROWS), same, "left_anti").select("row.*")
    one_of_several = odd.filter("n_kept > 0")
    if one_of_several.isEmpty():
        return kept
    repeated = rows.join(one_of_several.select("__id", "__sha"), same, "inner").dropDuplicates(["id", "sha"])
    return kept.unionByName(repeated.select("row.*"))
