"""Split reading of JSON files that are one large array, pretty-printed or on a single line.

Spark reads such a file in one task. Here the text reader cuts it at closing braces, which it can do from any byte range, and two narrow
passes find the records. The first tells for each range how many quotes and brackets it leaves open, both if it
begins within a string and if it does not; summed up over the ranges of a file, that says in which state each of them begins. The
second cuts out the records; the few that cross from one range into the next are put together from their pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"
_STEP = np.zeros(256, dtype=np.int64)
_STEP[list(b"{[")] = 1
_STEP[list(b"}]")] = -1
_MARK = _STEP != 0
_MARK[ord('"')] = True
_BETWEEN = np.zeros(256, dtype=bool)
_BETWEEN[list(b" \t\r\n,[]")] = True


def _fragments(spark: SparkSession, path: str) -> DataFrame:
    """Files go by a hash of their path: what stands beside every fragment is numbers."""
    text = spark.read.option("lineSep", "}").text(path)
    meta = [F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("_metadata.file_size").alias("size")]
    return text.select(*meta, "value")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, int, np.ndarray, bool]]:
    """``file, block, size, bytes, first`` for the fragments of one range in a batch, each with its brace; ``first`` begins a range."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        files, blocks, sizes = (batch.column(i).to_numpy() for i in range(3))
        changes = np.flatnonzero((files[1:] != files[:-1]) | (blocks[1:] != blocks[:-1])) + 1
        for start, end in zip([0, *changes.tolist()], [*changes.tolist(), len(files)]):
            values = batch.column(3).slice(start, end - start)
            joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values), "}")[0]
            key = int(files[start]), int(blocks[start])
            yield *key, int(sizes[start]), np.frombuffer(joined.as_py().encode() + b"}", np.uint8), key != last
            last = key


def _quotes(data: np.ndarray) -> np.ndarray:
    """Quotes that open or close a string: those behind an even number of backslashes."""
    plain = np.maximum.accumulate(np.where(data != ord("\\"), np.arange(len(data)), -1))
    before = np.concatenate([[-1], plain[:-1]])
    return (data == ord('"')) & ((np.arange(len(data)) - 1 - before) % 2 == 0)


def _marks(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where quotes that count and brackets stand, which of them are quotes, and the step in depth of each if it is in no string."""
    at = np.flatnonzero(_MARK[data])
    quote = data[at] == ord('"')
    if (data == ord("\\")).any():
        own = ~quote | _quotes(data)[at]
        at, quote = at[own], quote[own]
    return at, quote, _STEP[data[at]]


SUMMARY = "file long, block long, size long, bytes long, quotes long, from_outside long, from_string long, first_byte int"


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each range adds: bytes, quotes, and open brackets by the state it begins in. A range comes in some batches, each a row."""
    quotes = 0
    for file, block, size, data, first in _runs(batches):
        quotes = 0 if first else quotes
        _, quote, step = _marks(data)
        odd = (quotes + np.cumsum(quote)) % 2 == 1
        solid = data[~_BETWEEN[data] | (data == ord("["))] if first else data[:0]
        values = [file, block, size, len(data), int(quote.sum()), int(step[~odd].sum()), int(step[odd].sum()), int(solid[0]) if len(solid) else -1]
        quotes += values[4]
        yield pa.RecordBatch.from_arrays([pa.array([v], pa.int32() if i == 7 else pa.int64()) for i, v in enumerate(values)], [c.split()[0] for c in SUMMARY.split(", ")])


def _states(fragments: DataFrame) -> tuple[dict[tuple[int, int], tuple[bool, int, int, int]], bool]:
    """For each range: whether it begins in a string, at what depth, the depth of records, and, if its last brace is not in the file, its bytes with it.

    One entry for each range, as in Spark's own list of tasks. And whether any range ends within a record or a string.
    """
    parts = fragments.mapInArrow(_summaries, SUMMARY).groupBy("file", "block").agg(
        F.max("size").alias("size"), *[F.sum(c).alias(c) for c in ("bytes", "quotes", "from_outside", "from_string")], F.max("first_byte").alias("first_byte")
    )
    order = Window.partitionBy("file").orderBy("block")
    before, whole = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("file")
    in_string = F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1
    added = parts.withColumn("in_string", in_string).withColumn("added", F.when(F.col("in_string"), F.col("from_string")).otherwise(F.col("from_outside")))
    told = added.select(
        "file", "block", "in_string", F.coalesce(F.sum("added").over(before), F.lit(0)).alias("depth"),
        F.when(F.first("first_byte").over(order) == ord("["), 1).otherwise(0).alias("level"),
        F.sum("quotes").over(order).alias("quotes_after"), F.sum("added").over(order).alias("depth_after"),
        "bytes", ((F.sum("bytes").over(whole) == F.col("size") + 1) & (F.max("block").over(whole) == F.col("block"))).alias("open_ended"),
    )
    states, crossed = {}, False
    for r in told.toLocalIterator():
        states[(r["file"], r["block"])] = (r["in_string"], r["depth"], r["level"], r["bytes"] if r["open_ended"] else 0)
        in_string = r["quotes_after"] % 2 == 1
        # a brace that is not in the file has closed nothing
        crossed |= in_string or r["depth_after"] + r["open_ended"] > r["level"]
    return states, crossed


FOUND = "file long, block long, place int, opens boolean, value string"


def _records(states: dict[tuple[int, int], tuple[bool, int, int, int]]):
    """Whole records (``place`` null), and the pieces of records that a range begins or ends within, in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        held: bytes | None = None
        opened = in_string = False
        depth = level = with_brace = seen = 0
        key: tuple[int, int] | None = None

        def ended() -> None:
            if held and key is not None:
                out.append((*key, 1 if opened else 0, opened, held.decode()))

        for file, block, _, data, first in _runs(batches):
            if first:
                ended()
                key = (file, block)
                in_string, depth, level, with_brace = states[key]
                seen = 0
                # a range that begins within a record goes on with it
                held, opened = (b"" if depth > level or in_string else None), False
            seen += len(data)
            if seen == with_brace:
                data = data[:-1]
            places, quote, step = _marks(data)
            odd = (int(in_string) + np.cumsum(quote)) % 2 == 1
            step = np.where(odd, 0, step)
            depths = depth + np.cumsum(step)
            starts = places[(data[places] == ord("{")) & (step == 1) & (depths == level + 1)].tolist()
            ends = places[(data[places] == ord("}")) & (step == -1) & (depths == level)].tolist()
            raw, at, own = data.tobytes(), 0, 0
            for end in ends:
                while own < len(starts) and starts[own] < at:
                    own += 1
                if held is not None:
                    text, was_open = held + raw[at : end + 1], opened
                    out.append((file, block, None if was_open else 0, was_open, text.decode()))
                    held = None
                else:
                    start = starts[own] if own < len(starts) and starts[own] < end else at
                    _strays(raw[at:start], file, block, out)
                    out.append((file, block, None, True, raw[start : end + 1].decode()))
                at = end + 1
            left = next((s for s in starts[own:] if s >= at), None)
            if held is not None:
                held += raw[at:]
            elif left is not None:
                _strays(raw[at:left], file, block, out)
                held, opened = raw[left:], True
            else:
                _strays(raw[at:], file, block, out)
            in_string, depth = bool(odd[-1]) if len(odd) else in_string, int(depths[-1]) if len(depths) else depth
            if len(out) >= 10_000:
                yield _batch(out)
                out.clear()
        ended()
        if out:
            yield _batch(out)

    return run


def _strays(text: bytes, file: int, block: int, out: list[tuple]) -> None:
    """Text between records that is no separator is a reject of its own."""
    cleaned = text.strip(b" \t\r\n,[]")
    if cleaned:
        out.append((file, block, None, True, cleaned.decode(errors="replace")))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], [c.split()[0] for c in FOUND.split(", ")])


def json_record_texts(spark: SparkSession, path: str) -> DataFrame:
    """``value``: the text of every object in the arrays, or the sequences of objects, in the files of ``path``.

    Only where a record crosses from one range into the next, or a file breaks off within one, are there pieces to look for, in a pass more.
    """
    fragments = _fragments(spark, path)
    states, crossed = _states(fragments)
    found = fragments.mapInArrow(_records(states), FOUND)
    if not crossed:
        return found.select("value")
    pieces = found.filter("place is not null")
    # a record that crosses ranges: the piece that opens it and all that follow before the next one opens
    number = F.sum(F.col("opens").cast("int")).over(Window.partitionBy("file").orderBy("block", "place"))
    ordered = F.sort_array(F.collect_list(F.struct("block", "place", "value")))
    joined = pieces.withColumn("number", number).groupBy("file", "number").agg(F.array_join(F.transform(ordered, lambda p: p["value"]), "").alias("value"))
    return found.filter("place is null").select("value").unionByName(joined.select("value"))


def read_large_json(spark: SparkSession, path: str, schema: T.StructType, rejects: bool = False) -> DataFrame:
    """As ``read_json_records`` for multi-line JSON, but a file of any size is read by as many tasks as it has ranges.

    A record that does not fit fails the read; with ``rejects`` it is kept as text in ``_corrupt_record`` instead, beside
    nulls, as are texts between records that are no records and what a file breaks off with.
    """
    texts = json_record_texts(spark, path)
    if not rejects:
        return texts.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")
    checked = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return texts.select(F.from_json("value", checked, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}).alias("r")).select("r.*")
