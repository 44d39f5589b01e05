"""Documents as byte buffers: what the Arrow-batched operators share.

A batch of texts is one ``uint8`` array with offsets, so that words, boundaries and hashes
of all its documents come from a few array operations.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
LOWER_BYTES = LOWER.tobytes()

SLICE_BYTES = 1 << 20
_FACTOR = 0x9E3779B97F4A7C15
_INVERSE = pow(_FACTOR, -1, 1 << 64)


def id_and_text(documents: DataFrame, *more: Column) -> DataFrame:
    """``doc_id`` as a long and the whole ``text`` with null as empty; nothing else of the input is used."""
    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *more
    )


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = SLICE_BYTES) -> Iterator[tuple]:
    """Yield ``(batch slice, bytes, offsets)`` of about ``size`` bytes; a longer text is a slice of its own."""
    for batch in batches:
        texts = pc.fill_null(batch.column(batch.schema.get_field_index(column)), "").cast(pa.large_string())
        if not len(texts):
            continue
        _, offsets, data = texts.buffers()
        ends = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
        whole = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, np.uint8)
        first = 0
        while first < len(texts):
            last = max(first + 1, int(np.searchsorted(ends, ends[first] + size, side="right")) - 1)
            last = min(last, len(texts))
            yield batch.slice(first, last - first), whole[ends[first] : ends[last]], ends[first : last + 1] - ends[first]
            first = last


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of all words, a word being a run without ASCII white space; none crosses a text."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    solid = ~SPACE[data]
    start, end = solid.copy(), solid.copy()
    start[1:] &= ~solid[:-1]
    end[:-1] &= ~solid[1:]
    filled = offsets[:-1][offsets[1:] > offsets[:-1]]
    start[filled] = solid[filled]
    last = offsets[1:][offsets[1:] > offsets[:-1]] - 1
    end[last] = solid[last]
    return np.flatnonzero(start), np.flatnonzero(end) + 1


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, dtype=np.uint64)
    done = 1
    while done < n:
        step = min(done, n - done)
        out[done : done + step] = out[:step] * np.uint64(pow(base, done, 1 << 64))
        done += step
    return out


_tables: dict[str, np.ndarray] = {}


def _table(name: str, base: int, n: int) -> np.ndarray:
    if len(_tables.get(name, ())) < n:
        _tables[name] = _powers(base, max(n, SLICE_BYTES + 1))
    return _tables[name]


def mix(values: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over the whole word."""
    values = values ^ (values >> np.uint64(29))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(32))


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Polynomial prefix sums, from which the hash of any span is one subtraction and one product."""
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _table("power", _FACTOR, len(data) + 1)[: len(data)], out=out[1:])
    return out


def span_hashes(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of spans; equal spans have equal hashes wherever they stand."""
    inverse = _table("inverse", _INVERSE, len(prefix))
    return mix((prefix[ends] - prefix[starts]) * inverse[starts] + (ends - starts).astype(np.uint64) * np.uint64(_FACTOR))
