"""Quality rules by compression: text that is too repetitive, or not compressible at all, leaves its band of zstandard ratios.

A ratio is the size of a zstandard frame over that of the text. Short texts compress worse than long ones, so every range of lengths has
limits of its own. The whole text is measured, and so is each fixed chunk of it: a long document may hide pages of
noise behind prose, or prose behind pages of noise, and still have an ordinary ratio as a whole.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type

from ledgerloom.llm.textbytes import SPACE, slices, words

# Texts of fewer bytes than the first number have a ratio from the second to the third. Prose in European and Asian
# languages lies well inside; a phrase said over and over is below, and random letters, base64 or hexadecimal digests are above.
BANDS = (
    (64, 0.00, float("inf")),
    (128, 0.35, 1.30),
    (256, 0.40, 1.05),
    (512, 0.36, 0.90),
    (1024, 0.32, 0.80),
    (4096, 0.28, 0.75),
    (16384, 0.25, 0.70),
    (float("inf"), 0.20, 0.68),
)
CHUNK_BYTES = 4096
ODD_CHUNKS = 0.5
LEVEL = 3
REPEATED_WORDS = 8
LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30

SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[list(b"#*$%&|<>")] = True
SPACES = " \t\n\v\f\r"
EMPTY = pa.array(
    [],
    pa.struct(
        [
            ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()),
            ("ratio", pa.float64()), ("n_chunks", pa.int64()), ("n_odd_chunks", pa.int64()), ("in_band", pa.bool_()),
        ]
    ),
)
MEASURES = from_arrow_type(EMPTY.type)


def _within(size: int, ratio: float, bands: Sequence[tuple]) -> bool:
    low, high = next((low, high) for below, low, high in bands if size < below)
    return low <= ratio <= high


def _repeated_lines(text: str) -> int:
    """Lines with a word that are equal to an earlier line."""
    filled = [line for line in text.split("\n") if line.strip(SPACES)]
    return len(filled) - len(set(filled))


def _repeated_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, text: np.ndarray, size: int) -> np.ndarray:
    """Flags of the words that stand in a window of ``size`` words found twice or more in its text.

    Words are numbered by their bytes and runs of words by the pair of their halves, so equal numbers are equal runs, without any
    hashing. ``size`` is a power of two.
    """
    flags = np.zeros(len(starts), dtype=bool)
    if len(starts) < size:
        return flags
    solid = ~SPACE[data]
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    letters = np.ascontiguousarray(data[solid])
    own = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
    run = own.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    width = 1
    while width < size:
        _, run = np.unique(run[:-width] * (int(run.max()) + 1) + run[width:], return_inverse=True)
        width *= 2
    inside = text[: len(run)] == text[size - 1 :]
    at = np.flatnonzero(inside)
    _, window, times = np.unique(text[at] * (int(run.max()) + 1) + run[at], return_inverse=True, return_counts=True)
    often = at[times[window] > 1]
    edges = np.zeros(len(starts) + 1, dtype=np.int64)
    np.add.at(edges, often, 1)
    np.add.at(edges, often + size, -1)
    return np.cumsum(edges[:-1]) > 0


def _compressed(data: bytes, compressor: zstandard.ZstdCompressor, bands: Sequence[tuple], chunk: int, odd_share: float) -> tuple:
    """``ratio, n_chunks, n_odd_chunks, in_band`` of one text; the rest behind its last whole chunk is measured with the whole text only."""
    ratio = len(compressor.compress(data)) / len(data) if data else 0.0
    cuts = range(0, len(data) - chunk + 1, chunk)
    odd = sum(not _within(chunk, len(compressor.compress(data[i : i + chunk])) / chunk, bands) for i in cuts)
    return ratio, len(cuts), odd, _within(len(data), ratio, bands) and odd <= odd_share * len(cuts)


def measured_documents(
    documents: DataFrame, bands: Sequence[tuple] = BANDS, chunk: int = CHUNK_BYTES, odd_share: float = ODD_CHUNKS, level: int = LEVEL
) -> DataFrame:
    """``documents``, all columns as ``row``, with ``doc_id``, the measures of the whole text, ``base_failed`` and ``kept``.

    ``word_chars`` are the code points within words, ``n_symbols`` signs of ``#*$%&|<>``, ``n_dup_lines`` the lines with a word that are equal
    to an earlier line, ``n_repeat_words`` the words in windows of eight words that occur twice or more. ``base_failed``: under 20 words, or more than
    30 of 100 words repeated so. ``kept``: not that, the ratio of the whole text within the band of its length, and no
    more than half of its whole chunks outside the band of theirs. A null text counts as empty: no words, ratio 0, not kept.
    Repeated rows, null ids and columns of any name pass through, rows without change; an empty table gives an empty result. One narrow pass
    over slices of some megabyte, a longer text being a slice of its own.
    """

    @F.arrow_udf(MEASURES)
    def measures(texts: pa.Array) -> pa.Array:
        compressor = zstandard.ZstdCompressor(level=level)
        return pa.concat_arrays([EMPTY, *(_measures(data, offsets, compressor) for _, data, offsets in slices(iter([pa.record_batch([texts], ["text"])])))])

    def _measures(data: np.ndarray, offsets: np.ndarray, compressor: zstandard.ZstdCompressor) -> pa.StructArray:
        starts, ends = words(data, offsets)
        text, n = np.searchsorted(offsets, starts, side="right") - 1, len(offsets) - 1

        def counted(flags: np.ndarray) -> np.ndarray:
            """Flagged bytes of each text."""
            return np.diff(np.concatenate([[0], np.cumsum(flags)])[offsets])

        repeated = _repeated_words(data, starts, ends, text, REPEATED_WORDS)
        texts = [data[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:])]
        ratios, chunks, odd, within = zip(*(_compressed(t, compressor, bands, chunk, odd_share) for t in texts))
        values = [
            np.bincount(text, minlength=n), counted(~SPACE[data] & (data & 0xC0 != 0x80)), counted(SYMBOLS[data]), [_repeated_lines(t.decode()) for t in texts],
            np.bincount(text, weights=repeated, minlength=n).astype(np.int64), ratios, chunks, odd, within,
        ]
        return pa.StructArray.from_arrays([pa.array(v, f.type) for v, f in zip(values, EMPTY.type)], [f.name for f in EMPTY.type])

    # whole rows stay beside as one column, so that no name of theirs can clash
    rows = documents.select(F.struct("*").alias("row")).select("row", F.col("row.doc_id").cast("long").alias("doc_id"), measures(F.coalesce(F.col("row.text").cast("string"), F.lit(""))).alias("m"))
    found = rows.select("doc_id", "row", "m.*")
    n_words, repeated = F.col("n_words"), F.col("n_repeat_words")
    failed = (n_words < LEAST_WORDS) | (100 * repeated > MOST_REPEATED_PERCENT * n_words)
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & F.col("in_band")).alias("kept"),
        "ratio", "n_chunks", "n_odd_chunks", "row",
    )


def within_bands(documents: DataFrame, **options: float) -> DataFrame:
    """The kept rows of ``documents``, all their columns."""
    return measured_documents(documents, **options).filter("kept").select("row.*")
