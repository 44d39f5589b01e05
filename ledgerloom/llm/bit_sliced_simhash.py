"""Near duplicates by SimHash fingerprints, compared bit-sliced.

Fingerprints of equal texts are equal, so distinct fingerprints are compared, not rows. They meet in
buckets of values that agree on some bits. A bucket is stored vertically: one bit plane per bit, 64
fingerprints to a word. Carry-save adders add the differing planes into counters of all 64 distances
at once, and words in which every distance has passed the radius are abandoned between planes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.chunk_recipes import keep_decided
from ledgerloom.llm.components import connected_components
from ledgerloom.llm.similar_sets import similar_components
from ledgerloom.llm.textbytes import LOWER_BYTES, id_and_text, mix
from ledgerloom.operators.hotkeys import attach_by_key, broadcast_if_at_most
from ledgerloom.sources.writers import land

SHINGLE_WORDS = 4
RADIUS = 4
SEED = 42
CELL_ROWS = 4096
BUCKET_ROWS = 512
LARGE_BUCKETS = 100_000
PLANES_BETWEEN_LOOKS = 8
PAIRS_AT_ONCE = 1 << 16
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def _digest64(data: bytes) -> bytes:
    return xxhash.xxh64_intdigest(data, SEED).to_bytes(8, "little")


def _digest128(data: bytes) -> bytes:
    return xxhash.xxh3_128_digest(data, SEED)


DIGESTS = {64: _digest64, 128: _digest128}


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS, bits: int = 64) -> bytes:
    """SimHash of the word shingles, repeats counted, in little-endian bytes; zero without words."""
    words = text.translate(LOWER_BYTES).split()
    if not words:
        return bytes(bits // 8)
    joined = b" ".join(words)
    digest = DIGESTS[bits]
    if len(words) <= shingle_words:
        return digest(joined)
    ends = (np.cumsum([len(w) + 1 for w in words]) - 1).tolist()
    starts = [0, *[e + 1 for e in ends[: len(words) - shingle_words]]]
    shingles = [joined[a:b] for a, b in zip(starts, ends[shingle_words - 1 :])]
    if bits == 64:
        hashes = np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles], dtype=np.uint64).view(np.uint8)
    else:
        hashes = np.frombuffer(b"".join([digest(s) for s in shingles]), dtype=np.uint8)
    counts = np.unpackbits(hashes.reshape(-1, bits // 8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    return np.packbits(counts * 2 > len(shingles), bitorder="little").tobytes()


def fingerprints(documents: DataFrame, shingle_words: int = SHINGLE_WORDS, bits: int = 64) -> DataFrame:
    """``doc_id``, the fingerprint and the SHA-256 of the text, for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(t.as_py() or "").encode() for t in batch.column(1)]
            values = pa.array([fingerprint(t, shingle_words, bits) for t in texts], pa.binary())
            digests = pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), values, digests], ["doc_id", "bits", "text_sha256"])

    return id_and_text(documents).mapInArrow(run, "doc_id long, bits binary, text_sha256 string")


def bit_planes(values: np.ndarray) -> np.ndarray:
    """From values of ``w`` words: 64 ``w`` rows of words; bit ``j`` of word ``i`` in row ``b`` is bit ``b`` of value ``64 i + j``."""
    padded = np.zeros((-(-len(values) // 64) * 64, values.shape[1]), dtype=np.uint64)
    padded[: len(values)] = values
    bits = np.unpackbits(padded.view(np.uint8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)


def _add(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Carry-save adder: sum and carry of three bits, in every lane."""
    either = a ^ b
    return either ^ c, (a & b) | (either & c)


def within_radius(
    queries: np.ndarray, planes: np.ndarray, query: np.ndarray, word: np.ndarray, valid: np.ndarray, radius: int = RADIUS
) -> tuple[np.ndarray, np.ndarray]:
    """Of the given (query, word of lanes) pairs, the (query, lane) pairs of at most ``radius`` differing bits.

    ``valid`` has the lanes of each word that hold a value. Counters are as wide as the radius needs; what
    overflows them is beyond it and stays so.
    """
    width = max(3, radius.bit_length())
    counters = [np.zeros(len(query), dtype=np.uint64) for _ in range(width)]
    over, near = np.zeros(len(query), dtype=np.uint64), valid[word]
    for first in range(0, len(planes), PLANES_BETWEEN_LOOKS):
        asked = queries[query, first // 64]
        for b in range(first, first + PLANES_BETWEEN_LOOKS, 4):
            d = [planes[b + i][word] ^ (np.uint64(0) - ((asked >> np.uint64((b + i) % 64)) & np.uint64(1))) for i in range(4)]
            ones, carry = _add(counters[0], d[0], d[1])
            counters[0], more = _add(ones, d[2], d[3])
            counters[1], carry = _add(counters[1], carry, more)
            for i in range(2, width):
                counters[i], carry = counters[i] ^ carry, counters[i] & carry
            over |= carry
        beyond, equal = over.copy(), ~over
        for i in reversed(range(width)):
            if radius >> i & 1:
                equal &= counters[i]
            else:
                beyond |= equal & counters[i]
                equal &= ~counters[i]
        near = ~beyond & valid[word]
        alive = near != 0
        if not alive.all():
            query, word, over, near = (x[alive] for x in (query, word, over, near))
            counters = [c[alive] for c in counters]
        if not len(query):
            return query, word
    row, lane = np.nonzero(np.unpackbits(near.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
    return query[row], word[row] * 64 + lane


def _stars(x: np.ndarray, y: np.ndarray) -> list[tuple[int, int]]:
    """The components of the linked pairs, each as a star: one edge per value, not one per pair."""
    if not len(x):
        return []
    values, place = np.unique(np.concatenate([x, y]), return_inverse=True)
    a, b = place[: len(x)], place[len(x) :]
    label = np.arange(len(values))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        for side in (a, b):
            np.minimum.at(new, label[side], low)
        while (new[new] != new).any():
            new = new[new]
        new = new[label]
        if (new == label).all():
            return [(v, r) for v, r in zip(values.tolist(), values[label].tolist()) if v != r]
        label = new


Cell = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def cell_links(cells: list[Cell], radius: int = RADIUS) -> list[tuple[int, int]]:
    """Links of many cells at once; a cell ``(nodes, values, nodes, values)`` compares its first values with its second."""
    lanes, lane_nodes, valid, query, word = [], [], [], [], []
    n_queries = n_words = 0
    for _, a, nodes, b in cells:
        words = -(-len(b) // 64)
        padded, padded_nodes = np.zeros((words * 64, b.shape[1]), dtype=np.uint64), np.zeros(words * 64, dtype=np.int64)
        padded[: len(b)], padded_nodes[: len(b)] = b, nodes
        filled = np.full(words, ALL)
        if len(b) % 64:
            filled[-1] = ALL >> np.uint64(64 - len(b) % 64)
        lanes.append(padded)
        lane_nodes.append(padded_nodes)
        valid.append(filled)
        query.append(np.repeat(np.arange(n_queries, n_queries + len(a)), words))
        word.append(np.tile(np.arange(n_words, n_words + words), len(a)))
        n_queries += len(a)
        n_words += words
    asked = np.concatenate([cell[1] for cell in cells])
    left, lane = within_radius(
        asked, bit_planes(np.concatenate(lanes)), np.concatenate(query), np.concatenate(word), np.concatenate(valid), radius
    )
    x, y = np.concatenate([cell[0] for cell in cells])[left], np.concatenate(lane_nodes)[lane]
    return _stars(x[x != y], y[x != y])


def agreeing_blocks(n_values: int, radius: int = RADIUS, bits: int = 64) -> list[np.ndarray]:
    """Masks of which two values within ``radius`` agree on at least one.

    With ``radius + s`` blocks they agree on ``s`` of them at least. More blocks give longer keys
    and more tables; which number is taken depends on the number of values and changes no result.
    """
    for shared in range(1, 5):
        n = radius + shared
        edges = [bits * i // n for i in range(n + 1)]
        if n_values >> (bits * shared // n) <= BUCKET_ROWS:
            break
    return [_mask([b for k in choice for b in range(edges[k], edges[k + 1])], bits) for choice in combinations(range(n), shared)]


def sampled_bits(n_values: int, tables: int, bits: int, radius: int = 22) -> list[np.ndarray]:
    """Masks of random bits. Values that differ in a share ``p`` of their bits agree on one of ``t`` masks of
    ``k`` bits with probability ``1 - (1 - (1 - p)^k)^t``: 0.998 for 12 bits, 32 tables and ``p`` = 0.13. ``k`` grows by one each
    time the values double, so that buckets stay small, and the tables by ``1 / (1 - radius / bits)`` or more, so that the
    probability for values at the radius is the same for any number of values; for closer ones it grows."""
    doublings = max(0, (n_values // (BUCKET_ROWS << 12)).bit_length())
    draw = np.random.default_rng(SEED)
    size = min(bits, 12 + doublings)
    # of masks without replacement, as they are drawn
    agree = [np.prod([(bits - radius - i) / (bits - i) for i in range(k)]) for k in (12, size)]
    n_tables = int(np.ceil(tables * agree[0] / max(agree[1], 1e-12) - 1e-9))
    return [_mask(draw.choice(bits, size, replace=False).tolist(), bits) for _ in range(n_tables)]


def _mask(places: list[int], bits: int) -> np.ndarray:
    flags = np.zeros(bits, dtype=np.uint8)
    flags[places] = 1
    return np.packbits(flags, bitorder="little").view(np.uint64)


def _values(column: pa.Array) -> np.ndarray:
    """A binary column of equal sizes as rows of 64-bit words."""
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, dtype=np.uint64).reshape(len(column), -1)


def bucket_keys(distinct: DataFrame, masks: list[np.ndarray]) -> DataFrame:
    """Every value once for each mask, under a hash of its masked bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = _values(batch.column(1))
            for i, mask in enumerate(masks):
                key = np.full(len(values), i, dtype=np.uint64)
                for w in range(values.shape[1]):
                    key = mix(key * np.uint64(0x9E3779B97F4A7C15) + (values[:, w] & mask[w]))
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), *batch.columns], ["key", "node", "bits"])

    return distinct.select("node", "bits").mapInArrow(run, "key long, node long, bits binary")


def linked_fingerprints(
    distinct: DataFrame, radius: int = RADIUS, bits: int = 64, tables: int | None = None, cell_rows: int = CELL_ROWS
) -> DataFrame:
    """Edges ``(a, b)`` that connect all nodes of ``distinct (node, bits)`` which links of ``radius`` bits connect.

    Without ``tables`` no link is missed; with it, buckets come from that many samples of bits.
    A bucket of more than ``cell_rows`` values is dealt into parts, and every pair of parts
    is a cell of its own: no task holds more than two parts of a bucket.
    """
    n_values = distinct.count()
    masks = agreeing_blocks(n_values, radius, bits) if tables is None else sampled_bits(n_values, tables, bits, radius)
    placed = bucket_keys(distinct, masks)
    sizes = placed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > cell_rows)
    large = land(sizes.select("key", F.ceil(F.col("n") / cell_rows).cast("int").alias("parts")), "large-buckets")
    joined = placed.join(broadcast_if_at_most(large, LARGE_BUCKETS), "key", "left")
    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    others = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda j: F.struct(F.least(j, part).alias("i"), F.greatest(j, part).alias("j"), F.when(j == part, 0).when(part < j, 1).otherwise(2).alias("side")),
    )
    whole = F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(0).alias("side")))
    cells = joined.select("key", "node", "bits", F.explode(F.when(F.col("parts").isNull(), whole).otherwise(others)).alias("cell")).select(
        "key", "cell.i", "cell.j", "cell.side", "node", "bits"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, pairs = [], 0
        for cell in _sorted_cells(batches):
            held.append(cell)
            pairs += len(cell[0]) * -(-len(cell[2]) // 64)
            if pairs > PAIRS_AT_ONCE:
                yield from _edges(cell_links(held, radius))
                held, pairs = [], 0
        if held:
            yield from _edges(cell_links(held, radius))

    cell_key = ["key", "i", "j"]
    return cells.repartition(*cell_key).sortWithinPartitions(*cell_key).mapInArrow(run, "a long, b long")


def _sorted_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[Cell]:
    """What to compare in each cell, from rows sorted by cell; a cell is held whole, and no more."""
    current, sides, nodes, values = None, [], [], []

    def cell() -> Iterator[Cell]:
        if not nodes:
            return
        side, node, bits = np.concatenate(sides), np.concatenate(nodes), np.concatenate(values)
        own, one, two = (side == s for s in (0, 1, 2))
        if own.sum() > 1:
            yield node[own], bits[own], node[own], bits[own]
        if one.any() and two.any():
            yield node[one], bits[one], node[two], bits[two]

    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns[:3]])
        side, node = (c.to_numpy(zero_copy_only=False) for c in batch.columns[3:5])
        bits = _values(batch.column(5))
        edges = [0, *(np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for first, last in zip(edges[:-1], edges[1:]):
            name = tuple(key[:, first].tolist())
            if name != current:
                yield from cell()
                current, sides, nodes, values = name, [], [], []
            sides.append(side[first:last])
            nodes.append(node[first:last])
            values.append(bits[first:last])
    yield from cell()


def _edges(found: list[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
    if found:
        a, b = zip(*found)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def simhash_components(
    documents: DataFrame, shingle_words: int = SHINGLE_WORDS, bits: int = 64, radius: int = RADIUS, tables: int | None = None
) -> DataFrame:
    """One row per row of ``documents (doc_id, text)``: ``doc_id, bits, text_sha256, component_id, component_rows, row``.

    ``component_id`` is the smallest ``doc_id`` that links reach, itself included. Null texts are
    empty; texts without words have fingerprint zero and link like any other. Repeated rows are
    members of one component, null ids never give it its name unless all are null. An empty table gives
    an empty result; other columns are ignored.
    """
    rows = land(fingerprints(documents, shingle_words, bits).withColumn("row", F.monotonically_increasing_id()), "fingerprints")
    distinct = rows.groupBy("bits").agg(F.min("doc_id").alias("low"), F.min("row").alias("node"), F.count(F.lit(1)).alias("n"))
    distinct = land(distinct, "distinct-fingerprints")
    parts = connected_components(linked_fingerprints(distinct.select("node", "bits"), radius, bits, tables))
    named = land(distinct.join(parts, "node", "left").withColumn("component", F.coalesce("component", "node")), "fingerprint-components")
    classes = named.groupBy("component").agg(F.min("low").alias("component_id"), F.sum("n").alias("component_rows"), F.count(F.lit(1)).alias("__values"))
    per_value = attach_by_key(named.select("bits", "component", "n"), classes, ["component"], ["component_id", "component_rows"], "__values")
    return attach_by_key(rows, per_value.select("bits", "component_id", "component_rows", "n"), ["bits"], ["component_id", "component_rows"], "n")


def without_near_copies(documents: DataFrame, **options: float) -> DataFrame:
    """``documents``, all columns, with one row of each component: the one with the smallest id.

    Texts whose fingerprints link, compared bit-sliced as everywhere here, and texts that share a band of min-hashes are candidates; an exact
    check follows: links are shingle similarities of 0.8, or the given ``similarity``, or more, each verified (``similar_sets``). Fingerprints within
    the radius miss most pairs near 0.8, whose fingerprints differ in ten bits or so, and all that are further apart: these the bands add.
    """
    linked = land(simhash_components(documents).filter("component_rows > 1"), "linked-fingerprints")
    found = land(similar_components(documents, groups=linked, **options), "components")
    several = found.filter("component_rows > 1")
    first = several.filter("doc_id <=> component_id").groupBy("component_id").agg(F.min("row").alias("__first"), F.max("component_rows").alias("__n"))
    chosen = attach_by_key(several, first, ["component_id"], ["__first"], "__n")
    decided = chosen.select("doc_id", "text_sha256", (F.col("row") == F.col("__first")).alias("kept"))
    return keep_decided(documents, land(decided, "near-decisions"))
