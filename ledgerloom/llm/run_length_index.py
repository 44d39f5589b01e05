"""Repeated byte strings, removed with the help of run-length compressed Burrows-Wheeler indexes.

A string of ``length`` bytes is found twice only if both places choose the same anchor: the leftmost smallest hash among its
32-byte pieces. Anchors cut every text into runs of strings that choose the same place, and a run with its bytes is a context.
Contexts of an anchor that occurs once hold nothing repeated; a context that occurs twice is repeated
throughout. The different contexts of an anchor are compared in an index: a Burrows-Wheeler transform
compressed to its runs, with common prefixes sampled at the ends of runs only. Between samples a match shrinks by
one with each byte, so matching statistics of all positions stream from the samples, and every position whose
match is long enough starts a repeated string.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.textbytes import mix, prefix_hashes, slices, span_hashes
from ledgerloom.operators.hotkeys import broadcast_if_at_most
from ledgerloom.sources.writers import land

LENGTH = 200
ANCHOR_BYTES = 32
INDEX_BYTES = 1 << 18
PART_CONTEXTS = 2_000
MOST_PARTS = 100
BROADCAST_DOCUMENTS = 200_000


def anchor_runs(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, piece: int = ANCHOR_BYTES) -> tuple[np.ndarray, ...]:
    """Runs of strings that choose the same anchor: text, first start, number of starts, hash of the anchor, hash of the context."""
    wide = length - piece + 1
    n = len(data) - length + 1
    nothing = tuple(np.zeros(0, np.int64) for _ in range(3)) + tuple(np.zeros(0, np.uint64) for _ in range(2))
    if n <= 0:
        return nothing
    prefix = prefix_hashes(data)
    places = np.arange(len(data) - piece + 1)
    hashes = span_hashes(prefix, places, places + piece)
    padded = np.full(-(-len(hashes) // wide) * wide, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[: len(hashes)] = hashes
    blocks = padded.reshape(-1, wide)
    forward = np.minimum.accumulate(blocks, axis=1).ravel()
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    lowest = np.minimum(backward[:n], forward[wide - 1 : wide - 1 + n])
    text = np.searchsorted(offsets, np.arange(n), side="right") - 1
    inside = np.arange(n) + length <= offsets[1:][text]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1] | (lowest[1:] != lowest[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(begin)
    if not len(first):
        return nothing
    close = inside.copy()
    close[:-1] &= ~inside[1:] | begin[1:]
    last = np.flatnonzero(close)
    # in repetitive text the same smallest hash stands at several places: a run ends where its leftmost place is left behind
    done_first, done_last, todo_first, todo_last = [], [], first, last
    while len(todo_first):
        at = np.empty(len(todo_first), np.int64)
        for k in range(0, len(todo_first), 4096):
            some = todo_first[k : k + 4096]
            at[k : k + 4096] = some + (hashes[some[:, None] + np.arange(wide)] == lowest[some][:, None]).argmax(axis=1)
        stop = np.minimum(todo_last, at)
        done_first.append(todo_first)
        done_last.append(stop)
        more = stop < todo_last
        todo_first, todo_last = stop[more] + 1, todo_last[more]
    first, last = np.concatenate(done_first), np.concatenate(done_last)
    context = mix(span_hashes(prefix, first, last + length) + np.uint64(length))
    return text[first], first - offsets[:-1][text[first]], last - first + 1, lowest[first], context


def suffix_array(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array and ranks, by prefix doubling from several codes at once; the last code must be unique.

    Where rank, later rank and position fit into one word, the words themselves are sorted, which is far quicker than
    sorting positions by them.
    """
    n = len(codes)
    bits = n.bit_length()
    code_bits = int(codes.max() + 1).bit_length()
    width = max(1, (63 - bits) // code_bits)
    rank = np.zeros(n, np.int64)
    for k in range(width):
        later = np.zeros(n, np.int64)
        later[: max(0, n - k)] = codes[k:] + 1
        rank = rank << code_bits | later
    while True:
        packed = 63 - bits >= int(rank.max()).bit_length()
        if packed:
            ordered = rank << bits | np.arange(n)
            ordered.sort()
            order = ordered & ((1 << bits) - 1)
            ordered >>= bits
        else:
            order = np.argsort(rank)
            ordered = rank[order]
        new = np.empty(n, bool)
        new[0], new[1:] = False, ordered[1:] != ordered[:-1]
        place = np.cumsum(new)
        rank = np.empty(n, np.int64)
        rank[order] = place
        if place[-1] == n - 1:
            return order, rank
        later = np.zeros(n, np.int64)
        later[: max(0, n - width)] = rank[width:] + 1
        rank = rank << bits | later
        width *= 2


class RunLengthIndex:
    """A run-compressed Burrows-Wheeler transform of several texts, sampled at its run ends."""

    def __init__(self, texts: list[bytes]):
        sizes = np.array([len(t) + 1 for t in texts])
        self.starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        codes = np.frombuffer(b"\0".join([*texts, b""]), dtype=np.uint8).astype(np.int64) + len(texts)
        codes[self.starts + sizes - 1] = np.arange(len(texts))
        self.left = np.repeat(self.starts + sizes - 1, sizes) - np.arange(len(codes))
        padded = np.concatenate([np.frombuffer(b"\0".join([*texts, b""]), dtype=np.uint8), np.zeros(400 + max(map(len, texts)), np.uint8)]).astype(np.uint64)
        self.eights = sum(padded[k : len(padded) - 7 + k] << np.uint64(8 * k) for k in range(8))
        order, _ = suffix_array(codes)
        bwt = codes[order - 1]
        head = np.ones(len(bwt), dtype=bool)
        head[1:] = bwt[1:] != bwt[:-1]
        heads = np.flatnonzero(head)
        self.run_symbols = bwt[heads]
        self.run_lengths = np.diff(np.append(heads, len(bwt)))
        tails = heads + self.run_lengths - 1
        # samples: a text position at each run boundary, and what its suffix has in common with the one sorted before or after
        down, up = heads[heads > 0], tails[tails < len(bwt) - 1]
        self.before = self._samples(order[down], order[down - 1])
        self.after = self._samples(order[up], order[up + 1])

    def _samples(self, at: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Common prefixes, eight bytes at a time, within the texts both positions stand in."""
        common = np.zeros(len(at), np.int64)
        most = np.minimum(self.left[at], self.left[other])
        alive = np.arange(len(at))
        while len(alive):
            differ = self.eights[at[alive] + common[alive]] ^ self.eights[other[alive] + common[alive]]
            # zero bytes below the lowest bit that differs
            same = np.bitwise_count((differ & (~differ + np.uint64(1))) - np.uint64(1)) >> 3
            common[alive] += same
            alive = alive[(same == 8) & (common[alive] < most[alive])]
        order = np.argsort(at)
        return at[order], np.minimum(common, most)[order]

    def matching_statistics(self) -> np.ndarray:
        """For every position, the length of the longest match with another position, streamed from the samples."""
        longest = np.zeros(len(self.left), np.int64)
        every = np.arange(len(self.left))
        for at, common in (self.before, self.after):
            if not len(at):
                continue
            nearest = np.searchsorted(at, every, side="right") - 1
            known = nearest >= 0
            streamed = common[nearest[known]] - (every[known] - at[nearest[known]])
            longest[known] = np.maximum(longest[known], streamed)
        return longest

    def long_matches(self, length: int) -> list[list[tuple[int, int]]]:
        """For each text, runs ``(first start, number of starts)`` of strings of ``length`` bytes that occur elsewhere."""
        marked = self.matching_statistics() >= length
        edge = np.diff(np.concatenate([[0], marked.astype(np.int8), [0]]))
        found: list[list[tuple[int, int]]] = [[] for _ in self.starts]
        for first, stop in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()):
            own = int(np.searchsorted(self.starts, first, side="right")) - 1
            found[own].append((first - int(self.starts[own]), stop - first))
        return found


def _identified(documents: DataFrame, *more: Column) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.hash(F.xxhash64(text)).alias("text_hash"), text.alias("text"), *more)


def run_table(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc_id, text_hash, start, starts, anchor, context`` of all runs of all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in slices(batches):
            text, start, starts, anchor, context = anchor_runs(data, offsets, length)
            rows = pa.array(text)
            numbers = [pa.array(start), pa.array(starts), pa.array(anchor.view(np.int64)), pa.array(context.view(np.int64))]
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(rows), part.column(1).take(rows), *numbers], ["doc_id", "text_hash", "start", "starts", "anchor", "context"]
            )

    return _identified(documents).mapInArrow(run, "doc_id long, text_hash int, start long, starts long, anchor long, context long")


def _grouped_per_document(rows: DataFrame, name: str, *fields: str) -> DataFrame:
    """``__id, __hash`` and, per document, an array of each field, all in the order of the first."""
    together = F.sort_array(F.collect_list(F.struct(*fields))).alias("all")
    grouped = rows.groupBy(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).agg(together)
    return land(grouped.select("__id", "__hash", *[F.expr(f"transform(all, r -> r.`{f}`)").alias(f) for f in fields]), name)


def _with_documents(documents: DataFrame, per_document: DataFrame, how: str, *columns: str) -> DataFrame:
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("text_hash") == F.col("__hash"))
    small = broadcast_if_at_most(per_document, BROADCAST_DOCUMENTS)
    return _identified(documents).join(small, same, how).select("doc_id", "text_hash", "text", *columns)


def context_bytes(documents: DataFrame, wanted: DataFrame, length: int = LENGTH) -> DataFrame:
    """``anchor, context, content`` for ``wanted (doc_id, text_hash, start, starts, anchor, context)``."""
    per_document = _grouped_per_document(wanted, "asked-contexts", "start", "starts", "anchor", "context")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in slices(batches):
            whole = data.tobytes()
            anchors, contexts, contents = [], [], []
            for base, start, starts, anchor, context in zip(offsets[:-1].tolist(), *(part.column(i).to_pylist() for i in range(3, 7))):
                anchors += anchor
                contexts += context
                contents += [whole[base + a : base + a + n - 1 + length] for a, n in zip(start, starts)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchors, pa.int64()), pa.array(contexts, pa.int64()), pa.array(contents, pa.binary())], ["anchor", "context", "content"]
            )

    joined = _with_documents(documents, per_document, "inner", "start", "starts", "anchor", "context")
    return joined.mapInArrow(run, "anchor long, context long, content binary")


def _indexed(contents: DataFrame, variety: DataFrame, length: int, part_contexts: int) -> DataFrame:
    """``anchor, context, first, starts``: strings of a context that another context of its anchor holds.

    An anchor with more than ``part_contexts`` contexts is dealt into parts, and every two parts are a cell. Rows come
    sorted by cell, and an index takes whole cells until it is full.
    """
    parts = F.ceil(F.col("variety") / part_contexts).cast("int")
    dealt = contents.join(variety.select("anchor", parts.alias("parts")), "anchor").withColumn("part", F.pmod(F.xxhash64("context"), F.col("parts")).cast("int"))
    pairs = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda k: F.struct(F.least(k, "part").alias("i"), F.greatest(k, "part").alias("j")))
    # two parts meet in a cell of their own; a single part is one cell
    met = F.when(F.col("parts") == 1, F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))).otherwise(F.filter(pairs, lambda p: p["i"] < p["j"]))
    cells = dealt.withColumn("cell", F.explode(met)).select("anchor", "cell.i", "cell.j", "context", "content")

    def matches(held: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        rows = [
            (anchor, context, first, n)
            for (anchor, context, _), runs in zip(held, RunLengthIndex([c for _, _, c in held]).long_matches(length))
            for first, n in runs
        ]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], pa.int64()) for i in range(4)], ["anchor", "context", "first", "starts"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, volume, last = [], 0, None
        for batch in batches:
            for anchor, i, j, context, content in zip(*(c.to_pylist() for c in batch.columns)):
                cell = anchor, i, j
                # cells of one anchor may hold the same contexts, which would then match themselves
                if cell != last and (volume > INDEX_BYTES or last and last[0] == anchor):
                    yield matches(held)
                    held, volume = [], 0
                held.append((anchor, context, content))
                volume += len(content)
                last = cell
        if held:
            yield matches(held)

    cell_key = ["anchor", "i", "j"]
    return cells.repartition(*cell_key).sortWithinPartitions(*cell_key).mapInArrow(run, "anchor long, context long, first long, starts long")


def _counted(contents: DataFrame, length: int) -> DataFrame:
    """The same result for anchors with more contexts than one task should hold: strings are hashed and counted.

    A count needs no group in one place, and copies are added up before the shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for anchor, context, content in zip(*(c.to_pylist() for c in batch.columns)):
                data = np.frombuffer(content, dtype=np.uint8)
                place = np.arange(len(data) - length + 1)
                prefix = prefix_hashes(data)
                one = span_hashes(prefix, place, place + length)
                two = span_hashes(prefix_hashes(data[::-1]), len(data) - length - place, len(data) - place)
                n = len(place)
                columns = [np.full(n, anchor), np.full(n, context), place, one.view(np.int64), two.view(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["anchor", "context", "first", "one", "two"])

    strings = contents.mapInArrow(run, "anchor long, context long, first long, one long, two long")
    strings = land(strings, "strings")
    often = land(strings.groupBy("anchor", "one", "two").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "repeated-strings")
    return strings.join(often, ["anchor", "one", "two"]).select("anchor", "context", "first", F.lit(1).cast("long").alias("starts"))


def repeated_spans(documents: DataFrame, length: int = LENGTH, part_contexts: int = PART_CONTEXTS, most_parts: int = MOST_PARTS) -> DataFrame:
    """``__id, __hash, from, size``: per document, the spans of strings that also start elsewhere; spans may overlap.

    Anchors with more than ``most_parts`` parts of contexts are counted instead of compared; the result is the same.
    """
    runs = land(run_table(documents, length), "anchor-runs")
    often = land(runs.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("anchor"), "repeated-anchors")
    runs = land(runs.join(often, "anchor"), "repeated-runs")
    example = F.struct("doc_id", "text_hash", "start", "starts")
    contexts = land(runs.groupBy("anchor", "context").agg(F.count(F.lit(1)).alias("n"), F.min(example).alias("example")), "contexts")
    varied = contexts.groupBy("anchor").agg(F.count(F.lit(1)).alias("variety")).filter("variety > 1")
    variety = land(varied, "varied-anchors")
    wanted = land(contexts.join(variety, "anchor").select("anchor", "context", "example.*", "variety"), "wanted-contexts")
    most = part_contexts * most_parts
    large = wanted.filter(F.col("variety") > most)
    whole = contexts.filter("n > 1").select("anchor", "context", F.lit(0).cast("long").alias("first"), F.col("example.starts").alias("starts"))
    contents = context_bytes(documents, wanted.filter(F.col("variety") <= most), length)
    partial = _indexed(contents, variety, length, part_contexts)
    if not large.isEmpty():
        partial = partial.unionByName(_counted(context_bytes(documents, large, length), length))
    once = contexts.filter("n = 1").select("anchor", "context")
    marks = land(whole.unionByName(partial.join(once, ["anchor", "context"], "left_semi")), "marks")
    ranges = marks.groupBy("anchor", "context").agg(F.collect_set(F.struct("first", F.col("starts").alias("count"))).alias("ranges"))
    placed = runs.join(land(ranges, "ranges"), ["anchor", "context"]).select("doc_id", "text_hash", "start", F.explode("ranges").alias("r"))
    spans = placed.select("doc_id", "text_hash", (F.col("start") + F.col("r.first")).alias("from"), (F.col("r.count") - 1 + length).cast("int").alias("size"))
    return _grouped_per_document(spans, "spans", "from", "size")


def without_repeats(documents: DataFrame, length: int = LENGTH, **sizes: int) -> DataFrame:
    """One row per row of ``documents``: ``doc_id, n_bytes, n_removed, n_spans, spans, kept``.

    Every byte of a UTF-8 text that a string of ``length`` bytes covers which also starts anywhere else, in the same or another
    text, is removed; ``spans`` are the maximal removed ``(start, end)`` runs and ``kept`` the other bytes.
    Null texts are empty; texts shorter than ``length`` lose nothing; rows that repeat are places of their own, so they lose
    all strings. Null ids are ids like any other. An empty table gives an empty result; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in slices(batches):
            whole = data.tobytes()
            sizes, removed, merged, kept = [], [], [], []
            for base, end, starts, lengths in zip(offsets[:-1].tolist(), offsets[1:].tolist(), part.column(3).to_pylist(), part.column(4).to_pylist()):
                own: list[list[int]] = []
                for start, size in zip(starts or (), lengths or ()):
                    if own and start <= own[-1][1]:
                        own[-1][1] = max(own[-1][1], start + size)
                    else:
                        own.append([start, start + size])
                edges = [0, *[x for span in own for x in span], end - base]
                kept.append(b"".join(whole[base + a : base + b] for a, b in zip(edges[::2], edges[1::2])))
                sizes.append(end - base)
                removed.append(end - base - len(kept[-1]))
                merged.append([{"start": a, "end": b} for a, b in own])
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array([len(m) for m in merged], pa.int64()),
                    pa.array(merged, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary()),
                ],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept"],
            )

    joined = _with_documents(documents, repeated_spans(documents, length, **sizes), "left", "from", "size")
    return joined.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, spans array<struct<start:long,end:long>>, kept binary")
