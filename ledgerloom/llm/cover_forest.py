"""Hard negatives by cover trees: for an anchor, the best rows whose inner product with it lies in given windows.

Inner products are no distances. Each vector therefore gets one more component that brings all of a block to one norm, so that the
angle to an anchor orders them, and balls of vectors bound the inner products inside: a node of a tree knows its
centre, its covering radius and the widest angle between its centre and a vector below it. Levels halve the radius. A search
takes the node with the highest bound first, leaves out nodes that lie outside all windows or below what is already found,
and computes leaves exactly, in integers. What it returns is exact; the trees only save work.

The rows are dealt to blocks by label and nearest pivot, a large cell to as many blocks as it needs, and each block is a tree in a
row of a written table. Anchors travel in batches to the blocks whose own bounds let them in.
"""

from __future__ import annotations

import heapq
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.sources.writers import land

SCALE = 256
BLOCK_ROWS = 16_384
MOST_PIVOTS = 256
SAMPLE_ROWS = 8_192
LEAF_ROWS = 32
MOST_CHILDREN = 64
BATCH_ANCHORS = 512
PAGE_BLOCKS = 1_024
LARGEST_SCORE = 1 << 62
EVERYTHING = (-LARGEST_SCORE, LARGEST_SCORE)


def integer_vectors(embeddings: DataFrame, vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``vec_id, label, vector`` of the rows that take part: none of the three is null, and every component is a finite number.

    A component becomes ``floor(scale * x)``.
    """
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(float("inf")), F.lit(False)) & ~F.isnan(x.cast("double")))
    own = embeddings.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col(vector).isNotNull()).filter(finite)
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))
    return own.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), whole.alias("vector"))


# ---- numbers ---------------------------------------------------------------------------


def _matrix(vectors: pa.Array | list, width: int | None = None) -> np.ndarray:
    """Vectors as rows of one matrix; what a shorter one lacks counts as zero, what a row has beyond ``width`` is left out."""
    rows = vectors.to_pylist() if isinstance(vectors, pa.Array | pa.ChunkedArray) else vectors
    if width is None:
        width = max(map(len, rows), default=0)
    if all(len(r) == width for r in rows):
        return np.array(rows, dtype=np.int64).reshape(len(rows), width)
    return np.array([(r + [0] * width)[:width] for r in rows], dtype=np.int64).reshape(len(rows), width)


def _pack(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def _unpack(data: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(data)) as arrays:
        return dict(arrays)


def _largest(values: np.ndarray) -> int:
    return max(abs(int(values.min())), abs(int(values.max()))) if values.size else 0


def _products(rows: np.ndarray, vector: np.ndarray, largest: int) -> np.ndarray:
    """Exact integer inner products: in doubles while every partial sum fits them, else in 64-bit integers."""
    if largest * _largest(vector) * max(1, len(vector)) < 1 << 53:
        return np.rint(rows.astype(np.float64) @ vector.astype(np.float64)).astype(np.int64)
    return rows @ vector


# ---- trees -----------------------------------------------------------------------------


class CoverTree:
    """Vectors in the order of the leaves, and the nodes above them, children after their parents."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, nodes: dict[str, np.ndarray]):
        self.ids, self.vectors, self.nodes = ids, vectors.astype(np.int64), nodes
        self.largest = _largest(vectors)
        self.as_doubles = vectors.astype(np.float64)
        self.top = float(np.sqrt((self.as_doubles**2).sum(axis=1).max(initial=0.0)))
        self.centres = self.as_doubles[nodes["centre"]]

    @classmethod
    def build(cls, ids: np.ndarray, vectors: np.ndarray, copies: int) -> CoverTree:
        """A tree over a block. Of equal vectors the ``copies`` smallest ids are all that a search can ever return."""
        order = np.lexsort([ids, *vectors.T[::-1]])
        ids, vectors = ids[order], vectors[order]
        same = np.zeros(len(ids), dtype=bool)
        same[1:] = (vectors[1:] == vectors[:-1]).all(axis=1)
        repeated = same.copy()
        repeated[1:] &= ids[1:] == ids[:-1]
        ids, vectors, same = ids[~repeated], vectors[~repeated], same[~repeated]
        first = np.maximum.accumulate(np.where(same, 0, np.arange(len(ids))))
        kept = np.arange(len(ids)) - first < copies
        ids, vectors = ids[kept], vectors[kept]

        x = vectors.astype(np.float64)
        squares = (x**2).sum(axis=1)
        top = squares.max(initial=0.0)
        lift = np.sqrt(np.maximum(top - squares, 0.0))
        order = np.arange(len(ids))
        middle = int(np.argmin(((x - x.mean(axis=0)) ** 2).sum(axis=1)))
        nodes: list[list] = []

        def node(start: int, end: int, centre: int) -> None:
            inside = order[start:end]
            radius = np.sqrt(((x[inside] - x[centre]) ** 2).sum(axis=1).max())
            cosine = ((x[inside] @ x[centre] + lift[inside] * lift[centre]).min() / top) if top else 1.0
            nodes.append([start, end, centre, radius, np.arccos(np.clip(cosine, -1, 1)), 0, 0])

        node(0, len(ids), middle)
        at = 0
        while at < len(nodes):
            start, end, centre, radius, *_ = nodes[at]
            parts = _cover(x, order[start:end], centre, radius / 2) if end - start > LEAF_ROWS and radius > 0 else []
            if parts:
                nodes[at][5:] = [len(nodes), len(nodes) + len(parts)]
                for own, members in parts:
                    order[start : start + len(members)] = members
                    node(start, start + len(members), own)
                    start += len(members)
            at += 1
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        names = ["start", "end", "centre", "radius", "angle", "child", "children_end"]
        columns = {n: np.array(v) for n, v in zip(names, zip(*nodes))}
        columns["centre"] = place[columns["centre"]]
        return cls(ids[order], vectors[order], columns)

    def to_bytes(self) -> bytes:
        vectors = self.vectors.astype(np.min_scalar_type(-self.largest - 1))
        return _pack(ids=self.ids, vectors=vectors, **{f"node_{n}": v for n, v in self.nodes.items()})

    @classmethod
    def from_bytes(cls, data: bytes) -> CoverTree:
        arrays = _unpack(data)
        return cls(arrays["ids"], arrays["vectors"], {n[5:]: v for n, v in arrays.items() if n.startswith("node_")})

    def bounds(self, nodes: slice, anchor: np.ndarray, norm: float) -> tuple[np.ndarray, np.ndarray]:
        return bounds(self.centres[nodes], self.nodes["radius"][nodes], self.nodes["angle"][nodes], self.top, anchor, norm)

    def search(self, anchor: np.ndarray, own_id: int, low: np.ndarray, high: np.ndarray, k: int) -> Iterator[tuple[int, int, int]]:
        """``window, id, score`` of the first ``k`` rows by score, then id, whose score lies in each window; not the anchor itself."""
        anchor = np.resize(np.append(anchor, np.zeros(max(0, self.vectors.shape[1] - len(anchor)), np.int64)), self.vectors.shape[1])
        query = anchor.astype(np.float64)
        norm = float(np.sqrt(query @ query))
        floor = low.copy()
        found: list[list[tuple[int, int]]] = [[] for _ in low]
        lower, upper = self.bounds(slice(0, 1), query, norm)
        heap = [(-upper[0], lower[0], 0)]
        while heap:
            upper_bound, lower_bound, at = heapq.heappop(heap)
            if not ((floor <= -upper_bound) & (high >= lower_bound)).any():
                continue
            first, last = int(self.nodes["child"][at]), int(self.nodes["children_end"][at])
            if last > first:
                lower, upper = self.bounds(slice(first, last), query, norm)
                within = ((floor[:, None] <= upper) & (high[:, None] >= lower)).any(axis=0)
                for i in np.flatnonzero(within):
                    heapq.heappush(heap, (-upper[i], lower[i], first + int(i)))
                continue
            rows = slice(int(self.nodes["start"][at]), int(self.nodes["end"][at]))
            scores = _products(self.vectors[rows], anchor, self.largest)
            good = np.flatnonzero((scores >= floor.min()) & (scores <= high.max()) & (self.ids[rows] != own_id))
            for score, row in zip(scores[good].tolist(), self.ids[rows][good].tolist()):
                for w in range(len(low)):
                    if floor[w] <= score <= high[w] and (-score, row) not in found[w]:
                        found[w].append((-score, row))
                        found[w].sort()
                        if len(found[w]) >= k:
                            del found[w][k:]
                            floor[w] = -found[w][-1][0]
        for w, rows_of in enumerate(found):
            for score, row in rows_of:
                yield w, row, -score


def bounds(centres: np.ndarray, radius: np.ndarray, angle: np.ndarray, top: np.ndarray | float, anchor: np.ndarray, norm: float) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of ``anchor`` with any vector of each ball, by its radius and by its angle, whichever is closer."""
    products = centres @ anchor
    reach = norm * np.maximum(top, 1e-12)
    own = np.arccos(np.clip(products / np.maximum(reach, 1e-12), -1, 1))
    upper = np.minimum(products + norm * radius, reach * np.cos(np.maximum(own - angle, 0)))
    lower = np.maximum(products - norm * radius, reach * np.cos(np.minimum(own + angle, np.pi)))
    # wider than any rounding above
    slack = 1e-6 * reach + 1e-3
    return lower - slack, upper + slack


def _cover(x: np.ndarray, members: np.ndarray, centre: int, radius: float) -> list[tuple[int, np.ndarray]]:
    """Centres among ``members`` and what each covers within ``radius``; nothing if so many are needed that nodes would not save work."""
    parts, left = [], members
    while len(left):
        if len(parts) == MOST_CHILDREN:
            if len(left) * 2 > len(members):
                return []
            parts.append((int(left[0]), left))
            break
        distance = np.sqrt(((x[left] - x[centre]) ** 2).sum(axis=1))
        near = distance <= radius
        if near.any():
            parts.append((centre, left[near]))
        left = left[~near]
        centre = int(left[np.argmax(distance[~near])]) if len(left) else centre
    return parts if len(parts) > 1 else []


# ---- the forest ------------------------------------------------------------------------


def _pivots(vectors: DataFrame, rows: int) -> np.ndarray:
    """Far-apart vectors of a sample of at most ``SAMPLE_ROWS`` rows, the first by hash of their id; one for each ``BLOCK_ROWS`` rows, 256 at most."""
    wanted = max(1, min(MOST_PIVOTS, rows // BLOCK_ROWS))
    x = _matrix([r["vector"] for r in vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS).collect()]).astype(np.float64)
    chosen, distance = [0], ((x - x[0]) ** 2).sum(axis=1)
    while len(chosen) < wanted and distance.max() > 0:
        chosen.append(int(distance.argmax()))
        distance = np.minimum(distance, ((x - x[chosen[-1]]) ** 2).sum(axis=1))
    return x[chosen]


def _with_pivot(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    @F.arrow_udf("int")
    def nearest(column: pa.Array) -> pa.Array:
        x = _matrix(column, pivots.shape[1]).astype(np.float64)
        return pa.array(((pivots**2).sum(axis=1) - 2 * (x @ pivots.T)).argmin(axis=1).astype(np.int32), pa.int32())

    return vectors.withColumn("pivot", nearest("vector"))


BLOCK = "block long, label long, width int, centre array<double>, radius double, angle double, top double, tree binary"


def cover_forest(vectors: DataFrame, pivots: np.ndarray, copies: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row for each block of ``vectors (vec_id, label, vector, pivot)``: its tree, and the bounds of the tree's root.

    A cell of one label and pivot is dealt to blocks by a hash of the id, so a group of any size is many blocks of bounded size.
    """
    cells = land(vectors.groupBy("label", "pivot").agg(F.ceil(F.count(F.lit(1)) / block_rows).alias("parts")), "cells")
    sized = cells.select(F.col("label").alias("__label"), F.col("pivot").alias("__pivot"), "parts")
    dealt = vectors.join(sized, (F.col("label") == F.col("__label")) & (F.col("pivot") == F.col("__pivot")))
    dealt = dealt.select("vec_id", "label", "pivot", "vector", F.pmod(F.xxhash64("vec_id"), F.col("parts")).alias("part"))

    def tree(key: tuple, table: pa.Table) -> pa.Table:
        own = CoverTree.build(table["vec_id"].to_numpy(), _matrix(table["vector"]), copies)
        root = {n: v[0] for n, v in own.nodes.items()}
        values = [[0], [key[0].as_py()], [own.vectors.shape[1]], [own.centres[0].tolist()], [float(root["radius"])], [float(root["angle"])], [own.top], [own.to_bytes()]]
        types = [pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.float64()), pa.float64(), pa.float64(), pa.float64(), pa.binary()]
        return pa.Table.from_arrays([pa.array(v, t) for v, t in zip(values, types)], [c.split()[0] for c in BLOCK.split(", ")])

    grown = dealt.groupBy("label", "pivot", "part").applyInArrow(tree, BLOCK)
    return land(grown.withColumn("block", F.monotonically_increasing_id()), "cover-forest")


ASKED = "anchors binary, label long, n int"


def _anchor_batches(asked: DataFrame) -> DataFrame:
    """``asked (anchor, vec_id, label, pivot, vector, low, high)`` in batches of one label, near ones together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []

        def batch() -> pa.RecordBatch:
            columns = {n: np.array([r[n] for r in held], dtype=np.int64) for n in ("anchor", "vec_id")}
            data = _pack(vector=_matrix([r["vector"] for r in held]), low=_matrix([r["low"] for r in held]), high=_matrix([r["high"] for r in held]), **columns)
            return pa.RecordBatch.from_arrays([pa.array([data], pa.binary()), pa.array([held[0]["label"]], pa.int64()), pa.array([len(held)], pa.int32())], ["anchors", "label", "n"])

        for part in batches:
            for row in part.to_pylist():
                if held and (len(held) == BATCH_ANCHORS or row["label"] != held[0]["label"] or len(row["low"]) != len(held[0]["low"])):
                    yield batch()
                    held = []
                held.append(row)
        if held:
            yield batch()

    order = ["label", "n_windows", "pivot", "anchor"]
    near = asked.withColumn("n_windows", F.size("low")).repartitionByRange(*order).sortWithinPartitions(*order)
    return near.mapInArrow(run, ASKED)


def _visits(batches: DataFrame, forest: DataFrame, same_label: bool, home_only: bool) -> DataFrame:
    """``block, anchors``: each batch with the blocks of the same, or of another, label whose bounds meet a window of one of its anchors.

    Bounds of blocks travel in pages of a thousand; every batch meets every page by a join on the page's number.
    With ``home_only`` an anchor goes just to the block with the nearest centre.
    """
    blocks = forest.select("block", "label", "centre", "radius", "angle", "top")
    n_pages = forest.count() // PAGE_BLOCKS + 1
    pages = blocks.groupBy(F.pmod(F.xxhash64("block"), F.lit(n_pages)).alias("page")).agg(F.collect_list(F.struct("*")).alias("blocks"))
    asked = batches.withColumn("page", F.explode(F.sequence(F.lit(0), F.lit(n_pages - 1)).cast("array<long>")))

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in rows:
            for row in part.to_pylist():
                own = [b for b in row["blocks"] if (b["label"] == row["label"]) == same_label]
                if not own:
                    continue
                a = _unpack(row["anchors"])
                width = max(len(b["centre"]) for b in own)
                centres = np.array([b["centre"] + [0.0] * (width - len(b["centre"])) for b in own])
                radius, angle, top = (np.array([b[n] for b in own]) for n in ("radius", "angle", "top"))
                vectors = np.zeros((len(a["anchor"]), width))
                vectors[:, : min(width, a["vector"].shape[1])] = a["vector"][:, :width]
                enters = np.zeros((len(vectors), len(own)), dtype=bool)
                for i, v in enumerate(vectors):
                    if home_only:
                        enters[i, ((centres - v) ** 2).sum(axis=1).argmin()] = True
                        continue
                    lower, upper = bounds(centres, radius, angle, top, v, float(np.sqrt(v @ v)))
                    enters[i] = ((a["low"][i][:, None] <= upper) & (a["high"][i][:, None] >= lower)).any(axis=0)
                for b in np.flatnonzero(enters.any(axis=0)):
                    data = _pack(**{n: v[enters[:, b]] for n, v in a.items()})
                    yield pa.RecordBatch.from_arrays([pa.array([own[b]["block"]], pa.int64()), pa.array([data], pa.binary())], ["block", "anchors"])

    return asked.join(pages, "page").select("anchors", "label", "blocks").mapInArrow(run, "block long, anchors binary")


def _found(visits: DataFrame, forest: DataFrame, k: int) -> DataFrame:
    """``anchor, window, id, score``: the first ``k`` rows of each window over all blocks visited."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in rows:
            for anchors, data in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                tree, a = CoverTree.from_bytes(data), _unpack(anchors)
                out = [
                    (anchor, *hit)
                    for anchor, own_id, vector, low, high in zip(a["anchor"].tolist(), a["vec_id"].tolist(), a["vector"], a["low"], a["high"])
                    for hit in tree.search(vector, own_id, low, high, k)
                ]
                columns = list(zip(*out)) if out else [[]] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["anchor", "window", "id", "score"])

    trees = forest.select(F.col("block").alias("__block"), "tree")
    hits = visits.join(trees, F.col("block") == F.col("__block")).select("anchors", "tree").mapInArrow(run, "anchor long, window long, id long, score long")
    return _first(hits.distinct(), k, "anchor", "window")


def _share(score: Column, percent: int) -> Column:
    """A percentage of a score, exactly."""
    return score.cast("decimal(30,0)") * percent / 100


def _first(hits: DataFrame, k: int, *keys: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, k_positives: int = 5, k_negatives: int = 5, low_percent: int = 80, high_percent: int = 100, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` over ``vectors (vec_id, label, vector)`` of integers.

    Positives of an anchor are the first ``k_positives`` other rows of its label by inner product, ties by smaller id. Negatives of a positive are the
    first ``k_negatives`` rows of other labels whose score is between ``low_percent`` and ``high_percent`` of the positive's; none if that score is negative.
    Rows that repeat, with the same id, label and vector, count once; rows that share an id with the anchor are not other rows.
    Vectors of different lengths are compared over what both have. Vectors so long that a score may not fit a long raise an error. A table without anchors, or
    empty, gives an empty result.
    """
    square = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x.cast("double") * x)
    n_rows, longest = vectors.agg(F.count(F.lit(1)), F.max(square)).first()
    if (longest or 0.0) >= LARGEST_SCORE:
        raise OverflowError("inner products may not fit a 64-bit integer")
    if not n_rows:
        return vectors.sparkSession.createDataFrame([], RESULT)
    pivots = _pivots(vectors, n_rows)
    placed = land(_with_pivot(vectors, pivots), "placed-vectors")
    forest = cover_forest(placed, pivots, max(k_positives, k_negatives) + 1, block_rows)
    everything = [F.array(F.lit(v).cast("long")).alias(n) for n, v in zip(("low", "high"), EVERYTHING)]
    anchors = land(placed.filter(is_anchor).distinct().withColumn("anchor", F.monotonically_increasing_id()), "anchors")

    def search(asked: DataFrame, same_label: bool, k: int, home_only: bool = False) -> DataFrame:
        return _found(_visits(_anchor_batches(asked), forest, same_label, home_only), forest, k)

    # the nearest block first: what is found there keeps anchors out of most others
    near = search(anchors.select("*", *everything), True, k_positives, home_only=True)
    known = near.groupBy(F.col("anchor").alias("__anchor")).agg(F.min(F.when(F.col("rank") == k_positives, F.col("score"))).alias("least"))
    seeded = anchors.join(land(known, "least-scores"), F.col("anchor") == F.col("__anchor"), "left")
    low = F.array(F.coalesce("least", F.lit(EVERYTHING[0]))).alias("low")
    positives = land(search(seeded.select(*anchors.columns, low, everything[1]), True, k_positives).select("anchor", "rank", "id", "score"), "positives")

    windows = positives.groupBy(F.col("anchor").alias("__anchor")).agg(F.sort_array(F.collect_list(F.struct("rank", "id", "score"))).alias("p"))
    least = F.transform("p", lambda p: F.ceil(_share(p["score"], low_percent)).cast("long"))
    most = F.transform("p", lambda p: F.floor(_share(p["score"], high_percent)).cast("long"))
    asked = anchors.join(windows, F.col("anchor") == F.col("__anchor")).select(*anchors.columns, least.alias("low"), most.alias("high"))
    hits = search(asked, False, k_negatives)
    names = anchors.select(F.col("anchor").alias("__anchor"), F.col("vec_id").alias("anchor_id"))
    of = positives.select(F.col("anchor").alias("__of"), (F.col("rank") - 1).cast("long").alias("__window"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    told = hits.join(of, (F.col("anchor") == F.col("__of")) & (F.col("window") == F.col("__window"))).join(names, F.col("anchor") == F.col("__anchor"))
    return told.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
