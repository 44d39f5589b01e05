"""Cover trees against a plain scan of all rows."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import cover_forest
from tests.helpers import rows

SCHEMA = "vec_id long, label int, embedding array<double>, block long, pivot int, score long, tree binary"


def table(spark, vectors):
    return spark.createDataFrame([(*v, 1, 2, 3, b"x") for v in vectors], SCHEMA)


def brute(vectors, every=5, k=5):
    clean = {
        (i, label, tuple(math.floor(256 * x) for x in v))
        for i, label, v in vectors
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    }
    out = []
    for i, label, v in clean:
        if i % every:
            continue
        scored = {(-sum(a * b for a, b in zip(v, w)), j, other == label) for j, other, w in clean if j != i}
        for score, j, _ in sorted(s for s in scored if s[2])[:k]:
            p = -score
            fits = sorted(s for s in scored if not s[2] and 80 * p <= -100 * s[0] <= 100 * p)[:k]
            out += [(i, j, rank, n, p, -s) for rank, (s, n, _) in enumerate(fits, 1)]
    return sorted(out, key=repr)


def found(df, every=5, **options):
    return rows(cover_forest.hard_negatives(cover_forest.integer_vectors(df), F.col("vec_id") % every == 0, **options))


def cloud(seed, n, dim, labels=3, spread=0.3):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(6, dim))
    return [(i, int(draw.integers(labels)), (centres[draw.integers(6)] + spread * draw.normal(size=dim)).tolist()) for i in range(n)]


def test_forest_of_many_blocks_finds_what_a_scan_finds(spark, monkeypatch):
    monkeypatch.setattr(cover_forest, "PAGE_BLOCKS", 4)
    monkeypatch.setattr(cover_forest, "BATCH_ANCHORS", 7)
    vectors = cloud(1, 600, 8)
    assert found(table(spark, vectors), block_rows=40) == brute(vectors)


def test_copies_ties_nulls_and_odd_vectors(spark):
    draw = random.Random(2)
    vectors = cloud(3, 60, 3) + [(100 + i, i % 3, [0.5, 0.5, 0.5]) for i in range(120)]
    vectors += [(300 + i, draw.randrange(3), [float(draw.randrange(3)) for _ in range(3)]) for i in range(60)]
    vectors += [
        vectors[0], vectors[0], (5, 2, [1.0, 0.25, 0.5]), (None, 1, [1.0, 1.0, 1.0]), (400, None, [1.0, 1.0, 1.0]), (405, 1, None), (410, 1, [1.0, None, 1.0]),
        (415, 1, [1.0, float("nan"), 1.0]), (420, 1, [1.0, float("inf"), 1.0]), (425, 0, [0.0, 0.0, 0.0]), (430, 0, []), (435, 1, [1.0, 0.5]), (-5, 1, [-1.0, -1.0, -1.0]),
    ]
    assert found(table(spark, vectors), block_rows=50) == brute(vectors)


def test_large_components_are_exact_or_refused(spark):
    large = [(i, i % 2, [3e5 + i, 2e5 - i, 1.0 * i]) for i in range(40)]
    assert found(table(spark, large)) == brute(large)
    with pytest.raises(OverflowError):
        found(table(spark, [(i, i % 2, [1e9 + i, 1e9]) for i in range(10)]))


def test_without_rows_or_anchors_there_is_nothing(spark):
    assert found(table(spark, [])) == []
    assert found(table(spark, [(1, 0, [1.0]), (2, 1, [1.0])])) == []
    assert found(table(spark, [(5, 0, [1.0]), (6, 1, [1.0])])) == []


def test_tree_bounds_hold_and_save_work():
    vectors = np.array([v for _, _, v in cloud(4, 4000, 6, spread=0.02)])
    whole = np.floor(256 * vectors).astype(np.int64)
    tree = cover_forest.CoverTree.from_bytes(cover_forest.CoverTree.build(np.arange(4000), whole, 6).to_bytes())
    assert sorted(tree.ids.tolist()) == list(range(4000)) or len(tree.ids) <= 4000
    query = whole[17].astype(float)
    lower, upper = tree.bounds(slice(0, len(tree.nodes["start"])), query, float(np.sqrt(query @ query)))
    scores = tree.as_doubles @ query
    for i, (a, b) in enumerate(zip(tree.nodes["start"], tree.nodes["end"])):
        assert lower[i] <= scores[a:b].min() and scores[a:b].max() <= upper[i]
    seen = []
    exact = cover_forest._products
    try:
        cover_forest._products = lambda r, v, m: seen.append(len(r)) or exact(r, v, m)
        hits = list(tree.search(whole[17], 17, np.array([-(1 << 62)]), np.array([1 << 62]), 5))
    finally:
        cover_forest._products = exact
    best = sorted((-s, i) for s, i in zip((tree.vectors @ whole[17]).tolist(), tree.ids.tolist()) if i != 17)[:5]
    assert [(-s, i) for _, i, s in hits] == best
    assert sum(seen) < 1500
