"""The pipeline's near copies come from fingerprints too; toxicity learns from every label outside its held-out fold."""

from __future__ import annotations

import random
import zlib

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerloom.llm import bit_sliced_simhash as simhash
from ledgerloom.llm import deobfuscated_toxicity as tox
from ledgerloom.llm import similar_sets


def test_near_copies_are_found_by_their_fingerprints(documents, monkeypatch):
    sketches = similar_sets.sketches
    monkeypatch.setattr(similar_sets, "sketches", lambda d: sketches(d).withColumn("bands", F.array().cast("array<bigint>")))
    draw, pairs = random.Random(3), []
    for i in range(20):
        words = [f"w{draw.randrange(10**6)}" for _ in range(3000)]
        pairs.append((10 * i, " ".join(words)))
        words[draw.randrange(3000)] = "other"
        pairs.append((10 * i + 1, " ".join(words)))
    assert sorted(r.doc_id for r in simhash.without_near_copies(documents(*pairs)).collect()) == [10 * i for i in range(20)]


def test_linked_fingerprints_are_verified(documents):
    """Repeats fill the fingerprint, but not the shingle set: these differ in few bits and share fewer than 0.8 of their shingles."""
    draw = random.Random(5)
    often = " ".join(["all work and no play makes a dull day"] * 300)
    texts = [f"{often} {' '.join(f'x{draw.randrange(10**9)}' for _ in range(12))}" for _ in range(6)]
    rows = simhash.simhash_components(documents(*enumerate(texts))).collect()
    assert {r.component_id for r in rows} == {0}
    assert simhash.without_near_copies(documents(*enumerate(texts))).count() == 6


def test_all_labels_are_learned_from(documents, spark, monkeypatch):
    ids = range(300)
    frame, labels = documents(*[(i, f"text {i}") for i in ids]), spark.createDataFrame([(i, int(i % 5 == 0)) for i in ids], "doc_id long, toxic int")
    want = {(i, f"text {i}", i % 5 == 0) for i in ids if zlib.crc32(str(i).encode()) % 3 != 1}
    assert not hasattr(tox, "LABELLED_ROWS")
    for few in (2_000_000, 10):
        monkeypatch.setattr(tox, "BROADCAST_LABELS", few)
        assert {(r.doc_id, r.text, r.toxic) for r in tox.training_rows(frame, labels).collect()} == want


def edited(draw, words, every):
    """The words with one of each ``every`` changed."""
    changed = list(words)
    for first in range(0, len(words), every):
        changed[min(len(words) - 1, first + draw.randrange(every))] = f"x{draw.randrange(10**6)}"
    return changed


def test_pipeline_drops_copies_with_changed_words(documents, spark):
    """One word in twenty changed leaves 0.6 of the shingles: below 0.8, and no text of its own."""
    draw, pairs = random.Random(11), []
    for i in range(30):
        words = [f"w{draw.randrange(5000)}" for _ in range(draw.randrange(60, 400))]
        pairs += [(10 * i, " ".join(words)), (10 * i + 1, " ".join(edited(draw, words, 20))), (10 * i + 2, " ".join(edited(draw, words, 15)))]
    others = [(1000 + i, " ".join(f"w{draw.randrange(5000)}" for _ in range(100))) for i in range(30)]
    left = corpus_pipeline.near_duplicates(spark, documents(*pairs, *others), "").collect()
    assert sorted(r.doc_id for r in left) == [10 * i for i in range(30)] + [i for i, _ in others]


def test_edited_copies_against_brute_force(documents):
    """All links at 0.4 or more and no other, though texts with a passage in common make one coarse group; in parts of any size."""
    draw, texts = random.Random(12), []
    passage = [f"p{k}" for k in range(12)]
    for _ in range(60):
        words = [f"w{draw.randrange(10**6)}" for _ in range(draw.randrange(15, 40))]
        texts += [" ".join([*passage, *words]), " ".join(edited(draw, [*passage, *words], draw.randrange(6, 30)))]
    sets = [similar_sets.shingle_set(t.encode()) for t in texts]
    parent = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if both >= 0.4 * (len(sets[i]) + len(sets[j]) - both) and parent[i] != parent[j]:
                low, high = sorted((parent[i], parent[j]))
                parent = [low if p == high else p for p in parent]
    for cell_shingles in (1 << 20, 500):
        rows = similar_sets.similar_components(documents(*enumerate(texts)), 0.4, cell_shingles).collect()
        assert [r.component_id for r in sorted(rows, key=lambda r: r.doc_id)] == parent
    assert 1 < len(set(parent)) < len(texts)
