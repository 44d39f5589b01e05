"""Quality filter by importance resampling.

Two bag-of-n-gram models over hashed buckets are estimated, one of target text (labelled good) and one of all raw text. A
document's importance weight is the ratio of its probabilities under them, and the sample is
drawn without replacement by adding Gumbel noise to the log weights and taking the top k.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.textbytes import SPACE, id_and_text, mix, prefix_hashes, slices, span_hashes
from ledgerloom.sources.writers import land

BUCKETS = 10_000
LABELLED_ROWS = 200_000
GOOD_LOSS = 5.0
PRIOR = 5.0
SEED = 7
HISTOGRAM = 1024

# byte kinds: blank, letter, capital, digit, sign
_KIND = np.full(256, 4, dtype=np.uint8)
_KIND[SPACE] = 0
_KIND[128:] = 1
_KIND[ord("a") : ord("z") + 1] = 1
_KIND[ord("A") : ord("Z") + 1] = 2
_KIND[ord("0") : ord("9") + 1] = 3
_GROUP = np.array([0, 1, 1, 1, 2], dtype=np.uint8)[_KIND]


def features(data: np.ndarray, offsets: np.ndarray, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of a slice, and the text each belongs to.

    Tokens are runs of word characters and runs of signs. The n-grams are: single tokens, pairs of tokens, and triples of token
    shapes: capitalised, all capitals, digits, the signs themselves, and whether a word repeats one of the two before it.
    """
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    group = _GROUP[data]
    change = np.ones(len(data), dtype=bool)
    change[1:] = group[1:] != group[:-1]
    filled = offsets[1:] > offsets[:-1]
    change[offsets[:-1][filled]] = True
    places = np.flatnonzero(change)
    ends = np.append(places[1:], len(data))
    solid = group[places] > 0
    starts, ends = places[solid], ends[solid]
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    text = np.searchsorted(offsets, starts, side="right") - 1
    content = span_hashes(prefix_hashes(data), starts, ends)
    kind = _KIND[data]
    capitals = np.concatenate([[0], np.cumsum(kind == 2)])
    n_capitals = capitals[ends] - capitals[starts]
    first = kind[starts]
    shape = np.where(first == 2, 2, first).astype(np.uint64)
    shape[(n_capitals > 1) & (n_capitals == ends - starts)] = 5
    signs = first == 4
    shape[signs] = np.uint64(16) + content[signs] % np.uint64(256)

    def before(values: np.ndarray, by: int) -> np.ndarray:
        out = np.zeros_like(values)
        out[by:] = values[:-by] if len(values) > by else 0
        return out

    repeated = np.zeros(len(content), dtype=bool)
    for by in (1, 2):
        repeated |= (content == before(content, by)) & (before(text + 1, by) == text + 1) & ~signs
    shape[repeated] += np.uint64(8)
    same1, same2 = before(text + 1, 1) == text + 1, before(text + 1, 2) == text + 1
    shape1, shape2 = np.where(same1, before(shape, 1), 1023), np.where(same2, before(shape, 2), 1023)
    factor = np.uint64(0x94D049BB133111EB)
    pair = mix(np.where(same1, before(content, 1), np.uint64(1)) * factor + content + np.uint64(1))
    triple = mix((shape2 * np.uint64(1024) + shape1) * np.uint64(1024) + shape + np.uint64(3 << 40))
    grams = np.concatenate([mix(content + np.uint64(2)), pair, triple]) % np.uint64(buckets)
    return grams.astype(np.int64), np.tile(text, 3)


def labelled_sample(labels: DataFrame, rows: int = LABELLED_ROWS) -> DataFrame:
    """``__doc_id, __good`` of at most about ``rows`` labelled documents, drawn by hash of their id.

    One row per id, so that the table is small enough to broadcast; several labels of one id count as
    good if any does. Null ids and labels are no labels.
    """
    known = labels.filter("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("__doc_id")).agg(
        F.max(F.col("quality") == 1).alias("__good")
    )
    total = known.count()
    if total <= rows:
        return known
    return known.filter(F.pmod(F.xxhash64("__doc_id"), F.lit(1_000_000)) < F.lit(1_000_000 * rows // total))


def gram_counts(documents: DataFrame, sample: DataFrame, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Counts of all buckets in the target text and in the raw text, from every document; two vectors of fixed length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, raw = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for part, data, offsets in slices(batches):
            good = np.array(part.column(2).to_pylist(), dtype=object) == True  # noqa: E712 - null is not good
            grams, text = features(data, offsets, buckets)
            raw += np.bincount(grams, minlength=buckets)
            target += np.bincount(grams[good[text]], minlength=buckets)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(buckets)), pa.array(target), pa.array(raw)], ["bucket", "target", "raw"])

    marked = id_and_text(documents).join(F.broadcast(sample), F.col("doc_id") == F.col("__doc_id"), "left")
    counted = marked.select("doc_id", "text", "__good").mapInArrow(run, "bucket long, target long, raw long")
    target, raw = np.zeros(buckets), np.zeros(buckets)
    for bucket, t, r in counted.groupBy("bucket").agg(F.sum("target"), F.sum("raw")).collect():
        target[bucket], raw[bucket] = t, r
    return target, raw


def log_ratios(target: np.ndarray, raw: np.ndarray, prior: float = PRIOR) -> np.ndarray:
    """Log probability of each bucket under the target model over that under the raw model.

    The target is smoothed towards the raw model by ``prior`` pseudo-counts for each bucket, so a bucket that the labels tell
    nothing about weighs nothing.
    """
    base = (raw + 0.5) / (raw + 0.5).sum()
    smooth = (target + prior * len(raw) * base) / (target.sum() + prior * len(raw))
    return np.log(smooth) - np.log(base)


def log_weight(weights: np.ndarray) -> Column:
    """The log importance weight of ``text``: the sum over its n-grams, zero for an empty text."""
    buckets = len(weights)

    @F.arrow_udf("double")
    def weigh(texts: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([texts], ["text"])
        sums = []
        for part, data, offsets in slices(iter([batch])):
            grams, text = features(data, offsets, buckets)
            sums.append(np.bincount(text, weights=weights[grams], minlength=part.num_rows))
        return pa.array(np.concatenate(sums) if sums else np.zeros(0))

    return weigh(F.coalesce(F.col("text").cast("string"), F.lit("")))


def gumbel(seed: int = SEED) -> Column:
    """Standard Gumbel noise that is fixed by seed, id and text, so that a rerun draws the same sample."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("doc_id").cast("long"), F.col("text").cast("string")), 11)
    uniform = (bits.cast("double") + 0.5) / F.lit(float(1 << 53))
    return -F.log(-F.log(uniform))


def best_cut(weights: np.ndarray, good: np.ndarray, good_loss: float = GOOD_LOSS) -> float:
    """The weight that best divides labelled documents when a lost good one costs ``good_loss`` and a kept bad one 1."""
    order = np.argsort(weights, kind="stable")
    weights, good = weights[order], good[order]
    lost = np.concatenate([[0], np.cumsum(good)]) * good_loss
    kept = np.concatenate([(~good)[::-1].cumsum()[::-1], [0]])
    at = int(np.argmin(lost + kept))
    if at == 0:
        return -np.inf
    if at == len(weights):
        return np.inf
    return float((weights[at - 1] + weights[at]) / 2)


def kth_largest(df: DataFrame, column: str, k: int) -> float:
    """The k-th largest value of a column, by histograms that close in on it: no row is sorted or gathered."""
    if k <= 0:
        return np.inf
    low, high, above = *df.agg(F.min(column), F.max(column)).first(), 0
    while low < high:
        width = (high - low) / HISTOGRAM
        slot = F.least(F.floor((F.col(column) - low) / F.lit(width)), F.lit(HISTOGRAM - 1))
        inside = df.filter(F.col(column).between(low, high)).groupBy(slot.alias("slot"))
        rows = sorted(inside.agg(F.count(F.lit(1)).alias("n"), F.min(column).alias("low"), F.max(column).alias("high")).collect(), reverse=True)
        for _, n, slot_low, slot_high in rows:
            if above + n >= k:
                shrunk = (slot_low, slot_high) != (low, high)
                low, high = slot_low, slot_high
                break
            above += n
        if not shrunk:
            break
    return low


def _sampled(documents: DataFrame, labels: DataFrame, keep: float | None, buckets: int, temperature: float, seed: int) -> DataFrame:
    """``row`` (all columns of a drawn row as one, so that no name can clash), ``log_weight`` and ``sample_key``."""
    sample = land(labelled_sample(labels), "labelled-sample")
    weights = log_ratios(*gram_counts(documents, sample, buckets))
    key = F.col("log_weight") / F.lit(float(temperature)) + gumbel(seed)
    rows = documents.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = rows.withColumn("log_weight", log_weight(weights)).withColumn("sample_key", key)
    keys = scored.join(F.broadcast(sample), F.col("doc_id") == F.col("__doc_id"), "left")
    keys = land(keys.select("log_weight", "sample_key", "__good"), "sample-keys")
    total = keys.count()
    if not total:
        return scored
    if keep is None:
        known = keys.filter("__good is not null").select("log_weight", "__good").toPandas()
        cut = best_cut(known["log_weight"].to_numpy(float), known["__good"].to_numpy(bool)) if known["__good"].any() else -np.inf
        k = keys.filter(F.col("log_weight") >= F.lit(float(cut))).count()
    else:
        k = round(keep * total)
    return scored.filter(F.col("sample_key") >= F.lit(float(kth_largest(keys, "sample_key", k))))


def resample(
    documents: DataFrame, labels: DataFrame, keep: float | None = None, buckets: int = BUCKETS, temperature: float = 1.0, seed: int = SEED
) -> DataFrame:
    """``doc_id, log_weight, sample_key`` of the rows of ``documents`` that the sample holds.

    The sample has ``keep`` of all rows; by default as many as have a weight above the cut
    that best divides the labelled documents. Labels are used from ``LABELLED_ROWS`` documents at most; everything
    else comes from all rows. Rows whose key ties with the last one drawn, repeated rows among them, are
    drawn together. Empty and null texts have weight zero. Without usable labels the models agree and,
    unless ``keep`` says otherwise, every row stays. An empty table gives an empty result; other columns are ignored.
    """
    return _sampled(documents, labels, keep, buckets, temperature, seed).select("doc_id", "log_weight", "sample_key")


def sampled_documents(
    documents: DataFrame, labels: DataFrame, keep: float | None = None, buckets: int = BUCKETS, temperature: float = 1.0, seed: int = SEED
) -> DataFrame:
    """The same rows with all columns of ``documents``, and no other."""
    return _sampled(documents, labels, keep, buckets, temperature, seed).select("row.*")
