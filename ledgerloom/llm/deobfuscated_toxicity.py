"""Toxicity of documents, scored on text restored by a noisy-channel decoder.

Writers hide words behind look-alike signs, gaps and repeated letters. A suspicious span becomes a lattice: each sign may
stand for some letters, be noise, or end a word; Viterbi search finds the reading
that is likeliest under a character trigram model. Words and word beginnings of the restored text that mark toxic training
documents are weighed, and a document's total weight is turned into a probability.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.textbytes import LOWER, SPACE, id_and_text, prefix_hashes, slices, span_hashes, words
from ledgerloom.operators.hotkeys import broadcast_if_at_most
from ledgerloom.sources.writers import land

FOLDS = 3
BROADCAST_LABELS = 2_000_000
MARKS = 5_000
LEAST_DOCUMENTS = 4
LEAST_WEIGHT = 1.5
PREFIXES = (4, 5, 6, 7)
THRESHOLD = 0.7

# What a sign may stand for.
LOOK_ALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t",
}
SUBSTITUTED, DELETED, REPEATED, ENDED = 1.0, 5.0, 0.5, 2.0

_LETTER = np.zeros(256, dtype=bool)
_LETTER[ord("a") : ord("z") + 1] = True
_LETTER[128:] = True
_SIGN = np.zeros(256, dtype=bool)
_SIGN[[ord(c) for c in "0123456789@$"]] = True
_INNER = np.zeros(256, dtype=bool)
_INNER[[ord(c) for c in "!|+*_~."]] = True
_GAP = np.zeros(256, dtype=bool)
_GAP[[ord(c) for c in " .-_*~"]] = True

# letters a to z are 1 to 26, other letters 27, anything else 0
_CODE = np.zeros(256, dtype=np.int64)
_CODE[ord("a") : ord("z") + 1] = np.arange(1, 27)
_CODE[128:] = 27
N_CODES = 28


def trigram_counts(data: np.ndarray) -> np.ndarray:
    """Counts of all character trigrams of lower-case text, as a vector of fixed length."""
    code = _CODE[data]
    code = code[~((code == 0) & (np.roll(code, 1) == 0))] if len(code) else code
    if len(code) < 3:
        return np.zeros(N_CODES**3, np.int64)
    return np.bincount((code[:-2] * N_CODES + code[1:-1]) * N_CODES + code[2:], minlength=N_CODES**3)


def trigram_costs(counts: np.ndarray) -> np.ndarray:
    """Negative log probabilities of a character after two others, smoothed towards shorter contexts."""
    tri = counts.reshape(N_CODES, N_CODES, N_CODES).astype(float)
    uni = tri.sum(axis=(0, 1)) + 1.0
    uni /= uni.sum()
    bi = tri.sum(axis=0) + 5.0 * uni
    bi /= bi.sum(axis=1, keepdims=True)
    full = tri + 5.0 * bi[None]
    return -np.log(full / full.sum(axis=2, keepdims=True))


def restore(span: str, costs: np.ndarray) -> str:
    """The likeliest plain reading of a lower-case span.

    A state is the last two characters read. Letters are read as they are; the same letter again may be
    dropped; a sign is read as a letter it resembles, dropped, or ends the word; a gap is dropped or ends the word.
    """
    states: dict[tuple[int, int], tuple[float, str]] = {(0, 0): (0.0, "")}
    earlier = ""
    for char in span:
        alternatives: list[tuple[str, float]] = []
        if char.isalpha():
            alternatives.append((char, 0.0))
            if char == earlier:
                alternatives.append(("", REPEATED))
        else:
            alternatives += [(c, SUBSTITUTED) for c in LOOK_ALIKES.get(char, "")]
            alternatives += [("", DELETED if char in LOOK_ALIKES else 0.1), (" ", ENDED)]
        following: dict[tuple[int, int], tuple[float, str]] = {}
        for (a, b), (cost, text) in states.items():
            for read, price in alternatives:
                if not read or (read == " " and b == 0):
                    state, total, out = (a, b), cost + price, text
                else:
                    code = 0 if read == " " else (ord(read) - 96 if "a" <= read <= "z" else 27)
                    state, total, out = (b, code), cost + price + costs[a, b, code], text + read
                if state not in following or total < following[state][0]:
                    following[state] = (total, out)
        states, earlier = following, char
    ended = [(cost + (costs[a, b, 0] if b else 0.0), text) for (a, b), (cost, text) in states.items()]
    return min(ended)[1].strip()


def suspicious_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Spans of lower-case bytes that may hide a word: signs within words, letters written three times, letters set apart."""
    if len(data) < 3:
        return []
    letter = _LETTER[data]
    left, right = np.zeros_like(letter), np.zeros_like(letter)
    left[1:], right[:-1] = letter[:-1], letter[1:]
    odd = _SIGN[data] & (left | right) | _INNER[data] & left & right
    odd[2:] |= letter[2:] & (data[2:] == data[1:-1]) & (data[2:] == data[:-2])
    spans = []
    if odd.any():
        token = np.unique(np.searchsorted(starts, np.flatnonzero(odd), side="right") - 1)
        token = token[token >= 0]
        spans = list(zip(starts[token].tolist(), ends[token].tolist()))
    alone = letter & ~left & ~right & (data < 128)
    if alone.sum() > 2:
        at = np.flatnonzero(alone)
        joined = np.zeros(len(at), dtype=bool)
        joined[1:] = (np.diff(at) == 2) & _GAP[data[at[1:] - 1]]
        run = np.cumsum(~joined)
        first = np.flatnonzero(~joined)
        sizes = np.bincount(run - 1)
        spans += [(int(at[f]), int(at[f + n - 1]) + 1) for f, n in zip(first.tolist(), sizes.tolist()) if n >= 3]
    return spans


class Decoder:
    """Restores spans under one character model, remembering what it has read."""

    def __init__(self, costs: np.ndarray):
        self.costs = costs
        self.read: dict[bytes, bytes] = {}

    def __call__(self, span: bytes) -> bytes:
        if span not in self.read:
            if len(self.read) > 50_000:
                self.read.clear()
            self.read[span] = restore(span.decode("utf-8", "ignore"), self.costs).encode()
        return self.read[span]


def restored_text(text: str, costs: np.ndarray) -> str:
    """A whole text in lower case with its suspicious spans restored."""
    data = LOWER[np.frombuffer(text.encode(), dtype=np.uint8)]
    starts, ends = words(data, np.array([0, len(data)]))
    whole, out, at, decode = data.tobytes(), [], 0, Decoder(costs)
    for start, end in sorted(suspicious_spans(data, starts, ends)):
        if start >= at:
            out += [whole[at:start], decode(whole[start:end])]
            at = end
    return b"".join([*out, whole[at:]]).decode("utf-8", "ignore")


def _runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and texts of all runs of letters."""
    masked = np.where(_LETTER[data], data, 32).astype(np.uint8)
    starts, ends = words(masked, offsets)
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def _marks(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the letter runs (row 0) and of their beginnings, and the text of each run; zero where a run is too short."""
    starts, ends, text = _runs(data, offsets)
    if not len(starts):
        return np.zeros((1 + len(PREFIXES), 0), np.uint64), text
    prefix = prefix_hashes(data)
    rows = [span_hashes(prefix, starts, ends)]
    for n in PREFIXES:
        stop = np.minimum(starts + n, len(data))
        rows.append(np.where(ends - starts >= n, span_hashes(prefix, starts, stop) ^ np.uint64(n), np.uint64(0)))
    return np.stack(rows), text


def document_marks(data: np.ndarray, offsets: np.ndarray, decode: Decoder) -> tuple[np.ndarray, np.ndarray]:
    """Marks of every text of a slice, those of its restored words included."""
    data = LOWER[data]
    marks, text = _marks(data, offsets)
    starts, ends = words(data, offsets)
    spans = suspicious_spans(data, starts, ends)
    if not spans:
        return marks, text
    whole = data.tobytes()
    owners = np.searchsorted(offsets, [s for s, _ in spans], side="right") - 1
    restored = [decode(whole[a:b]) for a, b in spans]
    order = np.argsort(owners, kind="stable")
    sizes = np.zeros(len(offsets) - 1, np.int64)
    for i in order.tolist():
        sizes[owners[i]] += len(restored[i]) + 1
    more = LOWER[np.frombuffer(b"".join(restored[i] + b" " for i in order.tolist()), dtype=np.uint8)]
    more_marks, more_text = _marks(more, np.concatenate([[0], np.cumsum(sizes)]))
    return np.concatenate([marks, more_marks], axis=1), np.concatenate([text, more_text])


def evidence(data: np.ndarray, offsets: np.ndarray, decode: Decoder, keys: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Of each text, the summed weights of its different words; a word weighs as much as its heaviest mark."""
    total = np.zeros(len(offsets) - 1)
    if not len(keys):
        return total
    marks, text = document_marks(data, offsets, decode)
    maybe = np.zeros(1 << 16, dtype=bool)
    maybe[(keys & np.uint64(0xFFFF)).astype(np.int64)] = True
    best = np.zeros(len(text))
    for row in marks:
        at = np.flatnonzero(maybe[(row & np.uint64(0xFFFF)).astype(np.int64)])
        place = np.minimum(np.searchsorted(keys, row[at]), len(keys) - 1)
        found = keys[place] == row[at]
        np.maximum.at(best, at[found], weights[place[found]])
    hit = np.flatnonzero(best > 0)
    if len(hit):
        pairs, first = np.unique(np.stack([text[hit].astype(np.uint64), marks[0, hit]]), axis=1, return_index=True)
        np.add.at(total, pairs[0].astype(np.int64), best[hit][first])
    return total


def held_out(folds: int = FOLDS) -> Column:
    """Whether labels of the row may not be learned from; a null id has no label to learn."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("long").cast("string")) % folds == 1, F.lit(False))


def training_rows(documents: DataFrame, labels: DataFrame, folds: int = FOLDS) -> DataFrame:
    """``doc_id, text, toxic`` of every labelled row that may be learned from.

    An id with several labels is toxic if any says so. Labels are broadcast if a count finds them few; otherwise the texts they belong
    to are shuffled to them, once, and written, as they are read several times.
    """
    known = labels.filter("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("__doc_id")).agg(
        F.max(F.col("toxic") == 1).alias("__toxic")
    )
    known = land(known.filter(F.crc32(F.col("__doc_id").cast("string")) % folds != 1), "toxic-labels")
    side = broadcast_if_at_most(known, BROADCAST_LABELS)
    marked = id_and_text(documents).join(side, F.col("doc_id") == F.col("__doc_id")).select("doc_id", "text", F.col("__toxic").alias("toxic"))
    return land(marked, "labelled-texts") if side is known else marked


def fit_characters(rows: DataFrame) -> np.ndarray:
    """Costs of the character model of ``rows``; each task sends one vector of fixed length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(N_CODES**3, np.int64)
        for _, data, _ in slices(batches):
            counts += trigram_counts(LOWER[data])
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], ["trigram", "n"])

    counts = np.zeros(N_CODES**3, np.int64)
    for trigram, n in rows.mapInArrow(run, "trigram long, n long").groupBy("trigram").agg(F.sum("n")).collect():
        counts[trigram] = n
    return trigram_costs(counts)


def fit_marks(rows: DataFrame, costs: np.ndarray, marks: int = MARKS) -> tuple[np.ndarray, np.ndarray]:
    """The ``marks`` marks that speak most surely for toxicity, sorted by hash, with their weights.

    A weight is the log of how much more often toxic documents have the mark, less two standard errors.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = Decoder(costs)
        for part, data, offsets in slices(batches):
            toxic = np.array(part.column(2).to_pylist(), dtype=bool)
            found, text = document_marks(data, offsets, decode)
            pairs = np.stack([np.tile(text, len(found)).astype(np.uint64), found.ravel()])[:, found.ravel() != 0]
            order = np.lexsort(pairs)
            pairs = pairs[:, order]
            new = np.ones(pairs.shape[1], dtype=bool)
            new[1:] = (pairs[:, 1:] != pairs[:, :-1]).any(axis=0)
            pairs = pairs[:, new]
            if not pairs.shape[1]:
                continue
            key, first = np.unique(pairs[1], return_index=True)
            n = np.diff(np.append(first, pairs.shape[1]))
            positive = np.add.reduceat(toxic[pairs[0].astype(np.int64)].astype(np.int64), first)
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n), pa.array(positive)], ["mark", "n", "positive"])

    totals = rows.agg(F.count(F.lit(1)), F.count_if("toxic")).first()
    n_toxic, n_clean = totals[1], totals[0] - totals[1]
    if not n_toxic or not n_clean:
        return np.zeros(0, np.uint64), np.zeros(0)
    counted = rows.mapInArrow(run, "mark long, n long, positive long").groupBy("mark").agg(F.sum("n").alias("n"), F.sum("positive").alias("positive"))
    negative = F.col("n") - F.col("positive")
    error = F.sqrt(1 / F.col("positive") + 1 / (negative + 0.5))
    weight = F.log(F.col("positive") / F.lit(float(n_toxic))) - F.log((negative + 0.5) / F.lit(float(n_clean))) - 2 * error
    sure = counted.filter(F.col("positive") >= LEAST_DOCUMENTS).withColumn("weight", weight).filter(F.col("weight") >= LEAST_WEIGHT)
    chosen = sure.orderBy(F.desc(F.col("weight") * F.sqrt("positive")), "mark").limit(marks).select("mark", "weight").collect()
    keys = np.array([r[0] for r in chosen], dtype=np.int64).view(np.uint64)
    order = np.argsort(keys)
    return keys[order], np.array([r[1] for r in chosen], dtype=float)[order]


def weigh(costs: np.ndarray, keys: np.ndarray, weights: np.ndarray) -> Column:
    """The evidence of ``text`` as a column."""

    @F.arrow_udf("double")
    def run(texts: pa.Array) -> pa.Array:
        decode = Decoder(costs)
        batch = pa.RecordBatch.from_arrays([texts], ["text"])
        sums = [evidence(data, offsets, decode, keys, weights) for _, data, offsets in slices(iter([batch]))]
        return pa.array(np.concatenate(sums) if sums else np.zeros(0))

    return run(F.coalesce(F.col("text").cast("string"), F.lit("")))


def fit_scores(weighed: DataFrame) -> tuple[float, float]:
    """Intercept and slope of the log odds of ``toxic`` by the square root of ``evidence``, from a histogram of 256 steps."""
    step = F.floor(F.least(F.sqrt("evidence"), F.lit(16.0)) * 16)
    rows = weighed.groupBy(step.alias("step")).agg(F.count(F.lit(1)), F.count_if("toxic")).collect()
    if not rows:
        return -20.0, 0.0
    x, n, y = (np.array([r[i] for r in rows], dtype=float) for i in range(3))
    x = (x + 0.5) / 16 * (x > 0)
    beta = np.array([np.log((y.sum() + 0.5) / (n.sum() - y.sum() + 0.5)), 0.0])
    design = np.stack([np.ones_like(x), x])
    for _ in range(50):
        p = 1 / (1 + np.exp(-design.T @ beta))
        curve = (design * (n * p * (1 - p))) @ design.T + 1e-3 * np.eye(2)
        move = np.linalg.solve(curve, design @ (y - n * p) - 1e-3 * beta)
        beta = beta + np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-9:
            break
    return float(beta[0]), float(beta[1])


def toxicity(documents: DataFrame, labels: DataFrame, folds: int = FOLDS, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``documents``: ``doc_id, held_out, score, predicted, evidence``.

    Only the text is scored. Labels are learned from every labelled document outside the held-out fold. Null and empty
    texts have no evidence and get the lowest score; a null id is scored but never learned from; repeated rows get
    equal scores. Without labels of both kinds every text gets the share of toxic labels. An empty table gives an empty
    result; other columns are ignored.
    """
    training = training_rows(documents, labels, folds)
    costs = fit_characters(training)
    keys, weights = fit_marks(training, costs)
    intercept, slope = fit_scores(training.select("toxic", weigh(costs, keys, weights).alias("evidence")))
    scored = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out(folds).alias("held_out"), weigh(costs, keys, weights).alias("evidence")
    )
    score = 1 / (1 + F.exp(-(F.lit(intercept) + F.lit(slope) * F.sqrt("evidence"))))
    return scored.withColumn("score", score).select(
        "doc_id", "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "evidence"
    )
