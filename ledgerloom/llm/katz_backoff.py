"""Language-model scores by a Katz backoff model of words, pairs and triples, trained and evaluated over the whole corpus.

A word seen after its two predecessors has its Good-Turing discounted share of what follows them; the mass set free is
given to all other words by their probability after the nearer predecessor alone, times a backoff weight that makes the sum exactly one.
That probability is had in the same way from the unigrams, which are discounted likewise in favour of unknown words.

Words are 64-bit hashes. A batch of some million tokens is a row of a written table: its different words, and its tokens as numbers
of these. Only different words and different triples leave a batch, packed by buckets of the middle word, with a place for each
token. The bucket of a word's hash holds its count from all batches and answers each, with its rank by count there: rank and bucket
number the word. The bucket of a middle word holds all pairs that it begins and all triples around it, and so all counts
and backoff weights that their recursion needs, and the scores of the tokens there, which go back as sums per document.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.textbytes import LOWER, id_and_text, prefix_hashes, slices, span_hashes, words
from ledgerloom.sources.writers import land

FOLDS = 5
BATCH_TOKENS = 1_000_000
BUCKET_TOKENS = 1_000_000
LARGEST_DISCOUNTED = 5
BROADCAST_BYTES = 4 << 20
BATCHES_A_TASK = 4
END = np.uint64(0x1F83D9ABFB41BD6B)
EXACT_CODES = 4096


def _pack(values: np.ndarray) -> bytes:
    """Integers as compressed byte planes: high bytes, mostly zero, cost next to nothing. Only runs of a byte are sought in them."""
    if not len(values):
        return b""
    packer = zlib.compressobj(1, strategy=zlib.Z_RLE)
    return packer.compress(np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes()) + packer.flush()


def _unpack(data: bytes, dtype: type) -> np.ndarray:
    if not data:
        return np.zeros(0, dtype)
    width = np.dtype(dtype).itemsize
    planes = np.frombuffer(zlib.decompress(data), dtype=np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(dtype)


def _pack_sorted(values: np.ndarray) -> bytes:
    return _pack(np.diff(values, prepend=np.uint64(0)))


def _unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(_unpack(data, np.uint64), dtype=np.uint64)


def _pack_runs(values: np.ndarray, first: np.ndarray) -> bytes:
    """Values that rise within runs, as steps; ``first`` tells where runs begin."""
    steps = np.diff(values, prepend=np.uint64(0))
    steps[first] = values[first]
    return _pack(steps)


def _unpack_runs(data: bytes, lengths: np.ndarray) -> np.ndarray:
    steps = _unpack(data, np.uint64)
    sums, first = np.cumsum(steps, dtype=np.uint64), np.cumsum(lengths) - lengths
    return sums - np.repeat(sums[first] - steps[first], lengths)


def _edges(sorted_hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Where each of ``buckets`` equal ranges of the hash begins in a sorted array, and the end."""
    bounds = np.array([(i << 64) // buckets for i in range(buckets)], dtype=np.uint64)
    return np.append(np.searchsorted(sorted_hashes, bounds), len(sorted_hashes))


def held_out(folds: int = FOLDS) -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("long").cast("string")) % folds == 1, F.lit(False))


BATCH = "batch long, doc_ids array<long>, held array<boolean>, sizes binary, vocabulary binary, common binary, tokens binary, n_tokens long"


def token_batches(documents: DataFrame, folds: int = FOLDS, batch_tokens: int = BATCH_TOKENS) -> DataFrame:
    """The corpus as batches of whole documents, each of about ``batch_tokens`` tokens; a longer document is a batch of its own.

    ``common`` has the places in the vocabulary by falling frequency, and tokens are places in it, so that most are small.
    """

    def batch(parts: list[tuple]) -> pa.RecordBatch:
        ids, held, sizes, hashes = (np.concatenate([p[i] for p in parts]) for i in range(4))
        vocabulary, tokens, times = np.unique(hashes, return_inverse=True, return_counts=True)
        common = np.argsort(-times, kind="stable").astype(np.uint32)
        place = np.empty_like(common)
        place[common] = np.arange(len(common), dtype=np.uint32)
        row = [[0], [ids.tolist()], [held.tolist()], [_pack(sizes.astype(np.uint32))], [_pack_sorted(vocabulary)], [_pack(common)], [_pack(place[tokens])]]
        types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), *[pa.binary()] * 4]
        arrays = [pa.array(v, t) for v, t in zip(row, types)]
        return pa.RecordBatch.from_arrays([*arrays, pa.array([len(hashes)], pa.int64())], [c.split()[0] for c in BATCH.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, n = [], 0
        for part, data, offsets in slices(batches):
            data = LOWER[data]
            starts, ends = words(data, offsets)
            per_text = np.bincount(np.searchsorted(offsets, starts, side="right") - 1, minlength=len(offsets) - 1)[: len(offsets) - 1]
            sizes = per_text + 1
            hashes = np.full(sizes.sum(), END)
            inner = np.ones(len(hashes), dtype=bool)
            inner[np.cumsum(sizes) - 1] = False
            hashes[inner] = span_hashes(prefix_hashes(data), starts, ends)
            ids = np.array(part.column(0).to_pylist(), dtype=object)
            parts.append((ids, np.array(part.column(2).to_pylist(), dtype=bool), sizes, hashes))
            n += len(hashes)
            if n >= batch_tokens:
                yield batch(parts)
                parts, n = [], 0
        if parts:
            yield batch(parts)

    rows = id_and_text(documents, held_out(folds).alias("held")).mapInArrow(run, BATCH)
    return rows.withColumn("batch", F.monotonically_increasing_id())


class Batch:
    """A batch unpacked."""

    def __init__(self, row: dict):
        self.number, self.doc_ids = row["batch"], row["doc_ids"]
        self.held = np.array(row["held"], dtype=bool)
        self.sizes = _unpack(row["sizes"], np.uint32).astype(np.int64)
        self.vocabulary = _unpack_sorted(row.get("vocabulary", b""))
        self.tokens = _unpack(row["common"], np.uint32).astype(np.int32)[_unpack(row["tokens"], np.uint32)]
        self.document = np.repeat(np.arange(len(self.sizes), dtype=np.int32), self.sizes)


def word_requests(batches: DataFrame, buckets: int) -> DataFrame:
    """``bucket, batch, words, counts``: how often each word of a batch occurs in training text, by ranges of the hash."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in rows:
            for row in part.to_pylist():
                own = Batch(row)
                counts = np.bincount(own.tokens[~own.held[own.document]], minlength=len(own.vocabulary)).astype(np.uint32)
                edges = _edges(own.vocabulary, buckets)
                cells = [(i, a, b) for i, (a, b) in enumerate(zip(edges[:-1], edges[1:])) if b > a]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([i for i, _, _ in cells], pa.int32()), pa.array([own.number] * len(cells), pa.int64()),
                        pa.array([_pack_sorted(own.vocabulary[a:b]) for _, a, b in cells], pa.binary()), pa.array([_pack(counts[a:b]) for _, a, b in cells], pa.binary()),
                    ],
                    ["bucket", "batch", "words", "counts"],
                )

    return batches.mapInArrow(run, "bucket int, batch long, words binary, counts binary")


def count_code(counts: np.ndarray) -> np.ndarray:
    """Counts as 16 bits: exact below 4096, then in steps of a thousandth of an octave. The unigram model sees counts by code."""
    large = np.maximum(counts, EXACT_CODES).astype(float)
    steps = EXACT_CODES + np.floor(1000 * np.log2(large / EXACT_CODES))
    return np.where(counts < EXACT_CODES, counts, np.minimum(steps, 65535)).astype(np.uint16)


def code_count(codes: np.ndarray) -> np.ndarray:
    codes = codes.astype(float)
    return np.where(codes < EXACT_CODES, codes, EXACT_CODES * 2 ** ((codes - EXACT_CODES) / 1000))


def word_answers(requests: DataFrame) -> DataFrame:
    """To each request, ``counts`` of its words in the whole training text and their ``ranks`` by count in the bucket, from 1; and per
    bucket the number of words of each code."""

    def answer(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        keys = [_unpack_sorted(r["words"]) for r in rows]
        word, place = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(place, weights=np.concatenate([_unpack(r["counts"], np.uint32) for r in rows]), minlength=len(word)).astype(np.uint64)
        rank = np.empty(len(word), np.uint64)
        rank[np.lexsort((word, -total.astype(np.int64)))] = np.arange(1, len(word) + 1, dtype=np.uint64)
        cuts = np.cumsum([len(k) for k in keys])[:-1]
        code, n = np.unique(count_code(total), return_counts=True)
        empty = [None] * len(rows)
        return pa.table(
            {
                "bucket": pa.array([r["bucket"] for r in rows] + [rows[0]["bucket"]], pa.int32()),
                "batch": pa.array([r["batch"] for r in rows] + [None], pa.int64()),
                "counts": pa.array([_pack(c) for c in np.split(total[place], cuts)] + [None], pa.binary()),
                "ranks": pa.array([_pack(r) for r in np.split(rank[place], cuts)] + [None], pa.binary()),
                "codes": pa.array([*empty, code.tolist()], pa.list_(pa.int32())),
                "words": pa.array([*empty, n.tolist()], pa.list_(pa.int64())),
                "total": pa.array([*empty, int(total.sum())], pa.int64()),
            }
        )

    return requests.groupBy("bucket").applyInArrow(
        answer, "bucket int, batch long, counts binary, ranks binary, codes array<int>, words array<long>, total long"
    )


def discounts(of_counts: np.ndarray, largest: int = LARGEST_DISCOUNTED) -> np.ndarray:
    """Factors for counts 0 to ``largest`` from the numbers of things seen so often (index is the count).

    Good-Turing estimates scaled to leave counts above ``largest`` alone. Where there are too few counts for
    an estimate between zero and one, half a count is taken off.
    """
    n = np.zeros(largest + 2)
    n[: min(len(of_counts), largest + 2)] = of_counts[: largest + 2]
    factors = np.ones(largest + 1)
    above = (largest + 1) * n[largest + 1] / n[1] if n[1] else 1.0
    for r in range(1, largest + 1):
        estimate = (r + 1) * n[r + 1] / n[r] / r if n[r] else 0.0
        factor = (estimate - above) / (1 - above) if above < 1 else 0.0
        factors[r] = factor if 0 < factor < 1 else (r - 0.5) / r
    return factors


def unigram_model(words_of_code: dict[int, int]) -> np.ndarray:
    """Probability of a word by the code of its count; at 0 that of all unknown words together. Sums to one over all words."""
    codes = np.array(sorted(c for c in words_of_code if c), dtype=np.int64)
    out = np.zeros(1 << 16)
    if not len(codes):
        out[0] = 1.0
        return out
    n, value = np.array([words_of_code[c] for c in codes], dtype=float), code_count(codes)
    of_counts = np.zeros(LARGEST_DISCOUNTED + 2)
    small = codes <= LARGEST_DISCOUNTED + 1
    of_counts[codes[small]] = n[small]
    factor = discounts(of_counts)[np.minimum(codes, LARGEST_DISCOUNTED)]
    kept = np.where(codes <= LARGEST_DISCOUNTED, value * factor, value)
    free = max((n * (value - kept)).sum(), 0.5)
    total = (n * kept).sum() + free
    out[codes] = kept / total
    out[0] = free / total
    return out


def _answered(batches: DataFrame, answers: DataFrame) -> DataFrame:
    """Batches with the counts and ranks of their words, in the order of their vocabulary, which stays behind.

    Answers grow with the corpus. They are broadcast only if they are few bytes; else batches and answers are dealt by batch,
    a few to a task.
    """
    answers, batches = answers.filter("batch is not null"), batches.drop("vocabulary")
    size = F.coalesce(F.sum(F.octet_length("counts") + F.octet_length("ranks")), F.lit(0))
    n_bytes, n_batches = answers.agg(size, F.count_distinct("batch")).first()
    small = n_bytes <= BROADCAST_BYTES
    if not small:
        tasks = -(-n_batches // BATCHES_A_TASK)
        batches, answers = batches.repartition(tasks, "batch"), answers.repartition(tasks, "batch")
    parts = answers.groupBy("batch").agg(F.sort_array(F.collect_list(F.struct("bucket", "counts", "ranks"))).alias("answers"))
    return batches.join(F.broadcast(parts) if small else parts, "batch")


def _counts(row: dict) -> np.ndarray:
    return np.concatenate([_unpack(a["counts"], np.uint64) for a in row["answers"]]) if row["answers"] else np.zeros(0, np.uint64)


def _numbers(row: dict, buckets: int) -> np.ndarray:
    """The number of each word: its rank by count, times the buckets, plus its bucket. Zero stands for what precedes a text."""
    ranks = [_unpack(a["ranks"], np.uint64) * np.uint64(buckets) + np.uint64(a["bucket"]) for a in row["answers"]]
    return np.concatenate(ranks) if ranks else np.zeros(0, np.uint64)


CELL = (
    "bucket int, batch long, contexts binary, followers binary, words binary, codes binary, "
    "preceders binary, befores binary, times binary, places binary, n_documents int"
)


def pair_cells(answered: DataFrame, buckets: int, order: int = 2) -> DataFrame:
    """The different pairs or triples (``order`` 2 or 3) of each batch by the bucket of the word before the last, with the documents they stand in.

    Of each such word (``contexts``) its different ``followers`` are given, and of each pair the words that precede it (``befores``, none
    for pairs alone). ``codes`` are those of the different followers' counts, in the order of their numbers. A place is a document's number
    in the batch, doubled, plus one in training text.
    """

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in rows:
            for row in part.to_pylist():
                own = Batch(row)
                numbers = np.append(_numbers(row, buckets), np.uint64(0))
                codes = np.append(count_code(_counts(row)), np.uint16(0))
                none = len(numbers) - 1
                begin = np.cumsum(own.sizes) - own.sizes
                before = np.roll(own.tokens, 1)
                before[begin] = none
                first = np.full(len(before), none, np.int32)
                if order == 3:
                    first[1:] = before[:-1]
                    first[begin] = none
                by_bucket = np.lexsort((numbers, numbers % np.uint64(buckets)))
                place, rank = np.empty(len(numbers), np.int64), np.empty(len(numbers), np.int64)
                place[by_bucket] = np.arange(len(numbers))
                by_number = np.argsort(numbers)
                rank[by_number] = np.arange(len(numbers))
                codes = codes[by_number]
                if len(numbers) < 2_000_000:
                    key = place[before]
                    for more in (own.tokens, first):
                        key *= len(numbers)
                        key += rank[more]
                    at = np.argsort(key, kind="stable")
                    del key
                else:
                    at = np.lexsort((rank[first], rank[own.tokens], place[before]))
                b, c, a = before[at], own.tokens[at], first[at]
                new_pair = np.concatenate([[True], (b[1:] != b[:-1]) | (c[1:] != c[:-1])])
                start = np.flatnonzero(np.concatenate([[True], new_pair[1:] | (a[1:] != a[:-1])]))
                places = (own.document * 2 + ~own.held[own.document]).astype(np.uint32)[at]
                ends = np.append(start, len(at))
                times = np.diff(ends)
                del at
                b, c, a, new_pair = numbers[b[start]], c[start], numbers[a[start]], new_pair[start]
                edges = np.searchsorted(b % np.uint64(buckets), np.arange(buckets + 1, dtype=np.uint64))
                columns: list[list] = [[] for _ in CELL.split(", ")]
                for i, (lo, hi) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())):
                    if lo == hi:
                        continue
                    pairs = np.flatnonzero(new_pair[lo:hi])
                    contexts, new, followers = np.unique(b[lo:hi][pairs], return_index=True, return_counts=True)
                    words = c[lo:hi][pairs]
                    values = [
                        i, own.number, _pack_sorted(contexts), _pack(followers.astype(np.uint32)), _pack_runs(numbers[words], new), _pack(codes[np.unique(rank[words])]),
                        _pack(np.diff(np.append(pairs, hi - lo)).astype(np.uint32)), _pack_runs(a[lo:hi], pairs),
                        _pack(times[lo:hi].astype(np.uint32)), _pack(places[ends[lo] : ends[hi]]), len(own.sizes),
                    ]
                    for column, value in zip(columns, values):
                        column.append(value)
                types = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
                named = [c.split() for c in CELL.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, types[t]) for c, (_, t) in zip(columns, named)], [n for n, _ in named])

    return answered.mapInArrow(run, CELL)


def _narrow(numbers: np.ndarray) -> np.ndarray:
    """Numbers in half the space where they fit, as they do below four thousand million."""
    return numbers.astype(np.uint32) if not len(numbers) or numbers.max() < 1 << 32 else numbers


def _starts(*keys: np.ndarray) -> np.ndarray:
    """Where a new combination of sorted keys begins."""
    out = np.ones(len(keys[0]), dtype=bool)
    out[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return out


def backed_off(count: np.ndarray, context: np.ndarray, lower: np.ndarray, factors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One step of the recursion: probability of each word after its context, and the backoff weight of each context.

    ``count`` is how often training text has the two together, ``lower`` the probability of the word after the shorter context.
    What discounting frees goes to the words not seen after the context, by ``lower``; where it frees nothing, half a
    count is added to the context for them. An unknown context leaves ``lower`` as it is.
    """
    n_contexts = int(context.max()) + 1 if len(context) else 0
    seen = count > 0
    kept = count.copy()
    small = np.flatnonzero(count <= LARGEST_DISCOUNTED)
    kept[small] *= factors[count[small].astype(np.int8)]
    kept_of = np.bincount(context, weights=kept, minlength=n_contexts)
    known = np.bincount(context, weights=lower * seen, minlength=n_contexts)
    whole = np.bincount(context, weights=count, minlength=n_contexts)
    free = whole - kept_of
    free = np.where((free < 1e-9) & (whole > 0), 0.5, free)
    total = np.maximum(kept_of + free, 1e-300)
    weight = np.where(whole > 0, free / total / np.maximum(1 - known, 1e-12), 1.0)
    unseen = np.flatnonzero(~seen)
    kept /= total[context]
    kept[unseen] = weight[context[unseen]] * lower[unseen]
    return kept, weight


class Bucket:
    """All pairs that begin with a word of one bucket and all triples around it, from all batches."""

    def __init__(self, rows: list[dict]):
        self.rows = [{k: row[k] for k in ("bucket", "batch", "n_documents")} for row in rows]
        # places stay by batch: they alone are as many as the tokens
        self.times, self.places = [], []
        parts: list[list] = [[] for _ in range(4)]
        followed, codes = [], []
        for row in rows:
            followers, preceders = _unpack(row["followers"], np.uint32).astype(np.int64), _unpack(row["preceders"], np.uint32).astype(np.int64)
            context = np.repeat(_unpack_sorted(row["contexts"]), followers)
            times, places = _unpack(row["times"], np.uint32).astype(np.int64), _unpack(row["places"], np.uint32)
            words = _narrow(_unpack_runs(row["words"], followers))
            followed.append(np.unique(words))
            codes.append(_unpack(row["codes"], np.uint16))
            values = (
                _narrow(np.repeat(context, preceders)), np.repeat(words, preceders), _narrow(_unpack_runs(row["befores"], preceders)),
                np.add.reduceat(places & 1, np.cumsum(times) - times).astype(np.uint32),
            )
            for p, value in zip(parts, values):
                p.append(value)
            self.times.append(times.astype(np.uint32))
            self.places.append(places)
        b, c, a, trained = (np.concatenate(parts.pop(0)) for _ in range(4))
        at = np.lexsort((a, c, b))
        b, c, a = b[at], c[at], a[at]
        new = _starts(b, c, a)
        self.gram = np.empty(len(at), np.int32)
        self.gram[at] = np.cumsum(new, dtype=np.int32) - 1
        self.before, b, c = a[new], b[new], c[new]
        del a, at, new
        # the pair of each triple, the context of each pair, the two words before each triple
        self.count = np.bincount(self.gram, weights=trained, minlength=len(b))
        one = _starts(b, c)
        self.pair = np.cumsum(one, dtype=np.int32) - 1
        self.pair_count = np.bincount(self.pair, weights=self.count)
        self.context, self.word = b[one], c[one]
        number, first = np.unique(np.concatenate(followed), return_index=True)
        self.code = np.concatenate(codes)[first[np.searchsorted(number, self.word)]]
        self.pair_context = np.cumsum(_starts(self.context)) - 1
        near = np.lexsort((self.before, b))
        self.two = np.empty(len(b), np.int32)
        self.two[near] = np.cumsum(_starts(b[near], self.before[near]), dtype=np.int32) - 1

    def of_counts(self) -> np.ndarray:
        """Numbers of pairs and of triples seen so often in training text."""
        small = [n[(n > 0) & (n <= LARGEST_DISCOUNTED + 1)].astype(np.int64) for n in (self.pair_count, self.count)]
        return np.array([np.bincount(n, minlength=LARGEST_DISCOUNTED + 2) for n in small])

    def model(self, factors: np.ndarray, unigrams: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Probabilities and backoff weights of pairs, backed off to unigrams; with factors for triples also theirs, backed off to pairs."""
        pairs = backed_off(self.pair_count, self.pair_context, unigrams[self.code], factors[0])
        return [pairs] if len(factors) == 1 else [pairs, backed_off(self.count, self.two, pairs[0][self.pair], factors[1])]

    def scores(self, factors: np.ndarray, unigrams: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """For each batch, the summed log probabilities of its documents' tokens in this bucket."""
        top = self.model(factors, unigrams)[-1][0]
        p = np.log10(top[self.pair] if len(factors) == 1 else top)[self.gram]
        gram = 0
        for row, times, places in zip(self.rows, self.times, self.places):
            values = np.repeat(p[gram : gram + len(times)], times)
            yield row["batch"], np.bincount(places >> 1, weights=values, minlength=row["n_documents"])
            gram += len(times)


MODEL = "order int, bucket int, before long, context long, backoff double, word long, unigram double, count long, probability double"


def model_table(cells: DataFrame, factors: np.ndarray, unigrams: np.ndarray) -> DataFrame:
    """The model's pairs and, with two rows of ``factors``, its triples as rows, to be written ``partitionBy("order", "bucket")``.

    ``before`` (of triples only) and ``context`` are the words before, as numbers; ``backoff`` is the weight of these.
    """
    factors = np.atleast_2d(factors)

    def rows(table: pa.Table) -> pa.Table:
        own = Bucket(table.to_pylist())
        levels = own.model(factors, unigrams)
        pair = np.arange(len(own.word))
        of = [(pair, np.zeros(len(pair), np.uint64), own.pair_context, own.pair_count), (own.pair, own.before, own.two, own.count)]
        tables = []
        for order, ((p, weight), (pair, before, context, count)) in enumerate(zip(levels, of), start=2):
            at = np.flatnonzero(count > 0)
            pair = pair[at]
            columns = [
                np.full(len(at), order, np.int32), np.full(len(at), own.rows[0]["bucket"], np.int32), before[at].astype(np.int64), own.context[pair].astype(np.int64),
                weight[context[at]], own.word[pair].astype(np.int64), unigrams[own.code[pair]], count[at].astype(np.int64), p[at],
            ]
            tables.append(pa.table(dict(zip([c.split()[0] for c in MODEL.split(", ")], columns))))
        return pa.concat_tables(tables)

    return cells.groupBy("bucket").applyInArrow(rows, MODEL)


def katz_scores(
    documents: DataFrame, folds: int = FOLDS, batch_tokens: int = BATCH_TOKENS, bucket_tokens: int = BUCKET_TOKENS, order: int = 2
) -> DataFrame:
    """One row per row of ``documents``: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Every whole text is scored; the model learns from the rows outside the held-out fold. A text is its words in lower case (A-Z) and
    an end token; null and empty texts are the end alone. ``n_known`` counts tokens that training text has,
    ``base_score`` is the add-half unigram score, ``score`` the log10 probability of the model of ``order`` 2 or 3. A null id belongs to no fold and is trained
    on. Repeated rows are rows of their own with equal scores. Without training text every word is unknown
    and has probability one. An empty table gives an empty result; other columns are ignored.
    """
    if order not in (2, 3):
        raise ValueError("the order is 2 or 3")
    batches = land(token_batches(documents, folds, batch_tokens), "token-batches")
    n_tokens = batches.agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0]
    buckets = max(1, -(-n_tokens // bucket_tokens))
    answers = land(word_answers(word_requests(batches, buckets)), "words-by-bucket")
    of_code = answers.select("bucket", F.explode(F.arrays_zip("codes", "words")).alias("c")).groupBy(F.col("c.codes").alias("code"))
    words_of_code = {r[0]: r[1] for r in of_code.agg(F.sum("c.words")).collect()}
    train_tokens = answers.agg(F.coalesce(F.sum("total"), F.lit(0))).first()[0]
    n_words = sum(n for code, n in words_of_code.items() if code)
    unigrams = unigram_model(words_of_code)

    answered = _answered(batches, answers)
    dealt = pair_cells(answered, buckets, order).repartition(buckets, "bucket").sortWithinPartitions("bucket")

    def whole_buckets(rows: Iterator[pa.RecordBatch]) -> Iterator[Bucket]:
        held: list[dict] = []
        for part in rows:
            for row in part.to_pylist():
                if held and row["bucket"] != held[0]["bucket"]:
                    whole, held = Bucket(held), []
                    yield whole
                    del whole
                held.append(row)
        if held:
            whole, held = Bucket(held), []
            yield whole

    def of_counts(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket in whole_buckets(rows):
            n = bucket.of_counts()[: order - 1]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(n.size)), pa.array(n.reshape(-1).astype(np.int64))], ["count", "n"])

    def scores(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = None

        def without_counts() -> Iterator[pa.RecordBatch]:
            nonlocal factors
            for part in rows:
                if factors is None and part.num_rows:
                    of_counts = np.array(part.column(part.num_columns - 1)[0].as_py(), dtype=float).reshape(order - 1, -1)
                    factors = np.array([discounts(n) for n in of_counts])
                yield part

        for bucket in whole_buckets(without_counts()):
            for batch, sums in bucket.scores(factors, unigrams):
                at = np.flatnonzero(sums)
                sparse = len(at) * 2 < len(sums)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch]), pa.array([_pack(at.astype(np.uint32)) if sparse else None], pa.binary()), pa.array([(sums[at] if sparse else sums).tobytes()], pa.binary())],
                    ["batch", "places", "sums"],
                )

    def own_rows(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in rows:
            for row in part.to_pylist():
                own = Batch(row)
                counts = _counts(row)[own.tokens].astype(float)
                base = np.log10((counts + 0.5) / (train_tokens + 0.5 * (n_words + 1)))
                n = len(own.sizes)
                sums = np.bincount(own.document, weights=base, minlength=n)
                known = np.bincount(own.document, weights=counts > 0, minlength=n).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, own.number)), pa.array(np.arange(n)), pa.array(own.doc_ids, pa.int64()), pa.array(own.held),
                        pa.array(own.sizes), pa.array(known), pa.array(sums),
                    ],
                    ["batch", "place", "doc_id", "held_out", "n_tokens", "n_known", "base_score"],
                )

    def summed(partial: pa.Table, own: pa.Table) -> pa.Table:
        total = np.zeros(own.num_rows)
        for places, sums in zip(partial["places"].to_pylist(), partial["sums"].to_pylist()):
            at = slice(None) if places is None else _unpack(places, np.uint32)
            total[at] += np.frombuffer(sums)
        return own.drop_columns(["batch", "place"]).append_column("score", pa.array(total[own["place"].to_numpy()]))

    # all uses of the dealt pairs and of the answered batches are branches of one query, so that each is shuffled once
    counted = dealt.mapInArrow(of_counts, "count long, n long").groupBy("count").agg(F.sum("n").alias("n"))
    row = counted.agg(F.sort_array(F.collect_list(F.struct("count", "n"))).alias("r")).select(F.transform("r", lambda s: s["n"]).alias("of_counts"))
    partial = dealt.crossJoin(F.broadcast(row)).mapInArrow(scores, "batch long, places binary, sums binary")
    rows = answered.mapInArrow(
        own_rows, "batch long, place long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double"
    )
    per_document = partial.groupBy("batch").cogroup(rows.groupBy("batch"))
    per_document = per_document.applyInArrow(summed, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    scored = land(per_document, "document-scores")
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(train_tokens).cast("long").alias("train_tokens"), "base_score", "score")
