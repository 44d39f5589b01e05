"""Katz scores, quality resampling, toxicity."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from ledgerloom.llm import deobfuscated_toxicity as tox
from ledgerloom.llm import importance_resampling as resampling
from ledgerloom.llm import katz_backoff as katz
from ledgerloom.llm import queries
from tests.llm.conftest import ODD, SF_DIR

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
END, START = "\0end", "\0start"


def brute_katz(pairs):
    """Scores straight from the definition, word by word."""
    held = [i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in pairs]
    texts = [[*re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER)), END] for _, t in pairs]
    words, after = Counter(), defaultdict(Counter)
    for h, w in zip(held, texts):
        if not h:
            words.update(w)
            for a, b in zip([START, *w], w):
                after[a][b] += 1
    total, distinct = sum(words.values()), len(words)
    factors = katz.discounts(np.bincount([n for c in after.values() for n in c.values()] or [0], minlength=8)[:7].astype(float))
    code = lambda n: int(katz.count_code(np.array([n]))[0])
    unigrams = katz.unigram_model(Counter(code(n) for n in words.values()))
    unigram = lambda w: unigrams[code(words[w])]
    models = {}
    for a, c in after.items():
        kept = {w: n * factors[n] if n <= 5 else n for w, n in c.items()}
        free = sum(c.values()) - sum(kept.values())
        free = 0.5 if free < 1e-9 else free
        whole = sum(kept.values()) + free
        models[a] = {w: k / whole for w, k in kept.items()}, free / whole / (1 - sum(unigram(w) for w in kept))
    for seen, weight in list(models.values())[:25]:
        unseen = unigrams[0] + sum(unigram(w) for w in words if w not in seen)
        assert math.isclose(sum(seen.values()) + weight * unseen, 1, rel_tol=1e-9)
    out = []
    for (i, _), h, w in zip(pairs, held, texts):
        score = 0.0
        for a, b in zip([START, *w], w):
            seen, weight = models.get(a, ({}, 1.0))
            score += math.log10(seen[b] if b in seen else weight * unigram(b))
        base = sum(math.log10((words[x] + 0.5) / (total + 0.5 * (distinct + 1))) for x in w)
        out.append((str(i), h, len(w), sum(words[x] > 0 for x in w), total, round(base, 4), round(score, 4)))
    return sorted(out)


def scored(table, **options):
    rows = katz.katz_scores(table, **options).collect()
    return sorted((str(r[0]), *r[1:5], round(r[5], 4), round(r[6], 4)) for r in rows)


def test_katz_against_brute_force(given):
    pairs = [(r.doc_id, r.text) for r in given("documents").collect()]
    want = brute_katz(pairs)
    assert scored(given("documents")) == want
    assert scored(given("documents"), batch_tokens=5_000, bucket_tokens=3_000) == want
    held = [w for w in want if w[1]]
    assert sum(w[6] for w in held) > sum(w[5] for w in held)


def test_katz_with_odd_rows(odd, none):
    assert scored(odd) == brute_katz(ODD)
    assert katz.katz_scores(none).count() == 0


def test_katz_model_table_is_normalised(given):
    batches = katz.land(katz.token_batches(given("documents")), "b")
    answers = katz.land(katz.word_answers(katz.word_requests(batches, 3)), "w")
    cells = katz.pair_cells(katz._answered(batches, answers), 3)
    rows = katz.model_table(cells, katz.discounts(np.array([0, 50.0, 20, 10, 5, 3, 2])), katz.unigram_model({1: 50, 2: 10, 7: 1, 0: 3}))
    per_context = rows.groupBy("context").agg({"probability": "sum", "backoff": "max"}).collect()
    assert all(0 < r["sum(probability)"] < 1 and r["max(backoff)"] > 0 for r in per_context)


def brute_triples(pairs):
    """Scores by triples, backed off to pairs, backed off to words, straight from the definition."""
    held = [i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in pairs]
    texts = [[*re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER)), END] for _, t in pairs]
    words, after = Counter(), {2: defaultdict(Counter), 3: defaultdict(Counter)}
    for h, w in zip(held, texts):
        if not h:
            words.update(w)
            for a, b, c in zip([START, START, *w], [START, *w], w):
                after[2][b,][c] += 1
                after[3][a, b][c] += 1
    factors = {n: katz.discounts(np.bincount([k for c in own.values() for k in c.values()] or [0], minlength=8)[:7].astype(float)) for n, own in after.items()}
    code = lambda n: int(katz.count_code(np.array([n]))[0])
    unigrams = katz.unigram_model(Counter(code(n) for n in words.values()))
    models = {}

    def model(context):
        if context not in models:
            own = after[len(context) + 1][context]
            kept = {w: n * factors[len(context) + 1][n] if n <= 5 else n for w, n in own.items()}
            free = sum(own.values()) - sum(kept.values())
            free = 0.5 if free < 1e-9 else free
            whole = sum(kept.values()) + free
            rest = 1 - sum(p(w, context[1:]) for w in kept)
            models[context] = ({w: k / whole for w, k in kept.items()}, free / whole / rest) if own else ({}, 1.0)
        return models[context]

    def p(word, context):
        if not context:
            return unigrams[code(words[word])]
        seen, weight = model(context)
        return seen[word] if word in seen else weight * p(word, context[1:])

    scores = sorted(
        (str(i), round(sum(math.log10(p(c, (a, b))) for a, b, c in zip([START, START, *w], [START, *w], w)), 4)) for (i, _), w in zip(pairs, texts)
    )
    for context in [c for c in list(models) if len(c) == 2][:10]:
        assert math.isclose(p("a word that no text has", context) + sum(p(w, context) for w in words), 1, rel_tol=1e-9)
    return scores


def test_katz_triples_against_brute_force(given, odd, none, monkeypatch):
    of = lambda table, **options: sorted((str(r.doc_id), round(r.score, 4)) for r in katz.katz_scores(table, order=3, **options).collect())
    want = brute_triples([(r.doc_id, r.text) for r in given("documents").collect()])
    assert of(given("documents")) == want
    assert of(given("documents"), batch_tokens=5_000, bucket_tokens=3_000) == want
    monkeypatch.setattr(katz, "BROADCAST_BYTES", 0)
    assert of(given("documents"), batch_tokens=5_000, bucket_tokens=9_000) == want
    assert of(odd) == brute_triples(ODD)
    assert katz.katz_scores(none, order=3).count() == 0
    query = sorted((str(r.doc_id), round(r.score, 4)) for r in queries.op3_katz_backoff(given("documents").sparkSession, SF_DIR).collect())
    assert query == want


def test_katz_tables_by_order_back_off_and_sum_to_one(given, spark, tmp_path):
    batches = katz.land(katz.token_batches(given("documents").limit(100)), "b")
    answers = katz.land(katz.word_answers(katz.word_requests(batches, 3)), "w")
    factors = np.array([katz.discounts(np.array([0, 50.0, 20, 10, 5, 3, 2])), katz.discounts(np.array([0, 90.0, 20, 8, 4, 2, 1]))])
    unigrams = katz.unigram_model({1: 50, 2: 10, 7: 1, 0: 3})
    cells = katz.pair_cells(katz._answered(batches, answers), 3, order=3)
    katz.model_table(cells, factors, unigrams).write.partitionBy("order", "bucket").parquet(str(tmp_path / "model"))
    rows = spark.read.parquet(str(tmp_path / "model")).collect()
    pairs, triples = ({(r.bucket, r.before, r.context, r.word): r for r in rows if r.order == n} for n in (2, 3))
    assert sum(r["count"] for r in pairs.values()) == sum(r["count"] for r in triples.values()) > 0
    seen = defaultdict(list)
    for (bucket, before, context, word), r in triples.items():
        seen[bucket, before, context].append((r, pairs[bucket, 0, context, word].probability))
    for own in seen.values():
        assert math.isclose(sum(r.probability for r, _ in own) + own[0][0].backoff * (1 - sum(lower for _, lower in own)), 1, rel_tol=1e-9)


def test_katz_answers_beyond_a_few_megabytes_are_shuffled(spark, settings):
    settings(**{"spark.sql.autoBroadcastJoinThreshold": "-1"})
    batches = spark.createDataFrame([(b, [b], bytes(2)) for b in range(3)], "batch long, doc_ids array<long>, vocabulary binary")
    answer = lambda kilobytes: katz.land(
        spark.createDataFrame([(k, b, bytes(kilobytes << 10), bytes(9)) for k in (1, 0) for b in range(3)], "bucket int, batch long, counts binary, ranks binary"), "w"
    )
    small, large = katz._answered(batches, answer(1)), katz._answered(batches, answer(2000))
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in (small, large)]
    assert ["BroadcastExchange" in p for p in plans] == [True, False]
    for df, kilobytes in ((small, 1), (large, 2000)):
        rows = sorted((r.batch, r.doc_ids, [(a.bucket, len(a.counts), len(a.ranks)) for a in r.answers]) for r in df.collect())
        assert rows == [(b, [b], [(0, kilobytes << 10, 9), (1, kilobytes << 10, 9)]) for b in range(3)]


def test_katz_cells_hold_the_code_of_a_follower_once(documents):
    batches = katz.land(katz.token_batches(documents((2, "a b c b c a c b c"), (4, "x b c y b c"))), "b")
    answers = katz.land(katz.word_answers(katz.word_requests(batches, 1)), "w")
    cells = [r.asDict() for r in katz.pair_cells(katz._answered(batches, answers), 1, order=3).collect()]
    for cell in cells:
        words = katz._unpack_runs(cell["words"], katz._unpack(cell["followers"], np.uint32).astype(np.int64))
        assert len(katz._unpack(cell["codes"], np.uint16)) == len(set(words.tolist())) < len(words)
    bucket = katz.Bucket(cells)
    code = dict(zip(bucket.word.tolist(), bucket.code.tolist()))
    # c six times, b five, a and the end two, x and y once
    assert len(code) == 6 and sorted(code.values()) == [1, 1, 2, 2, 5, 6]


def test_discounts_and_codes():
    factors = katz.discounts(np.array([0, 1000, 300, 140, 80, 50, 35.0]))
    assert factors[0] == 1 and ((factors[1:] > 0) & (factors[1:] < 1)).all()
    assert katz.discounts(np.zeros(7))[1:].tolist() == [(r - 0.5) / r for r in range(1, 6)]
    counts = np.array([0, 1, 4095, 4096, 10**6, 10**13])
    assert np.allclose(katz.code_count(katz.count_code(counts)), counts, rtol=1e-3)
    values = np.sort(np.random.default_rng(1).integers(0, 1 << 63, 500, dtype=np.uint64))
    assert (katz._unpack_sorted(katz._pack_sorted(values)) == values).all()


def good_and_bad(documents, spark):
    words = "the of and to in is that for with as on by at from this which be are was has".split()
    draw = np.random.default_rng(4)
    pairs, labels = [], []
    for i in range(400):
        text = [str(w) for w in draw.choice(words, 40)]
        bad = i % 4 == 0
        kinds = [" ".join(w.upper() + "!!" for w in text), " | ".join(text), " ".join(w + "&&&" for w in text), " ".join([text[0]] * 40)]
        pairs.append((i, kinds[i // 4 % 4] if bad else " ".join(text) + "."))
        if i < 200:
            labels.append((i, 0 if bad else 1, 0))
    return documents(*pairs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_resampling_keeps_the_good(documents, spark):
    table, labels = good_and_bad(documents, spark)
    kept = {r.doc_id for r in resampling.resample(table, labels).collect()}
    assert kept == {i for i in range(400) if i % 4}
    again = {r.doc_id for r in resampling.sampled_documents(table, labels).collect()}
    assert again == kept
    part = resampling.resample(table, labels, keep=0.25, temperature=1e6).collect()
    assert len(part) == 100


def test_resampling_of_odd_rows(odd, none, spark):
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert resampling.sampled_documents(odd, empty).columns == odd.columns
    assert resampling.sampled_documents(odd, empty).count() == len(ODD)
    weights = {r.doc_id: r.log_weight for r in resampling.resample(odd, empty).collect()}
    assert weights[2] == weights[3] == 0.0
    assert resampling.resample(none, empty).count() == 0
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    assert resampling.resample(odd, labels).count() <= len(ODD)


def test_kth_largest(spark):
    values = [float(v) for v in np.random.default_rng(2).normal(size=3000).round(2)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for k in (1, 7, 1500, 3000):
        assert resampling.kth_largest(df, "v", k) == sorted(values, reverse=True)[k - 1]
    assert resampling.kth_largest(df, "v", 0) == math.inf


def test_features_do_not_cross_texts():
    texts = [b"The cat sat on THE mat.", b"mat mat mat", b"", b"12 | 34"]
    whole = b"".join(texts)
    offsets = np.cumsum([0, *map(len, texts)])
    grams, text = resampling.features(np.frombuffer(whole, np.uint8), offsets)
    for i, t in enumerate(texts):
        alone, _ = resampling.features(np.frombuffer(t, np.uint8), np.array([0, len(t)]))
        assert sorted(grams[text == i].tolist()) == sorted(alone.tolist())


def toxic_documents(documents, spark, n=600):
    draw = np.random.default_rng(5)
    plain = ["".join(draw.choice(list("aeiorstln"), 5)) for _ in range(300)]
    pairs, labels = [], []
    for i in range(n):
        words = [str(w) for w in draw.choice(plain, 50)]
        toxic = i % 5 == 0
        if toxic:
            for k in (10, 30):
                words[k] = str(draw.choice(["blockhead", "nitwit", "dunce"]))
        pairs.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return pairs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), plain


def test_toxicity_on_held_out_and_obfuscated_texts(documents, spark):
    pairs, labels, plain = toxic_documents(documents, spark)
    hidden = ["bl0ckh3ad", "n1tw1t", "d u n c e", "duuuunce", "n.i.t.w.i.t", "n!tw!t"]
    extra = [(1000 + i, " ".join([*plain[:20], word, *plain[20:30], hidden[i - 1], *plain[30:50]])) for i, word in enumerate(hidden)]
    rows = {r.doc_id: r for r in tox.toxicity(documents(*pairs, *extra), labels).collect()}
    held = [r for i, r in rows.items() if i < 1000 and r.held_out]
    assert len(held) > 100 and all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in rows.items())
    assert all(r.predicted == int(r.doc_id % 5 == 0) for r in held)
    assert all(rows[i].predicted == 1 for i, _ in extra)
    assert all(0 <= r.score <= 1 for r in rows.values())


def test_toxicity_of_odd_rows(odd, none, spark):
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = tox.toxicity(odd, empty).collect()
    assert len(rows) == len(ODD) and len({r.score for r in rows}) == 1 and not any(r.held_out for r in rows if r.doc_id is None)
    assert tox.toxicity(none, empty).count() == 0
    labels = spark.createDataFrame([(1, 0, 1), (4, 1, 0), (4, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    assert tox.toxicity(odd, labels).count() == len(ODD)


@pytest.fixture(scope="module")
def english():
    text = b"the stupid clown told a worthless moron and an idiot that this is pathetic and disgusting trash. " * 40
    return tox.trigram_costs(tox.trigram_counts(np.frombuffer(text, np.uint8)))


@pytest.mark.parametrize(
    "written, read",
    [("1d10t", "idiot"), ("m0r0n", "moron"), ("tr@sh", "trash"), ("i d i o t", "idiot"), ("stuuupid", "stupid"), ("c-l-o-w-n", "clown"), ("plain", "plain")],
)
def test_decoder(english, written, read):
    assert tox.restored_text(f"and the {written} is", english) == f"and the {read} is"
