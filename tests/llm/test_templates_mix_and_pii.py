"""Decontamination, pseudonyms, mixing, and the pipeline."""

from __future__ import annotations

import datetime
import hashlib
import math
import re
from collections import defaultdict

import pytest

import corpus_pipeline
from checks import compare
from ledgerloom.llm import feistel_pseudonyms as pii
from ledgerloom.llm import queries, source_schedule
from ledgerloom.llm import template_windows as templates
from tests.llm.conftest import ODD, SF_DIR

ITEM = "A train leaves Paris at 7 hours and travels 120 km to reach Lyon at 9 hours in the end."


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_against_sql(spark, given, name):
    got = compare.spark_rows(queries.QUERIES[name](spark, SF_DIR))
    assert compare.difference(got, compare.duck_rows(compare.connect(SF_DIR), queries.SQL[name])) is None


@pytest.fixture
def benchmark(spark):
    rows = [(10, ITEM), (11, "too short"), (12, None), (13, ""), (None, "another item without any number that nobody has copied"), (10, ITEM)]
    return spark.createDataFrame(rows, "item_id long, text string")


def test_reworded_questions_are_found(documents, benchmark):
    table = documents(
        (1, f"Intro words here. {ITEM} More follows."),
        (2, "We ask. A train leaves Berlin at 3 hours and travels 55 km to reach Lyon at 8 hours in the end."),
        (3, "A train leaves Berlin at 3 hours and travels"),
        (4, ITEM.upper()),
        (5, "Quite another text about trains that leave at 7 hours."),
    )
    found = {(r.doc_id, r.item_id): r for r in templates.leaked_items(table, benchmark).collect()}
    assert {k for k in found if k[0] < 4} == {(1, 10), (2, 10)}
    assert found[1, 10].n_reworded == 0 and found[2, 10].n_reworded > 10
    assert {r.doc_id for r in templates.without_leaks(table, benchmark).collect()} >= {3, 5}


REWORDED = "A train leaves Berlin at 3 hours and travels 55 km to reach Ulm at 8 hours in the end."


def test_copies_in_another_case_are_found(documents, benchmark, spark):
    table = documents((4, ITEM.upper()), (5, ITEM.lower()), (6, f"so {ITEM.lower()} and on"), (7, "Quite another text."))
    assert {(r.doc_id, r.item_id, r.n_reworded) for r in templates.leaked_items(table, benchmark).collect()} == {(i, 10, 0) for i in (4, 5, 6)}
    assert {r.doc_id for r in templates.without_leaks(table, benchmark).collect()} == {7}
    item = spark.createDataFrame([(1, "Alice has 3 apples and gives Bob 2 of them.")], "item_id long, text string")
    named = documents((1, "Carol has 8 apples and gives Dan 5 of them."), (2, "Why? Alice has 8 apples and gives Dan 5 of them."))
    assert {r.doc_id for r in templates.leaked_items(named, item).collect()} == {1, 2}


def test_each_occurrence_has_its_own_substitution(documents, benchmark):
    third = REWORDED.replace("Berlin", "Rome").replace("3 hours", "4 hours").replace("55", "70").replace("Ulm", "Bari")
    table = documents((1, f"{ITEM} {REWORDED}"), (2, f"{REWORDED} {third}"), (3, f"{REWORDED} {ITEM} {third}"), (4, f"{REWORDED[:40]} {third[50:]}"))
    found = {r.doc_id: r for r in templates.leaked_items(table, benchmark).collect()}
    assert set(found) == {1, 2, 3} and found[1].n_matched == found[2].n_matched == found[3].n_matched == found[1].n_windows
    assert found[1].n_reworded == 0 < found[2].n_reworded


def test_items_of_numbers_and_short_items_are_found(documents, spark):
    items = ["Compute 12 + 7 - 3 * 4.", "Evaluate 48/6 + 2.5 - 1.75", "Given 3, 5, 8, 13, 21, 34 find next.", "What is zyx?", "Solve 2x"]
    table = documents(
        *[(i, f"Some words before. {t} And some after.") for i, t in enumerate(items)],
        (10, "Compute 12 + 8 - 3 * 4."), (11, "from 1, 2 find next"), (12, "What is zy"), (13, items[3].lower()), (14, "Given 2, 4, 6, 10, 16, 26 find next."),
    )
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in templates.leaked_items(table, benchmark).collect()}
    assert found == {(i, i) for i in range(5)} | {(13, 3), (14, 2)}


def test_inconsistent_slots_do_not_count(documents, spark):
    item = spark.createDataFrame([(1, " ".join(f"step {'alpha beta gamma delta epsilon zeta'.split()[i]} adds 5 more of them" for i in range(6)))], "item_id long, text string")
    same = " ".join(f"step {'alpha beta gamma delta epsilon zeta'.split()[i]} adds 8 more of them" for i in range(6))
    mixed = " ".join(f"step {'alpha beta gamma delta epsilon zeta'.split()[i]} adds {i} more of them" for i in range(6))
    found = {r.doc_id for r in templates.leaked_items(documents((1, same), (2, mixed)), item).collect()}
    assert found == {1}


def test_leaks_of_odd_rows(odd, none, benchmark):
    assert templates.leaked_items(odd, benchmark).count() == 0
    assert templates.leaked_items(none, benchmark).count() == 0
    assert templates.leaked_items(odd, benchmark.limit(0)).count() == 0
    left = templates.without_leaks(odd, benchmark)
    assert left.columns == odd.columns and left.count() == len(ODD)


def test_leaks_against_brute_force(given):
    words = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    items = {r.item_id: words(r.text) for r in given("benchmark").collect()}
    windows = lambda w: [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    want = set()
    for r in given("documents").collect():
        own = set(windows(words(r.text)))
        for i, item in items.items():
            asked = windows(item)
            if asked and sum(x in own for x in asked) >= math.ceil(0.8 * len(asked)):
                want.add((r.doc_id, i))
    got = {(r.doc_id, r.item_id) for r in templates.leaked_items(given("documents"), given("benchmark")).collect()}
    # templates may match more than plain words, never less
    assert want and want <= got and len(got) <= len(want) + 2


def test_document_windows_are_hashed_once_where_readings_agree(documents, spark):
    table = documents((1, "one two three four five six"), (2, "we met Ann at 5 here now"), (3, None), (4, "two words"))
    count = lambda lengths: {(r.doc_id, r.doc_pos): r["count"] for r in templates._document_windows(table, 5, lengths).groupBy("doc_id", "doc_pos").count().collect()}
    assert count([]) == {(1, 0): 1, (1, 1): 1, **{(2, i): 2 for i in range(3)}}
    item = spark.createDataFrame([(1, "one two three four five"), (2, "two words")], "item_id long, text string")
    asked = templates.benchmark_windows(item).select("item_id", "hash")
    shared = templates._document_windows(table, 5, [2]).join(asked, "hash")
    assert {(r.doc_id, r.doc_pos, r.item_id) for r in shared.collect()} == {(1, 0, 1), (4, 0, 2)}
    plan = templates._document_windows(table, 5, [])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("transform(") == len(templates.READINGS)


def test_permutation_is_one():
    for size in (1, 2, 10, 1000, 73_049):
        p = pii.Permutation(b"key", "kind", size)
        image = [p.forth(v) for v in range(size)]
        assert sorted(image) == list(range(size)) and [p.back(v) for v in image] == list(range(size))
    one, other = pii.Permutation(b"key", "a", 1000), pii.Permutation(b"other", "a", 1000)
    assert [one.forth(v) for v in range(20)] != [other.forth(v) for v in range(20)]


@pytest.mark.parametrize("form", ["{d:02d}/{m:02d}/{y}", "{d}/{m}/{y}", "{m:02d}-{d:02d}-{y}", "{m}-{d}-{y}", "{y}-{m:02d}-{d:02d}", "{y}.{m}.{d}"])
def test_dates_of_eight_years_are_one_to_one_and_undone(form):
    forth, back = pii.Pseudonyms(b"key"), pii.Pseudonyms(b"key", back=True)
    days = [datetime.date(2010, 1, 1) + datetime.timedelta(i) for i in range(8 * 365 + 2)]
    texts = [form.format(d=day.day, m=day.month, y=day.year) for day in days]
    images = [forth.replaced("date", t)[1] for t in texts]
    assert len(set(images)) == len(set(texts)) and [len(i) for i in images] == [len(t) for t in texts]
    assert [back.replaced("date", i)[1] for i in images] == texts
    assert sum(a != b for a, b in zip(images, texts)) > len(texts) * 0.99


TEXT = (
    "card 4111 1111 1111 1111 or 4111111111111111, iban DE89 3704 0044 0532 0130 00, ssn 123-45-6789, born 2018-04-21 "
    "or 21/04/2018, mail Ann.Lee7@x.example.com, ip 10.0.0.1. phone +44 20 7946 0958, (212) 555-1234; "
    'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"'
)


def test_formats_are_kept_and_values_linked():
    names = pii.Pseudonyms(b"key")
    text, counts = pii.pseudonymised(TEXT, names)
    assert counts == {"secret": 1, "email": 1, "iban": 1, "ip": 1, "date": 2, "ssn": 1, "phone": 2, "card": 2}
    assert re.sub(r"[0-9a-z]", "x", text.lower())[:40] == re.sub(r"[0-9a-z]", "x", TEXT.lower())[:40]
    first, second = re.findall(r"4\d{3} ?\d{4} ?\d{4} ?\d{4}", text)
    assert first.replace(" ", "") == second != "4111111111111111"
    assert pii.luhn_digit(second[:-1]) == second[-1]
    assert pii.iban_remainder(re.search(r"DE[0-9 ]+", text).group().replace(" ", "")) == 1
    year, day = re.search(r"(\d{4}-\d\d-\d\d)", text).group(), re.search(r"(\d\d/\d\d/\d{4})", text).group()
    assert year.split("-") == day.split("/")[::-1]
    assert pii.pseudonymised(text, pii.Pseudonyms(b"key", back=True))[0] == TEXT
    assert pii.pseudonymised(TEXT, pii.Pseudonyms(b"other"))[0] != text


@pytest.mark.parametrize(
    "value, before, after, kind",
    [
        ("GB29 NWBK 6016 1331 9268 19", "iban ", " at once", "iban"), ("NL91 ABNA 0417 1643 00", "to ", " USD 5", "iban"), ("GB29NWBK60161331926819", "", ".", "iban"),
        ("4111 1111 1111 1111", "card ", " 123", "card"), ("4111111111111111", "", " 12/27", "card"), ("4111-1111-1111-1111", "no 12 ", "", "card"),
    ],
)
def test_values_within_longer_runs_are_found(value, before, after, kind):
    text, counts = pii.pseudonymised(before + value + after, pii.Pseudonyms(b"key"))
    assert counts[kind] == 1 == sum(counts.values()) and value not in text
    assert text.startswith(before) and text.endswith(after) and len(text) == len(before + value + after)
    alone = pii.pseudonymised(value, pii.Pseudonyms(b"key"))[0]
    assert text == before + alone + after


@pytest.mark.parametrize("text", ["4111111111111112", "999.1.1.1", "2018-02-30", "000-12-3456", "DE00 3704 0044 0532 0130 00", "no numbers", "3.", ""])
def test_what_fails_its_check_stays(text):
    assert pii.pseudonymised(text, pii.Pseudonyms(b"key"))[0] == text


def test_pseudonyms_of_odd_rows(odd, none, documents):
    rows = pii.with_pseudonyms(odd).collect()
    assert sorted((r.text for r in rows)) == sorted(t or "" for _, t in ODD) and not any(r.n_found for r in rows)
    assert pii.with_pseudonyms(none).count() == 0
    table = documents((1, "see 10.0.0.1"), (2, "10.0.0.1 again"))
    ips = {re.search(r"[0-9.]{7,}", r.text).group() for r in pii.with_pseudonyms(table).collect()}
    assert len(ips) == 1 and ips != {"10.0.0.1"}


def test_schedule_is_even_and_exact(documents, spark):
    pairs = [documents(*[(1000 * s + i, "word " * (5 + i % 90)) for i in range(n)], source=name) for s, (name, n) in enumerate([("a", 300), ("b", 60), ("c", 5), (None, 40)])]
    table = pairs[0]
    for more in pairs[1:]:
        table = table.unionByName(more)
    sized = source_schedule.sized_documents(table)
    demand = source_schedule.block_demand(source_schedule.source_targets(sized), 64)
    targets = {r.source: r for r in demand.collect()}
    assert sum(r.target for r in targets.values()) == pytest.approx(sum(r.source_size for r in targets.values()))
    assert all(r.target <= 3 * r.source_size for r in targets.values())
    assert [targets[s].weight for s in ("a", "b", "c", None)] == [1, 2, 3, 1]
    slots = sorted(source_schedule.schedule(demand, 64).collect(), key=lambda r: r.slot)
    taken = defaultdict(int)
    for r in slots:
        taken[r.source] += r.end_word - r.first_word
    assert dict(taken) == {s: math.floor(r.target) for s, r in targets.items()}
    assert len({r.slot for r in slots}) == len(slots)
    half = [r.source for r in slots[: len(slots) // 2]]
    for s, r in targets.items():
        assert abs(half.count(s) - r.slots / 2) <= 6


def test_mix_of_odd_rows(odd, none, documents):
    rows = source_schedule.mixed_documents(odd).collect()
    assert len(rows) == len(ODD) and all(r.taken <= 3 * r.size for r in rows) and sum(r.taken for r in rows) == sum(r.size for r in rows)
    assert source_schedule.mixed_documents(none).count() == 0
    assert [r.taken for r in source_schedule.mixed_documents(documents((1, None), (2, " "))).collect()] == [0, 0]


def test_pipeline_stages(spark, given):
    docs, names = given("documents"), [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "exact_duplicates", "near_duplicates", "benchmark_leaks", "source_mix"]
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_DIR)
        path = corpus_pipeline.new_path(spark, name)
        out.write.parquet(path)
        out = spark.read.parquet(path)
        if name == "source_mix":
            assert out.count() == docs.count() and set(out.columns) >= {"doc_id", "size", "target", "taken"}
        else:
            assert out.columns == docs.columns and 0.5 * before < out.count() <= docs.count()
        if name == "exact_duplicates":
            texts = [hashlib.sha256((r.text or "").encode()).digest() for r in out.collect()]
            assert len(texts) == len(set(texts)) == docs.select("text").distinct().count()
        docs = out
