"""Large arrays of records read in ranges, against Spark's own reader of whole files."""

from __future__ import annotations

import json
import random

import pytest

from ledgerloom.sources import large_json, readers
from ledgerloom.sources.large_json import CORRUPT
from tests.helpers import rows

SCHEMA = "id long, text string, tags array<string>, inner struct<a: long, b: array<struct<c: string>>>"


def schema(spark):
    return spark.createDataFrame([], SCHEMA).schema


def records(n, seed=1):
    draw = random.Random(seed)
    odd = ['plain', '}', '{', '}{', '"', '\\', '\\"', '"}', '\\\\"}', "[", "]", "größer } 漢字 🙂", "line\nend", ",", "" , "x" * 400]
    return [
        {
            "id": i, "text": "".join(draw.choice(odd) for _ in range(draw.randint(0, 4))), "tags": [draw.choice(odd) for _ in range(draw.randint(0, 3))],
            "inner": None if i % 7 == 0 else {"a": i, "b": [{"c": draw.choice(odd)} for _ in range(draw.randint(0, 3))]},
        }
        for i in range(n)
    ]


@pytest.mark.parametrize("range_bytes", ["97b", "1000b", "64kb", "128mb"])
@pytest.mark.parametrize("indent", [None, 2])
def test_ranges_of_any_size_give_the_rows_of_a_whole_read(spark, settings, tmp_path, range_bytes, indent):
    settings(**{"spark.sql.files.maxPartitionBytes": range_bytes, "spark.sql.files.openCostInBytes": "1b"})
    for name, n, seed in (("a.json", 60, 1), ("b.json", 1, 2), ("c.json", 0, 3), ("d.json", 25, 4)):
        (tmp_path / name).write_text(json.dumps(records(n, seed), indent=indent, ensure_ascii=seed % 2 == 0))
    got = large_json.read_large_json(spark, str(tmp_path), schema(spark))
    assert rows(got) == rows(readers.read_json_records(spark, str(tmp_path), schema(spark)))
    assert got.count() == 86


def test_one_file_is_read_by_many_tasks(spark, settings, tmp_path):
    settings(**{"spark.sql.files.maxPartitionBytes": "20kb", "spark.sql.files.openCostInBytes": "1b"})
    path = tmp_path / "large.json"
    path.write_text(json.dumps(records(3000), indent=2))
    fragments = large_json._fragments(spark, str(path))
    per_task = [n for _, n in rows(fragments.groupBy("block").count())]
    assert len(per_task) >= path.stat().st_size // 20_480 and max(per_task) < 3 * sum(per_task) / len(per_task)
    assert rows(large_json.read_large_json(spark, str(path), schema(spark))) == rows(readers.read_json_records(spark, str(path), schema(spark)))


def test_objects_one_after_another_need_no_array(spark, settings, tmp_path):
    settings(**{"spark.sql.files.maxPartitionBytes": "150b", "spark.sql.files.openCostInBytes": "1b"})
    own = records(40)
    (tmp_path / "a.json").write_text("\n".join(json.dumps(r, indent=1) for r in own))
    got = large_json.read_large_json(spark, str(tmp_path), schema(spark))
    lines = tmp_path / "lines"
    lines.mkdir()
    (lines / "a.json").write_text("\n".join(json.dumps(r) for r in own))
    assert rows(got) == rows(readers.read_json_records(spark, str(lines), schema(spark), multiline=False))


@pytest.mark.parametrize("range_bytes", ["23b", "128mb"])
def test_rejects_are_kept_and_can_fail_the_read(spark, settings, tmp_path, range_bytes):
    settings(**{"spark.sql.files.maxPartitionBytes": range_bytes, "spark.sql.files.openCostInBytes": "1b"})
    (tmp_path / "a.json").write_text('[{"id": 1, "text": "x"}, {"id": "no number"}, 17, {"id": 3, "tags": ["a", }, {"id": 4}]')
    (tmp_path / "cut.json").write_text('[{"id": 5}, {"id": 6, "text": "breaks o')
    (tmp_path / "cut2.json").write_text('[{"id": 7}, {"id": 8')
    got = large_json.read_large_json(spark, str(tmp_path), schema(spark), rejects=True)
    kept = [(r["id"], r[CORRUPT]) for r in got.collect()]
    assert sorted(i for i, bad in kept if bad is None) == [1, 5, 7]
    bad = {b for _, b in kept if b is not None}
    assert {'{"id": "no number"}', "17", '{"id": 6, "text": "breaks o', '{"id": 8'} <= bad
    with pytest.raises(Exception, match="(?i)malformed"):
        large_json.read_large_json(spark, str(tmp_path), schema(spark)).collect()


def test_empty_files_have_no_records(spark, tmp_path):
    for name, text in (("a.json", ""), ("b.json", "[]"), ("c.json", "  \n"), ("d.json", "[ ]\n")):
        (tmp_path / name).write_text(text)
    assert large_json.read_large_json(spark, str(tmp_path), schema(spark)).count() == 0


def test_records_that_end_with_their_range_are_cut_out_in_one_pass(spark, tmp_path, settings):
    settings(**{"spark.sql.files.maxPartitionBytes": "2000", "spark.sql.files.openCostInBytes": "1"})
    flat = [{"a": i, "b": 'a "quoted" \\ text'} for i in range(500)]
    (tmp_path / "flat.json").write_text(json.dumps(flat, indent=1))
    texts = large_json.json_record_texts(spark, str(tmp_path / "flat.json"))
    assert sorted(json.loads(r.value)["a"] for r in texts.collect()) == list(range(500))
    assert texts._jdf.queryExecution().analyzed().toString().count("MapInArrow") == 1
    for name, text in [("nested", json.dumps([{"a": {"x": i}, "b": "}{"} for i in range(500)])), ("broken", json.dumps(flat)[:-9])]:
        (tmp_path / f"{name}.json").write_text(text)
        texts = large_json.json_record_texts(spark, str(tmp_path / f"{name}.json"))
        assert texts.count() == 500
        assert texts._jdf.queryExecution().analyzed().toString().count("MapInArrow") == 2
