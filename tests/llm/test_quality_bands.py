"""Compression bands against plain Python, text by text."""

from __future__ import annotations

import random
import re
import string

import zstandard

from ledgerloom.llm import compression_bands, queries
from tests.llm.conftest import LONG, ODD
from tests.helpers import rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measured(text: str) -> tuple:
    own = WORD.findall(text)
    repeated = set()
    windows: dict[tuple, list[int]] = {}
    for i in range(len(own) - 7):
        windows.setdefault(tuple(own[i : i + 8]), []).append(i)
    for starts in windows.values():
        if len(starts) > 1:
            repeated |= {i + k for i in starts for k in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    failed = len(own) < 20 or 100 * len(repeated) > 30 * len(own)
    return len(own), sum(map(len, own)), symbols, len(lines) - len(set(lines)), len(repeated), failed


def in_band(text: str) -> bool:
    def ratio(data: bytes) -> float:
        return len(zstandard.ZstdCompressor(level=3).compress(data)) / len(data) if data else 0.0

    def fits(data: bytes) -> bool:
        low, high = next((low, high) for below, low, high in compression_bands.BANDS if len(data) < below)
        return low <= ratio(data) <= high

    data = text.encode()
    chunks = [data[i : i + 4096] for i in range(0, len(data) // 4096 * 4096, 4096)]
    return fits(data) and 2 * sum(not fits(c) for c in chunks) <= len(chunks)


def expected(pairs) -> list[tuple]:
    out = []
    for doc_id, text in pairs:
        *counts, failed = measured(text or "")
        out.append((doc_id, *counts, failed, not failed and in_band(text or "")))
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]


def prose(seed: int, n: int) -> str:
    draw = random.Random(seed)
    stock = ["".join(draw.choice("etaoinshrdlu") for _ in range(draw.randint(2, 9))) for _ in range(3000)]
    return " ".join(draw.choice(stock) for _ in range(n))


def noise(seed: int, n: int) -> str:
    draw = random.Random(seed)
    return " ".join("".join(draw.choice(string.ascii_letters + string.digits + "+/=éüß漢") for _ in range(40)) for _ in range(n))


def test_measures_and_verdicts_are_those_of_plain_python(documents, odd, given):
    repeated = " ".join(prose(5, 8).split() * 2 + prose(6, 70).split())
    pairs = [
        (10, prose(1, 2000)), (11, noise(2, 400)), (12, "buy now " * 900), (13, prose(3, 900) + noise(4, 600)), (14, repeated), (15, "a\n\na\n \n b\n b \na | <b> & #"),
        (16, "one two three four five six seven eight " * 2 + "nine"), (17, "w " * 19), (18, prose(7, 20)), (19, "x" * 300), (20, "two\vlines\fof\rfour words"),
    ]
    got = rows(compression_bands.measured_documents(documents(*pairs)).select(COLUMNS))
    assert got == expected(pairs)
    kept = {r[0] for r in got if r[-1]}
    assert {10, 14} <= kept and not kept & {11, 12, 13, 15, 16, 17, 19}
    assert rows(compression_bands.measured_documents(odd).select(COLUMNS)) == expected(ODD)
    real = [(r["doc_id"], r["text"]) for r in given("documents").collect()]
    assert rows(compression_bands.measured_documents(given("documents")).select(COLUMNS)) == expected(real)


def test_windows_do_not_cross_texts_nor_count_twice(documents):
    eight = "a b c d e f g h"
    more = [(i, eight + " " + prose(i, 30)) for i in range(30, 34)]
    got = rows(compression_bands.measured_documents(documents(*more, (40, f"{eight} {eight} {eight}"))).select("doc_id", "n_repeat_words"))
    assert got == [(30, 0), (31, 0), (32, 0), (33, 0), (40, 24)]


def test_rows_pass_whole_and_empty_tables_are_empty(spark, documents, none):
    clashing = documents((1, prose(1, 500)), (2, None)).withColumnsRenamed({"n": "n_words", "bits": "ratio", "kept": "kept", "row": "m", "n_chars": "in_band"})
    kept = compression_bands.within_bands(clashing)
    assert kept.columns == clashing.columns and rows(kept) == rows(clashing.filter("doc_id = 1"))
    assert compression_bands.measured_documents(none).count() == 0 and compression_bands.within_bands(none).columns == none.columns
    assert compression_bands.within_bands(documents((1, LONG))).count() == 0


def test_query(spark, given):
    from tests.llm.conftest import SF_DIR

    got = queries.op13_compression_bands(spark, SF_DIR)
    assert got.columns[:8] == COLUMNS
    labels = {r["doc_id"]: r["quality"] for r in given("labels").collect()}
    for r in got.collect():
        if labels.get(r["doc_id"]) == 1 and not r["base_failed"]:
            assert r["kept"]
