"""Repeated lines and repeated byte strings."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np

from ledgerloom.llm import line_bitmaps
from ledgerloom.llm import run_length_index as rli
from tests.llm.conftest import ODD

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_lines(pairs, least):
    key = lambda line: re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", line.translate(LOWER))
    seen = defaultdict(set)
    for i, t in pairs:
        for line in (t or "").split("\n"):
            seen[key(line)].add((i, t))
    common = {k for k, d in seen.items() if k and len(d) >= least}
    out = []
    for i, t in pairs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if key(x) not in common]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def test_lines(documents, none):
    draw = random.Random(3)
    stock = ["Same Line", " same line\t", "SAME LINE\x0b", "", "  ", "Ärger", "ärger", "x"]
    pairs = [(i, "\n".join(draw.choice([*stock, f"own {i} {k}"]) for k in range(draw.randint(1, 90)))) for i in range(40)]
    pairs += [(40, None), (41, ""), (None, "same line\nalone"), (0, pairs[0][1]), (42, "\n" * 200)]
    for least in (3, 10):
        got = [tuple(r) for r in line_bitmaps.without_common_lines(documents(*pairs), least).collect()]
        assert sorted(got, key=repr) == brute_lines(pairs, least)
    assert line_bitmaps.without_common_lines(none).count() == 0


def test_bitmaps_hold_words_of_64_lines(documents):
    text = "\n".join("gone" if i in (0, 63, 64, 199) else f"line {i}" for i in range(200))
    table = documents((1, text), (2, "gone"))
    found = {r.doc_id: r for r in line_bitmaps.keep_bitmaps(table, 2).collect()}
    bits = {w.word: w.bits & (1 << 64) - 1 for w in found[1].dropped}
    assert bits == {0: 1 | 1 << 63, 1: 1, 3: 1 << 7} and found[1].n_dropped == 4


def brute_strings(texts, length):
    places = defaultdict(set)
    for d, t in enumerate(texts):
        for i in range(len(t) - length + 1):
            places[t[i : i + length]].add((d, i))
    covered = [bytearray(len(t)) for t in texts]
    for found in places.values():
        if len(found) > 1:
            for d, i in found:
                covered[d][i : i + length] = b"\1" * length
    return covered


def rows_of(found):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found.collect()), key=repr)


def expected(pairs, length):
    texts = [(t or "").encode() for _, t in pairs]
    out = []
    for (i, _), text, marks in zip(pairs, texts, brute_strings(texts, length)):
        spans = len(re.findall(rb"\x01+", bytes(marks)))
        out.append((i, len(text), sum(marks), spans, bytes(b for b, m in zip(text, marks) if not m)))
    return sorted(out, key=repr)


def some_texts():
    draw = random.Random(9)
    word = lambda: "".join(draw.choice("abcdé") for _ in range(draw.randint(2, 7)))
    passages = [" ".join(word() for _ in range(n)) for n in (20, 45, 60, 90)]
    texts = []
    for i in range(50):
        parts = [" ".join(word() for _ in range(draw.randint(5, 60)))]
        for _ in range(draw.randint(0, 3)):
            p = draw.choice(passages)
            parts += [p[draw.randint(0, 30) :], " ".join(word() for _ in range(9))]
        texts.append((i, " ".join(parts)))
    return [*texts, (50, texts[3][1]), (51, "ab" * 400), (52, "shti " * 300), (53, None), (54, ""), (None, texts[5][1]), (3, texts[3][1])]


def test_repeated_strings(documents, none):
    pairs = some_texts()
    want = expected(pairs, 200)
    assert sum(w[2] for w in want) > 3000
    assert rows_of(rli.without_repeats(documents(*pairs))) == want
    for sizes in ({"part_contexts": 2}, {"part_contexts": 1, "most_parts": 1}):
        assert rows_of(rli.without_repeats(documents(*pairs), **sizes)) == want
    assert rli.without_repeats(none).count() == 0


def test_repeated_strings_with_odd_rows(odd):
    assert rows_of(rli.without_repeats(odd)) == expected(ODD, 200)


def test_index_finds_all_long_matches():
    draw = random.Random(4)
    for _ in range(40):
        texts = [bytes(draw.choice(b"ab") for _ in range(draw.randint(0, 40))) for _ in range(draw.randint(1, 6))]
        index = rli.RunLengthIndex(texts)
        assert index.run_lengths.sum() == sum(len(t) + 1 for t in texts)
        found = {(i, a + k) for i, runs in enumerate(index.long_matches(5)) for a, n in runs for k in range(n)}
        places = defaultdict(list)
        for d, t in enumerate(texts):
            for i in range(len(t) - 4):
                places[t[i : i + 5]].append((d, i))
        assert found == {p for v in places.values() if len(v) > 1 for p in v}


def test_anchors_depend_on_the_string_alone():
    draw = random.Random(6)
    texts = [bytes(draw.choice(b"abc") for _ in range(draw.randint(0, 200))) for _ in range(20)] + [b"ab" * 90]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    chosen, places = defaultdict(set), Counter()
    for text, start, starts, anchor, _ in zip(*rli.anchor_runs(data, offsets, 12, 4)):
        for i in range(start, start + starts):
            chosen[texts[text][i : i + 12]].add(int(anchor))
            places[text, i] += 1
    assert all(len(a) == 1 for a in chosen.values())
    assert len(places) == sum(max(0, len(t) - 11) for t in texts) and set(places.values()) == {1}
