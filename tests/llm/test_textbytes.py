"""Byte buffers of texts."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa

from ledgerloom.llm import textbytes

TEXTS = ["one two", None, "", "a much longer text than the size of a slice " * 3, " \t", "größer", "x", "tail\n\x0bend "]


def test_slices_hold_every_text_once():
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(TEXTS))), pa.array(TEXTS)], ["doc_id", "text"])
    for size in (1, 10, 60, 1 << 20):
        found = []
        for part, data, offsets in textbytes.slices(iter([batch.slice(0, 3), batch.slice(3)]), size=size):
            whole = data.tobytes()
            found += zip(part.column(0).to_pylist(), [whole[a:b].decode() for a, b in zip(offsets[:-1], offsets[1:])])
            assert len(whole) <= size + 200
        assert found == [(i, t or "") for i, t in enumerate(TEXTS)]


def test_words_and_hashes_agree_with_a_split():
    texts = [(t or "").encode() for t in TEXTS]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    starts, ends = textbytes.words(data, offsets)
    found = [data[a:b].tobytes() for a, b in zip(starts, ends)]
    assert found == [w for t in texts for w in re.findall(rb"[^\x20\x09-\x0D]+", t)]
    hashes = textbytes.span_hashes(textbytes.prefix_hashes(data), starts, ends)
    assert len(set(zip(found, hashes.tolist()))) == len(set(found)) == len(set(hashes.tolist()))
