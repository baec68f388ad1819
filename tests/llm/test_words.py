from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from namewright.llm import words as module
from namewright.llm.words import grams, words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aBé .7\n", max_size=30)), max_size=8)


def plain(text):
    lowered = "".join(c.lower() if c.isascii() else c for c in text or "")
    return WORD.findall(lowered)


@settings(max_examples=60, deadline=None)
@given(TEXTS, st.integers(4, 40))
def test_words_of_rows(texts, chunk):
    module.CHUNK_BYTES, before = chunk, module.CHUNK_BYTES
    try:
        parts = list(words(pa.array(texts, pa.string())))
    finally:
        module.CHUNK_BYTES = before
    rows, by_hash = [], {}
    for part in parts:
        for row, (low, high) in enumerate(zip(part.begins, part.begins[1:], strict=False)):
            raw = (texts[part.first + row] or "").encode()
            found = [raw[a:b].lower().decode() for a, b in zip(part.starts[low:high], part.ends[low:high], strict=True)]
            rows.append(found)
            for word, code in zip(found, part.hashes[low:high], strict=True):
                assert by_hash.setdefault(word, code) == code
    assert rows == [plain(t) for t in texts]
    assert len(set(by_hash.values())) == len(by_hash)


def test_sliced_column_and_grams():
    column = pa.array(["zero", "a b c d", "b c", None, "a b c"], pa.string()).slice(1)
    (part,) = words(column)
    rolled, whole = grams(part, 3)
    assert part.counts.tolist() == [4, 2, 0, 3]
    assert whole.tolist() == [True, True, False, False, False, False, True, False, False]
    assert rolled[0] == rolled[6] and rolled[0] != rolled[1]
    assert np.array_equal(grams(part, 1)[0][[0, 1]], grams(part, 1)[0][[6, 7]])
