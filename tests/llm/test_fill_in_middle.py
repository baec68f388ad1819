from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from namewright.llm import fill_in_middle as fim
from namewright.llm.queries import op11_fill_in_middle
from tests.llm.tables import awkward, documents, empty, prose

UNITS = re.compile("[A-Za-z]+|[^A-Za-z]")
TEXT = st.text(alphabet=st.one_of(st.sampled_from("aZz@[`{09 \n\t<P>é東\U0001f600"), st.characters(exclude_categories=["Cs"])), max_size=40)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain(doc, text):
    text = text or ""
    units = UNITS.findall(text)
    n, digest = len(units), sha(f"1:{'' if doc is None else doc}")
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc, n, "plain", None, None, text
    if h4 % 100 < 20:
        return doc, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def order(row):
    return [(v is None, str(v)) for v in row]


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXT, max_size=12))
def test_marks_against_plain_units(texts):
    data = np.frombuffer("".join(texts).encode(), dtype=np.uint8)
    offsets = np.cumsum([0, *(len(t.encode()) for t in texts)])
    tails = offsets[1:][np.diff(offsets) > 0] - 1
    units, points = fim.mark(data, tails)
    expected = []
    for text, start in zip(texts, offsets, strict=False):
        expected += (start + np.cumsum([len(u.encode()) for u in UNITS.findall(text)]) - 1).astype(int).tolist()
    assert units.select(np.arange(1, len(expected) + 1)).tolist() == expected
    assert units.rank(offsets).tolist() == [sum(e < o for e in expected) for o in offsets]
    assert np.diff(points.rank(offsets)).tolist() == [len(t) for t in texts]


@pytest.mark.parametrize(("chunk", "block"), [(fim.CHUNK_BYTES, fim.BLOCK_WORDS), (30, 1), (1, 3)])
def test_cuts_do_not_depend_on_chunks(monkeypatch, chunk, block):
    monkeypatch.setattr(fim, "BLOCK_WORDS", block)
    texts = [prose(i, i % 9) + "é東, x" * (i % 4) for i in range(80)] + ["", "<S> a", "ab" * 3000]
    data = np.frombuffer("".join(texts).encode(), dtype=np.uint8)
    offsets = np.cumsum([0, *(len(t.encode()) for t in texts)])
    draws = [[int(sha(f"1:{i}")[k : k + 8], 16) for k in (0, 8, 16, 24)] for i in range(len(texts))]
    made = fim._cut(data, offsets, np.array(draws))
    assert [(i, *row[:4], row[4].decode()) for i, row in enumerate(zip(*made, strict=True))] == [plain(i, t) for i, t in enumerate(texts)]


def test_query_against_plain_form(spark, tmp_path):
    texts = [prose(i, 3 + i % 50) + " été, 東京 " * (i % 3) for i in range(300)] + [None, "", "one <M> mark", "a" * 5000, "é" * 5000, prose(9, 40_000)]
    documents(spark, texts).write.parquet(str(tmp_path / "documents.parquet"))
    rows = op11_fill_in_middle(spark, str(tmp_path)).collect()
    expected = [(*p[:5], sha(p[5]), sha(t or "")) for p, t in ((plain(i, t), t) for i, t in enumerate(texts))]
    assert sorted(map(tuple, rows)) == sorted(expected)
    assert {r["form"] for r in rows} == {"plain", "psm", "spm"}


def test_texts_that_end_or_begin_like_a_mark_come_back(spark):
    texts = ["<", "<P", "S>", "a<P b>", "<<<", ">>", "<p> <s>", "M>x<"] * 40
    made = fim.fill_in_middle(documents(spark, texts)).withColumn("back", fim.restored(F.col("output"), F.col("form")))
    assert all(r["back"] == texts[r["doc_id"]] for r in made.collect())


def test_awkward_and_empty(spark):
    table = awkward(spark).repartition(2)
    rows = fim.fill_in_middle(table).collect()
    assert sorted(map(tuple, rows), key=order) == sorted((plain(r["doc_id"], r["text"]) for r in table.collect()), key=order)
    assert fim.fill_in_middle(empty(spark)).count() == 0
