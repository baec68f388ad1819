from __future__ import annotations

import hashlib
import re
from functools import cache

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from namewright.llm import byte_bpe as bpe
from namewright.llm.queries import op13_byte_bpe
from tests.llm.tables import awkward, documents, empty, prose

PATH = bpe.vocabulary()


@cache
def library():
    import public_tokenizers
    import tiktoken

    return tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks(PATH), special_tokens={})


def encoded(text):
    return next(bpe.encode_texts([text], PATH)).tolist()


def sha(data):
    return hashlib.sha256(data).hexdigest()


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=80), st.text(alphabet="aé 'st\n\t|<%1!\x1c\x1f\x85\xa0\u1680\u200b\u2028\u3000\u180e東🇩\u0301abA", max_size=60)))
def test_ids_are_those_of_the_rank_library(text):
    ids = encoded(text)
    assert ids == library().encode_ordinary(text)
    assert bpe.token_bytes(np.array(ids, dtype="<u4"), PATH) == text.encode()
    expected = bpe.tokenizer(PATH).encode(text, add_special_tokens=False).offsets
    assert list(zip(*(x.tolist() for x in bpe.offsets(text, np.array(ids, dtype="<u4"), PATH)), strict=True)) == expected


def test_each_token_alone_is_itself():
    # A match that is a token takes it, whether or not merges lead there.
    for token, rank in list(bpe.ranks(PATH).items())[::37]:
        try:
            text = token.decode()
        except UnicodeDecodeError:
            continue
        assert encoded(text) == library().encode_ordinary(text), rank


def test_repeats_and_special_strings():
    for text in ("<|endoftext|>", "a" * 3000, "aba" * 2000, " " * 3000, "\n" * 1500 + "x", "!?" * 900, prose(1, 3000), "東京" * 500):
        assert encoded(text) == library().encode_ordinary(text)


def test_white_space_is_that_of_the_pattern():
    import tiktoken

    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    spaces = tiktoken.Encoding("s", pat_str=r"\s", mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={})
    assert bytes(spaces.encode_ordinary(every)).decode() == re.sub(f"[^{bpe._SPACE}]", "", every)


def test_kept_parts_change_nothing(monkeypatch):
    texts = [prose(i, 60) + " \x1c\x1d x  y\u3000z " + "y" * 100 for i in range(30)] * 2
    for kept, joined in ((50, 7), (1000, 1), (0, 4096)):
        monkeypatch.setattr(bpe, "KEPT", kept)
        monkeypatch.setattr(bpe, "JOINED", joined)
        monkeypatch.setattr(bpe, "CHUNK", 500)
        assert [i.tolist() for i in bpe.encode_texts(texts, PATH)] == [library().encode_ordinary(t) for t in texts]


@pytest.mark.parametrize("chunk", [1, 7, 100])
def test_segments_are_encoded_as_in_the_whole(monkeypatch, chunk):
    text = prose(3, 200) + "  two  spaces \n\n lines　　wide \x1c odd  " + "don't I'll " * 9 + "x" * 300 + "   "
    whole = encoded(text)
    monkeypatch.setattr(bpe, "CHUNK", chunk)
    assert "".join(bpe._segments(text)) == text and len(list(bpe._segments(text))) > 2
    assert encoded(text) == whole == library().encode_ordinary(text)


def test_parts_complete_split_characters():
    text = "a 🇩🇪 ⟁ b"
    ids = np.array(encoded(text), dtype="<u4")
    starts, ends = bpe.offsets(text, ids, PATH)
    assert (starts[1:] < ends[:-1]).any()
    parts = list(bpe.decode_parts([ids[i : i + 1] for i in range(len(ids))], PATH))
    assert len(parts) == len(ids) and "".join(parts) == text and "" in parts
    cut = next(i for i in range(1, len(ids)) if starts[i] < ends[i - 1])
    assert "".join(bpe.decode_parts([ids[:cut]], PATH)).endswith("�")
    assert list(bpe.decode_parts([], PATH)) == []


def test_an_id_without_token_is_an_error(tmp_path):
    import base64

    path = tmp_path / "sparse.tiktoken"
    path.write_bytes(b"".join(base64.b64encode(bytes([b])) + f" {b * 2}\n".encode() for b in range(256)))
    assert bpe.token_bytes(np.array([2 * 65, 2 * 66]), str(path)) == b"AB"
    with pytest.raises(ValueError):
        bpe.token_bytes(np.array([3]), str(path))


def test_query_against_the_rank_library(spark, tmp_path):
    texts = [prose(i, 3 + 11 * i % 300) + " été 東京" * (i % 4) for i in range(60)] + [None, "", "<|endoftext|>", prose(5, 30_000)]
    documents(spark, texts).write.parquet(str(tmp_path / "documents.parquet"))
    rows = op13_byte_bpe(spark, str(tmp_path)).collect()
    expected = []
    for doc, text in enumerate(texts):
        ids = library().encode_ordinary(text or "")
        expected.append((doc, len(ids), sha(np.array(ids, "<u4").tobytes()), sha((text or "").encode()), len(text or "")))
    assert sorted(map(tuple, rows)) == sorted(expected)


def test_awkward_and_empty(spark):
    table = awkward(spark)
    rows = bpe.encode_documents(table).withColumn("decoded", bpe.decode_documents(F.col("ids"))).collect()
    key = lambda r: (r[0] is None, str(r))
    assert sorted([(r["doc_id"], bytes(r["decoded"]).decode()) for r in rows], key=key) == sorted(
        [(r["doc_id"], r["text"] or "") for r in table.collect()], key=key)
    assert bpe.encode_documents(empty(spark)).count() == 0
    nothing = spark.createDataFrame([(None,)], "ids binary").select(bpe.decode_documents(F.col("ids")).alias("d"))
    assert nothing.collect()[0]["d"] is None
