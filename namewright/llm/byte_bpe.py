"""Byte-level BPE: texts to token ids with offsets, and ids back to bytes."""

from __future__ import annotations

import base64
import codecs
import os
import re
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters encoded at once, about.
CHUNK = 1 << 20

ENCODED = "ids binary, starts array<int>, ends array<int>"


def vocabulary(name: str = "byte_bpe_multi_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


# Bytes and characters

def byte_characters() -> list[str]:
    """The character that stands for each byte: itself where it is printable, else the next one from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(byte if byte in printable else next(others)) for byte in range(256)]


@cache
def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@cache
def tokenizer(path: str):
    """The ``tokenizers`` form of a rank file: ids are ranks, matches of the public pattern are encoded separately.

    A merge is listed for every way to part a token in two tokens, in the order of ranks. Merging by lowest rank reaches a token
    in one way only, wherever its bytes stand, so the ways that don't occur do no harm. A match that is a token as it stands
    takes that token.
    """
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    import public_tokenizers
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    table, characters = ranks(path), byte_characters()
    names = {token: "".join(characters[byte] for byte in token) for token in sorted(table, key=table.__getitem__)}
    merges = [
        (names[token[:at]], names[token[at:]])
        for token in names for at in range(1, len(token)) if token[:at] in names and token[at:] in names
    ]
    model = models.BPE(vocab={name: table[token] for token, name in names.items()}, merges=merges, ignore_merges=True)
    result = Tokenizer(model)
    result.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(Regex(public_tokenizers.PATTERN), "isolated"),
        pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
    ])
    return result


@cache
def _token_bytes(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all tokens one after another, where each id's begin, and their numbers."""
    table = ranks(path)
    tokens = [b""] * (max(table.values(), default=-1) + 1)
    for token, rank in table.items():
        tokens[rank] = token
    lengths = np.array([len(t) for t in tokens], dtype=np.int64)
    return np.frombuffer(b"".join(tokens), dtype=np.uint8), np.cumsum(lengths) - lengths, lengths


# Encoding

#: The white space of the public pattern.
_SPACE = r" \t-\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: White space and what follows up to the next: no match of the pattern goes on from other characters to white space, and none looks back.
_PARTS = re.compile(f"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")
_WHITE = frozenset(c for c in map(chr, range(0x3001)) if re.fullmatch(f"[{_SPACE}]", c))
_BORDER = re.compile(f"(?<=[^{_SPACE}])[{_SPACE}]")

#: Parts of texts, and ids of such, that a worker keeps at most between two chunks; parts that the library is given as one text.
KEPT, KEPT_IDS, JOINED = 200_000, 2_000_000, 4096


def _segments(text: str) -> Iterator[str]:
    """A long text in segments that are encoded as they would be in the whole."""
    at = 0
    while len(text) - at > CHUNK and (border := _BORDER.search(text, at + CHUNK)):
        yield text[at : border.start()]
        at = border.start()
    yield text[at:]


class _Parts:
    """Different parts of texts with their ids, one after another."""

    def __init__(self, path: str) -> None:
        self.path = path
        self.clear()

    def clear(self) -> None:
        self.places: dict[str, int] = {}
        self.ids, self.ends = np.zeros(0, dtype="<u4"), np.zeros(0, dtype=np.int64)

    def add(self, new: list[str]) -> None:
        """Parts that begin, but don't end, with white space may follow one another as they would in a text: many are encoded as one."""
        follow = [p for p in new if p[0] in _WHITE and p[-1] not in _WHITE]
        alone = list(set(new).difference(follow))
        runs = [follow[at : at + JOINED] for at in range(0, len(follow), JOINED)] + [[p] for p in alone]
        _, _, sizes = _token_bytes(self.path)
        ids, ends = [self.ids], [self.ends]
        total = len(self.ids)
        for run, made in zip(runs, tokenizer(self.path).encode_batch_fast(["".join(run) for run in runs], add_special_tokens=False), strict=True):
            ids.append(np.array(made.ids, dtype="<u4"))
            until = np.cumsum([len(p.encode()) for p in run])
            ends.append(total + np.searchsorted(np.cumsum(sizes[ids[-1]]), until) + 1)
            total += len(ids[-1])
        self.places.update(zip([*follow, *alone], range(len(self.places), len(self.places) + len(new)), strict=True))
        self.ids, self.ends = np.concatenate(ids), np.concatenate(ends)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.places) > KEPT or len(self.ids) > KEPT_IDS:
            self.clear()
        parts = [_PARTS.findall(text) for text in texts]
        if new := list(set(chain.from_iterable(parts)) - self.places.keys()):
            self.add(new)
        places = np.fromiter(map(self.places.__getitem__, chain.from_iterable(parts)), dtype=np.int64)
        starts = np.concatenate([[0], self.ends[:-1]])[places] if len(places) else places
        lengths = self.ends[places] - starts
        until = np.concatenate([[0], np.cumsum(lengths)])
        found = self.ids[np.repeat(starts - until[:-1], lengths) + np.arange(until[-1])]
        borders = until[np.cumsum([0, *map(len, parts)])]
        return [found[low:high] for low, high in zip(borders, borders[1:], strict=False)]


@cache
def _parts(path: str) -> _Parts:
    return _Parts(path)


def encode_texts(texts: Iterable[str], path: str) -> Iterator[np.ndarray]:
    """Token ids of each text. Each different part of a chunk of texts is encoded once, and frequent ones are kept."""
    parts = _parts(path)
    waiting, size = [], 0
    for text in texts:
        if len(text) > CHUNK:
            yield from parts.encode(waiting)
            waiting, size = [], 0
            yield np.concatenate([parts.encode([segment])[0] for segment in _segments(text)])
            continue
        waiting.append(text)
        size += len(text)
        if size >= CHUNK:
            yield from parts.encode(waiting)
            waiting, size = [], 0
    yield from parts.encode(waiting)


def offsets(text: str, ids: np.ndarray, path: str) -> tuple[np.ndarray, np.ndarray]:
    """First character of each token and the one after its last; a token of part of a character counts the whole one."""
    _, _, lengths = _token_bytes(path)
    ends = np.cumsum(lengths[ids])
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    character = np.cumsum((data & 0xC0) != 0x80) - 1
    return character[ends - lengths[ids]].astype(np.int32), (character[ends - 1] + 1).astype(np.int32)


def encode_documents(
    documents: DataFrame, path: str | None = None, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Token ids of each whole text: (id, ids, starts, ends), ids as little-endian unsigned 32-bit numbers.

    ``starts`` and ``ends`` are the tokens' places in the text, in code points; of a character that several tokens share, each has
    the whole. Strings that look like special tokens are ordinary text. A null text is empty and has no tokens. One row per input
    row, repeated rows included; no other column is returned. Long texts are encoded in segments between words.
    """
    path = path or vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for rows in _chunks(batch.column(1)):
                texts = [t or "" for t in batch.column(1).slice(at, rows).to_pylist()]
                ids = list(encode_texts(texts, path))
                places = [offsets(t, i, path) for t, i in zip(texts, ids, strict=True)]
                columns = [
                    batch.column(0).slice(at, rows), pa.array([i.tobytes() for i in ids], type=pa.binary()),
                    *(pa.array([p[side] for p in places], type=pa.list_(pa.int32())) for side in (0, 1)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[id_column, "ids", "starts", "ends"])
                at += rows

    rows = documents.select(F.col(id_column), F.col(text_column).cast("string").alias("_text"))
    return rows.mapInArrow(run, f"`{id_column}` {rows.schema[0].dataType.simpleString()}, {ENCODED}")


def _chunks(texts: pa.Array) -> Iterator[int]:
    """Numbers of rows that hold about ``CHUNK`` bytes."""
    rows, size = 0, 0
    for length in pc.binary_length(texts).to_pylist():
        rows, size = rows + 1, size + (length or 0)
        if size >= CHUNK:
            yield rows
            rows, size = 0, 0
    if rows:
        yield rows


# Decoding

def token_bytes(ids: np.ndarray, path: str) -> bytes:
    """The bytes of tokens one after another. An id that the vocabulary lacks is an error."""
    data, begins, lengths = _token_bytes(path)
    sizes = lengths[ids]
    if not sizes.all():
        raise ValueError("no such token id")
    ends = np.cumsum(sizes)
    return data[np.repeat(begins[ids] - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)].tobytes()


def decode_documents(ids: Column, path: str | None = None) -> Column:
    """Bytes of the tokens of a column of ids as ``encode_documents`` returns them; null stays null."""
    path = path or vocabulary()

    @F.pandas_udf("binary")
    def decoded(column: pd.Series) -> pd.Series:
        return column.map(lambda b: None if b is None else token_bytes(np.frombuffer(b, dtype="<u4"), path))

    return decoded(ids)


def decode_parts(parts: Iterable[np.ndarray], path: str) -> Iterator[str]:
    """Texts of consecutive parts of a document's ids.

    A character that a border splits belongs to the part that completes it; what is never completed becomes U+FFFD.
    """
    decoder = codecs.getincrementaldecoder("utf-8")("replace")
    waiting = None
    for part in parts:
        if waiting is not None:
            yield decoder.decode(waiting)
        waiting = token_bytes(part, path)
    if waiting is not None:
        yield decoder.decode(waiting, final=True)
