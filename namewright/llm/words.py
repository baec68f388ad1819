"""Words of Arrow text columns as numpy arrays of places and 64-bit hashes, whole texts at a time."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes handled at once; a longer text is cut between words and put together again.
CHUNK_BYTES = 1 << 20

_RADIX = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

ALPHANUMERIC = np.zeros(256, dtype=bool)
ALPHANUMERIC[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def lower_bytes(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z as a-z."""
    return _LOWER[data]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """Words of the rows ``first`` to ``first + len(counts) - 1`` of a batch."""

    first: int
    counts: np.ndarray
    #: Byte offsets in the text of the word's row.
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray

    @property
    def begins(self) -> np.ndarray:
        """Place of each row's first word, and the end of the last."""
        return np.concatenate([[0], np.cumsum(self.counts)])


class _Powers:
    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def reach(self, n: int) -> None:
        if len(self.up) < n:
            size = max(n, CHUNK_BYTES + 1)
            ones = np.ones(size, dtype=np.uint64)
            ones[1:] = _RADIX
            self.up = np.cumprod(ones)
            ones[1:] = _INVERSE
            self.down = np.cumprod(ones)


_POWERS = _Powers()


def _hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    _POWERS.reach(len(data) + 1)
    summed = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _POWERS.up[: len(data)], out=summed[1:])
    return mix((summed[ends] - summed[starts]) * _POWERS.down[starts])


def spans_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of short spans of ``data``, all of the same length, A-Z taken as a-z."""
    code = np.zeros(len(starts), dtype=np.uint64)
    for step in range(int(ends[0] - starts[0]) if len(starts) else 0):
        code = code * _RADIX + _LOWER[data[starts + step]] + np.uint64(1)
    return mix(code)


def _spans(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of word bytes; none crosses a row's border."""
    inside = is_word[data]
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    filled = offsets[:-1] < offsets[1:]
    heads, tails = offsets[:-1][filled], offsets[1:][filled] - 1
    starts[heads] = inside[heads]
    ends[tails] = inside[tails]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


def _chunk(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray, first: int) -> Words:
    data = _LOWER[data]
    starts, ends = _spans(data, offsets, is_word)
    counts = np.diff(np.searchsorted(starts, offsets))
    shift = np.repeat(offsets[:-1], counts)
    return Words(first, counts, starts - shift, ends - shift, _hash_spans(data, starts, ends))


def _long_row(data: np.ndarray, is_word: np.ndarray, first: int) -> Words:
    parts, at = [], 0
    while at < len(data):
        end = min(at + CHUNK_BYTES, len(data))
        while end < len(data):
            gaps = np.flatnonzero(~is_word[data[at:end]])
            if len(gaps):
                end = at + int(gaps[-1]) + 1
                break
            end = min(end + CHUNK_BYTES, len(data))
        part = _chunk(data[at:end], np.array([0, end - at]), is_word, first)
        part.starts += at
        part.ends += at
        parts.append(part)
        at = end
    join = lambda name: np.concatenate([getattr(p, name) for p in parts])
    hashes = join("hashes")
    return Words(first, np.array([len(hashes)]), join("starts"), join("ends"), hashes)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a text column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "")
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    if not len(column):
        return np.zeros(1, dtype=np.int64), np.zeros(0, dtype=np.uint8)
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, dtype=width)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return offsets.astype(np.int64), data


def words(column: pa.Array, is_word: np.ndarray = ALPHANUMERIC) -> Iterator[Words]:
    """Words of all rows in order, A-Z taken as a-z: runs of the bytes marked in ``is_word``."""
    offsets, data = buffers(column)
    at, n = 0, len(offsets) - 1
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + CHUNK_BYTES, side="right")) - 1
        end = min(max(end, at + 1), n)
        low, high = offsets[at], offsets[end]
        if end == at + 1 and high - low > CHUNK_BYTES:
            yield _long_row(data[low:high], is_word, at)
        else:
            yield _chunk(data[low:high], offsets[at : end + 1] - low, is_word, at)
        at = end


def grams(found: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the k words from each place, and whether they all belong to one row."""
    hashes, n = found.hashes, len(found.hashes)
    rolled = np.zeros(n, dtype=np.uint64)
    for step in range(k):
        rolled *= _RADIX
        rolled[: max(n - step, 0)] += hashes[step:]
    left = np.repeat(found.begins[1:], found.counts) - np.arange(n)
    return mix(rolled), left >= k


def short_grams(hashes: np.ndarray, begins: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Hash of the ``counts`` words from each of ``begins``, and of no word after them."""
    rolled = np.zeros(len(begins), dtype=np.uint64)
    for step in range(int(counts.max(initial=0))):
        inside = step < counts
        rolled[inside] = rolled[inside] * _RADIX + hashes[begins[inside] + step]
    return mix(rolled + counts.astype(np.uint64))
