"""Fill-in-the-middle: documents cut between units that are found in the 64-bit words of their bytes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from namewright.llm.words import buffers

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"

#: Of 100 documents, those that stay plain, and those among the others whose suffix comes first.
PLAIN_SHARE, SPM_SHARE = 10, 20

#: Bytes cut at once (a longer text is cut alone), and words marked at once.
CHUNK_BYTES, BLOCK_WORDS = 1 << 22, 1 << 16

SCHEMA = "n long, form string, prefix_chars long, middle_chars long, output string"

_HIGH = np.uint64(0x8080808080808080)
_LOW = ~_HIGH
_ONES = np.uint64(0x0101010101010101)
_CASE = _ONES * np.uint64(0x20)
#: Added to a byte below 128, these carry into its top bit from "a" on, and from the character after "z" on.
_FROM_A, _PAST_Z = _ONES * np.uint64(0x80 - 0x61), _ONES * np.uint64(0x80 - 0x7B)


# Marks in words

def _letters(words: np.ndarray) -> np.ndarray:
    low = words & _LOW | _CASE
    return (low + _FROM_A) & ~(low + _PAST_Z) & ~words & _HIGH


def _next_byte(marks: np.ndarray) -> np.ndarray:
    return marks[:-1] >> np.uint64(8) | marks[1:] << np.uint64(56)


@dataclass
class Marks:
    """Marked bytes of a text: the top bit of a byte in little-endian words. A word of no text follows."""

    words: np.ndarray

    def __post_init__(self) -> None:
        self.until = np.zeros(len(self.words) + 1, dtype=np.int64)
        np.cumsum(np.bitwise_count(self.words), out=self.until[1:])

    def rank(self, places: np.ndarray) -> np.ndarray:
        """Marks on the bytes before each place."""
        below = (np.uint64(1) << (places & 7).astype(np.uint64) * np.uint64(8)) - np.uint64(1)
        return self.until[places >> 3] + np.bitwise_count(self.words[places >> 3] & below)

    def select(self, numbers: np.ndarray) -> np.ndarray:
        """Places of the marks of these numbers, from 1: the word by search, the byte by dropping lower marks."""
        word = np.searchsorted(self.until, numbers) - 1
        left, skip = self.words[word], numbers - self.until[word] - 1
        for step in range(7):
            left = np.where(skip > step, left & (left - np.uint64(1)), left)
        lowest = left & (~left + np.uint64(1))
        return word * 8 + (np.bitwise_count(lowest - np.uint64(1)) >> 3)


def mark(data: np.ndarray, tails: np.ndarray) -> tuple[Marks, Marks]:
    """Last bytes of units, and first bytes of code points, of UTF-8 texts that lie one after another.

    A unit is a run of A-Z and a-z or one other code point. A byte ends one if the next byte continues no code point and
    the two aren't both letters; ``tails``, the last bytes of the texts, always do.
    """
    padded = np.zeros(len(data) // 8 * 8 + 16, dtype=np.uint8)
    padded[: len(data)] = data
    words = padded.view("<u8")
    ends, firsts = np.zeros(len(words), dtype="<u8"), np.zeros(len(words), dtype="<u8")
    for at in range(0, len(words) - 1, BLOCK_WORDS):
        part = words[at : at + BLOCK_WORDS + 1]
        letters, inner = _letters(part), part & ~(part << np.uint64(1)) & _HIGH
        done = slice(at, at + len(part) - 1)
        ends[done] = _HIGH & ~_next_byte(inner) & ~(letters[:-1] & _next_byte(letters))
        firsts[done] = _HIGH & ~inner[:-1]
    ends.view(np.uint8)[tails] = 0x80
    return Marks(ends), Marks(firsts)


# Documents

def _cut(data: np.ndarray, offsets: np.ndarray, draws: np.ndarray) -> tuple[list, list, list, list, list]:
    starts, ends = offsets[:-1], offsets[1:]
    units, points = mark(data, ends[ends > starts] - 1)
    before = units.rank(starts)
    n = units.rank(ends) - before
    cuts = np.sort(draws[:, :2] % (n + 1)[:, None], axis=1)
    first, second = (np.where(cut > 0, units.select(np.maximum(before + cut, 1)) + 1, starts) for cut in cuts.T)
    prefix, middle = points.rank(first) - points.rank(starts), points.rank(second) - points.rank(first)
    whole = data.tobytes()
    marks = [name.encode() for name in (PREFIX, SUFFIX, MIDDLE)]
    forms, outputs = [], []
    for a, b, c, d, (_, _, plain, spm) in zip(*(x.tolist() for x in (starts, first, second, ends)), draws.tolist(), strict=True):
        text = whole[a:d]
        if not text or plain % 100 >= 100 - PLAIN_SHARE or any(m in text for m in marks):
            forms.append(PLAIN)
            outputs.append(text)
        elif spm % 100 < SPM_SHARE:
            forms.append(SPM)
            outputs.append(b"".join((marks[1], whole[c:d], marks[0], whole[a:b], marks[2], whole[b:c])))
        else:
            forms.append(PSM)
            outputs.append(b"".join((marks[0], whole[a:b], marks[1], whole[c:d], marks[2], whole[b:c])))
    lengths = ([None if f == PLAIN else k for f, k in zip(forms, x.tolist(), strict=True)] for x in (prefix, middle))
    return n.tolist(), forms, *lengths, outputs


def _draws(digests: pa.Array) -> np.ndarray:
    """The first four groups of eight hexadecimal digits, as numbers."""
    return np.array([[int(d[i : i + 8], 16) for i in (0, 8, 16, 24)] for d in digests.to_pylist()], dtype=np.int64).reshape(-1, 4)


def fill_in_middle(documents: DataFrame, seed: int = 1, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Cuts each whole text in three: (id, n units, form, prefix_chars, middle_chars, output).

    Units, runs of A-Z and a-z or single other code points, are never cut. The SHA-256 of ``seed:id`` gives both cuts and the
    form, so a document is cut alike in every run. ``psm`` is prefix, suffix, middle, each after its mark; ``spm`` puts the suffix
    first; ``plain`` is the text: where it is empty, holds a mark itself, or by draw. The lengths of plain texts are null.

    A null text is empty, a null id counts as an empty one. One row per input row, repeated rows included; no other column is
    returned. Texts are cut in chunks of rows of about ``CHUNK_BYTES``, longer ones alone; no row is split, shuffled or shortened.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, data = buffers(batch.column(1))
            draws = _draws(batch.column(2))
            at = 0
            while at < len(batch):
                end = int(np.searchsorted(offsets, offsets[at] + CHUNK_BYTES, side="right")) - 1
                end = min(max(end, at + 1), len(batch))
                made = _cut(data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at], draws[at:end])
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64())
                arrays = [pa.array(values, type=kind) for values, kind in zip(made[:4], kinds, strict=True)]
                arrays.append(pa.array(made[4], type=pa.binary()).cast(pa.string()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, end - at), *arrays], names=names)
                at = end

    keys = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit(""))), 256)
    rows = documents.select(F.col(id_column), F.col(text_column).cast("string").alias("_text"), keys.alias("_key"))
    schema = f"`{id_column}` {rows.schema[0].dataType.simpleString()}, {SCHEMA}"
    names = [id_column, "n", "form", "prefix_chars", "middle_chars", "output"]
    return rows.mapInArrow(run, schema)


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made from; a text that holds a mark is always plain, so marks part the pieces."""
    parts = F.split(output, "<[PSM]>")
    return (
        F.when(form == PSM, F.concat(parts[1], parts[3], parts[2]))
        .when(form == SPM, F.concat(parts[2], parts[3], parts[1]))
        .otherwise(output)
    )
