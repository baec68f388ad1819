"""Best-fit packing of tokenised documents by exact-complement hashing over their lengths."""

from __future__ import annotations

import os
import re
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from namewright.llm.numbering import ROWS_PER_PART, number_within
from namewright.sources.staging import stage

CAPACITY = 1024
END = 2
#: Documents whose token ids a task holds at once.
BATCH = 1000

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids binary"


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


# Tokens

#: Beyond these characters, and for runs this long, the two libraries are not assumed to split alike.
_COMMON = re.compile(r"[\t\n\r\x20-\x7E¡-¬®-ɏ]*")
_LONG_RUN = 1000


@cache
def _encoders(path: str):
    """The tokenizer of ``path``, the faster reader of its rank file, if there is one beside it, and the tokens added to the vocabulary."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(path)
    added = tuple(token.content for token in exact.get_added_tokens_decoder().values())
    ranks = os.path.splitext(path)[0] + ".tiktoken"
    if not os.path.exists(ranks):
        return exact, None, added
    import base64

    import public_tokenizers
    import tiktoken

    with open(ranks, "rb") as lines:
        table = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}
    return exact, tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={}), added


def encode(text: str, path: str) -> list[int]:
    """Token ids by ``tokenizers``; common texts take the same vocabulary's rank file, four times faster.

    The rank file knows no added tokens: texts that hold the string of one go to ``tokenizers``, which takes it for the token.
    """
    exact, fast, added = _encoders(path)
    if fast is not None and _COMMON.fullmatch(text) and not any(token in text for token in added) and (
        len(text) < _LONG_RUN
        or " " * _LONG_RUN not in text and "\n" * _LONG_RUN not in text and max(map(len, text.split()), default=0) < _LONG_RUN
    ):
        return fast.encode_ordinary(text)
    return exact.encode(text, add_special_tokens=False).ids


def tokenise(
    documents: DataFrame,
    path: str | None = None,
    capacity: int = CAPACITY,
    end: int = END,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Pieces of at most ``capacity`` tokens: (doc_id, piece, start, length, ids little-endian 32-bit).

    A document is its token ids and the id ``end``; null text is empty, so every row has a piece. Longer documents
    are cut into pieces of ``capacity``, of which the first may be shorter. Repeated rows yield repeated pieces.
    """
    path = path or vocabulary("byte_bpe_50k.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, BATCH) for b in batches for at in range(0, len(b), BATCH)):
            columns: list[list] = [[], [], [], [], []]
            for doc, text in zip(batch.column(0), batch.column(1), strict=True):
                ids = np.array([*encode(text.as_py() or "", path), end], dtype="<u4")
                edge, piece = 0, 0
                while edge < len(ids):
                    length = (len(ids) - edge - 1) % capacity + 1 if not piece else capacity
                    for column, value in zip(columns, (doc.as_py(), piece, edge, length, ids[edge : edge + length].tobytes()), strict=True):
                        column.append(value)
                    edge, piece = edge + length, piece + 1
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=t) for c, t in zip(columns, types, strict=True)],
                names=["doc_id", "piece", "start", "length", "ids"],
            )

    return documents.select(F.col(id_column).cast("long"), F.col(text_column).cast("string")).mapInArrow(run, PIECE_SCHEMA)


# Packing

def best_fit_pack(pieces: DataFrame, capacity: int = CAPACITY, rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """Places pieces of ``length`` 1 to ``capacity`` in sequences; adds ``sequence_id`` and ``offset``.

    Only the number of pieces of each length, ``capacity`` rows, reaches the driver. There ``plan_patterns``
    makes patterns, lengths that fill a sequence, each with the number of sequences that follow it. Pieces of one length are numbered
    without gaps, in parts, so that a length most pieces have is no single task; number and length give the
    sequence and the place in it. Offsets are gapless from 0 and no two pieces overlap.

    ``pieces`` needs (doc_id, piece, length) and is written once, with whatever columns it has besides; ``sequence_id`` and ``offset`` are replaced.
    """
    pieces = pieces.drop("sequence_id", "offset")
    columns = pieces.columns
    written = stage(pieces.withColumn("_part", F.spark_partition_id()), "pieces")
    counts = stage(written.groupBy("length").agg(F.count("*").alias("n")), "lengths")
    lengths = {row["length"]: row["n"] for row in counts.collect()}
    if any(not 1 <= length <= capacity for length in lengths):
        raise ValueError(f"lengths must lie between 1 and {capacity}")
    numbered = number_within(written, "length", ["doc_id", "piece"], counts, "_number", rows_per_part)
    spans = written.sparkSession.createDataFrame(
        _spans(plan_patterns(lengths, capacity)), "_length long, _low long, _high long, _each long, _sequence long, _offset long"
    )
    inside = (F.col("length") == F.col("_length")) & (F.col("_number") >= F.col("_low")) & (F.col("_number") < F.col("_high"))
    at = F.col("_number") - F.col("_low")
    # At most one span for each pattern and length in it: bounded by the capacity, whatever the data.
    return numbered.join(F.broadcast(spans), inside).select(
        *columns,
        (F.col("_sequence") + F.floor(at / F.col("_each"))).alias("sequence_id"),
        (F.col("_offset") + at % F.col("_each") * F.col("length")).alias("offset"),
    )


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: (sequence_id, ids); ``packed`` must still carry ``ids``."""
    return packed.groupBy("sequence_id").agg(
        F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("_pieces")
    ).select("sequence_id", F.aggregate("_pieces", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"))


def plan_patterns(lengths: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, number of such sequences), using up all counts.

    Combinations of one, two or three lengths that exactly fill a gap are looked up by their sum in an index, under the counts left;
    what remains is placed by best fit. Where to stop with exact fills depends on the lengths: short ones spent early are
    missing later. So a few plans are made, a matter of milliseconds as they work on counts, and the one of the fewest sequences is kept: the one
    that fills every gap as it comes, and those that take exact fills by one, two or three lengths and leave all others to best fit in
    decreasing order. The last needs no more sequences than best fit alone does.
    """
    plans = [_fill_gaps(lengths, capacity), *(_fill_exactly(lengths, capacity, most) for most in (3, 2, 0))]
    return min(plans, key=lambda plan: sum(times for _, times in plan))


def _fill_gaps(lengths: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """The longest length left opens a sequence; where no combination fits its gap exactly, the longest length that fits goes in and the
    rest of the gap is looked up again. The pattern is repeated as often as its scarcest length allows, so each uses up a length."""
    stock = _Stock(lengths, capacity)
    patterns = []
    while stock.available:
        pattern: Counter[int] = Counter()
        gap = capacity
        while gap and (taken := stock.complement(gap, pattern) if pattern else (stock.longest(gap, pattern),)):
            if taken[0] == 0:
                break
            pattern.update(taken)
            gap -= sum(taken)
        patterns.append(stock.spend(pattern))
    return patterns


def _fill_exactly(lengths: dict[int, int], capacity: int, most: int) -> list[tuple[tuple[int, ...], int]]:
    """Sequences that a length and at most ``most`` others fill exactly, the longest first; then best fit."""
    stock = _Stock(lengths, capacity)
    patterns = []
    for length in sorted(stock.counts, reverse=True):
        while stock.counts[length] and (length == capacity or most):
            opened = Counter([length])
            taken = stock.exact(capacity - length, opened, most, even=True) if length < capacity else ()
            if length < capacity and not taken:
                break
            patterns.append(stock.spend(opened + Counter(taken)))
    return patterns + _best_fit_decreasing(stock.counts, capacity)


def _best_fit_decreasing(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Every length, the longest first, goes where it leaves the least gap. Sequences alike are one entry with their number."""
    open_: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    gaps: list[int] = []
    for length in sorted((k for k, n in counts.items() if n), reverse=True):
        left = counts[length]
        while left:
            at = bisect_left(gaps, length)
            if at == len(gaps):
                # New sequences take as many of the length as they hold.
                each = capacity // length
                for n, times in ((each, left // each), (left % each, 1)):
                    if n and times:
                        _leave(open_, gaps, capacity - n * length, ((length,) * n, times))
                break
            gap = gaps[at]
            pattern, times = open_[gap].pop()
            used = min(times, left)
            if used < times:
                open_[gap].append((pattern, times - used))
            if not open_[gap]:
                del open_[gap], gaps[at]
            _leave(open_, gaps, gap - length, ((*pattern, length), used))
            left -= used
    return [entry for entries in open_.values() for entry in entries]


def _leave(open_: dict[int, list], gaps: list[int], gap: int, entry: tuple[tuple[int, ...], int]) -> None:
    if gap not in open_:
        open_[gap] = []
        insort(gaps, gap)
    open_[gap].append(entry)


class _Stock:
    """Counts by length, and an index of the sums that the lengths in stock have alone, in pairs and in triples.

    ``pairs`` and ``triples`` count, by their sum, the ordered choices of two and three lengths in stock, one chosen twice included. When a length
    runs out, its choices are subtracted: an addition per sum. A sum without choices is never searched.
    """

    def __init__(self, lengths: dict[int, int], capacity: int) -> None:
        self.capacity = capacity
        self.counts = Counter({length: n for length, n in lengths.items() if n > 0})
        self.available = sum(1 << length for length in self.counts)
        self.single = np.zeros(capacity + 1, dtype=np.int64)
        self.single[list(self.counts)] = 1
        self.pairs = np.convolve(self.single, self.single)[: capacity + 1]
        self.triples = np.convolve(self.pairs, self.single)[: capacity + 1]

    def spend(self, pattern: Counter[int]) -> tuple[tuple[int, ...], int]:
        """Takes as many of a pattern as its scarcest length allows; the pattern and how many."""
        times = min(self.counts[length] // n for length, n in pattern.items())
        for length, n in pattern.items():
            self.counts[length] -= n * times
            if not self.counts[length]:
                self._run_out(length)
        return tuple(sorted(pattern.elements(), reverse=True)), times

    def _run_out(self, length: int) -> None:
        self.available ^= 1 << length
        self.triples[length:] -= 3 * self.pairs[: self.capacity + 1 - length]
        self.triples[2 * length :] += 3 * self.single[: max(self.capacity + 1 - 2 * length, 0)]
        self.pairs[length:] -= 2 * self.single[: self.capacity + 1 - length]
        self.single[length] = 0
        if 2 * length <= self.capacity:
            self.pairs[2 * length] += 1
        if 3 * length <= self.capacity:
            self.triples[3 * length] -= 1

    def _enough(self, pattern: Counter[int], *more: int) -> bool:
        wanted = Counter(more)
        return all(self.counts[length] >= pattern[length] + n for length, n in wanted.items())

    def longest(self, gap: int, pattern: Counter[int]) -> int:
        left = self.available & ((2 << gap) - 1)
        while left:
            length = left.bit_length() - 1
            if self._enough(pattern, length):
                return length
            left ^= 1 << length
        return 0

    def _firsts(self, total: int, parts: int, even: bool) -> list[int]:
        """Lengths that may be the longest of ``parts`` with this sum, from the longest down, or up from the evenest."""
        low = -(-total // parts)
        found = np.flatnonzero(self.single[low:total]) + low
        if parts == 3:
            found = found[self.pairs[total - found] > 0]
        return (found if even else found[::-1]).tolist()

    def _pair(self, total: int, pattern: Counter[int], even: bool, *with_: int) -> tuple[int, ...]:
        """Two available lengths of this sum, the longest first."""
        if total < 2 or not self.pairs[total]:
            return ()
        for length in self._firsts(total, 2, even):
            if self.single[total - length] and self._enough(pattern, length, total - length, *with_):
                return (length, total - length)
        return ()

    def exact(self, gap: int, pattern: Counter[int], most: int = 3, even: bool = False) -> tuple[int, ...]:
        """Up to ``most`` available lengths of this sum, as few as there are."""
        if most >= 1 and self.single[gap] and self._enough(pattern, gap):
            return (gap,)
        if most >= 2 and (found := self._pair(gap, pattern, even)):
            return found
        if most >= 3 and self.triples[gap]:
            for length in self._firsts(gap, 3, even):
                if found := self._pair(gap - length, pattern, even, length):
                    return (length, *found)
        return ()

    def complement(self, gap: int, pattern: Counter[int]) -> tuple[int, ...]:
        return self.exact(gap, pattern) or (self.longest(gap, pattern),)


def _spans(patterns: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first number, end, pieces a sequence, first sequence, first offset) for each length of each pattern."""
    used: Counter[int] = Counter()
    spans, sequence = [], 0
    for pattern, times in patterns:
        offset = 0
        for length, each in Counter(pattern).items():
            spans.append((length, used[length], used[length] + each * times, each, sequence, offset))
            used[length] += each * times
            offset += each * length
        sequence += times
    return spans
