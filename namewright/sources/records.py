"""Records of CSV files whose quoted fields hold line breaks, read in splits like any text.

A line is classed by how it leaves a reader that is outside of quotes, and one that is inside of them. Tasks run both
readers over each split and keep what became of them, a row a split; a window over those rows tells where each split really
starts, and whether a record that is open at its end is closed later. A second pass joins the lines of a record. Only the parts
of records that cross a split are shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from namewright.sources.staging import stage

#: What a line does to a reader outside of quotes: it stays outside, goes inside, or stays outside with a quote that never closes well.
WHOLE, OPENS, BROKEN = 0, 1, 2
#: What it does to one inside: no quote ends the field, it ends outside, it ends inside of another field, or a quote ends nothing.
STAYS, CLOSES, REOPENS, CLASHES = 0, 1, 2, 3

OUTSIDE, INSIDE = 0, 1
#: What becomes, in a split, of a record that was open before it.
OPEN, CLOSED, APART = 0, 1, 2

#: Private characters that stand for quotes which may close or open a field, only open one, or only close one.
_EITHER, _OPENING, _CLOSING = "\ue000", "\ue001", "\ue002"

#: All but quotes and those characters; in ranges, which Java matches far faster than the negated class.
_BETWEEN = r"[\x00-!#-\x{d7ff}\x{e003}-\x{10ffff}]+"

_SUMMARY = "file long, block long, fate int, from_outside int, from_inside int, n_quotes long, head string"
_PIECES = "file long, record string, literal boolean, begun long, block long"


# Lines

def _marks(line: Column, delimiters: str) -> Column:
    """The quotes of a line, by what they may do; doubled ones stand for themselves and are left out."""
    near = "".join(re.escape(d) for d in delimiters)
    # The quote stands first, so that nothing is looked behind at other places.
    opens, after = f'"(?<![^{near}\ufeff]")', f"(?![^{near}\r\n])"
    text = F.regexp_replace(F.translate(line, _EITHER + _OPENING + _CLOSING, "xxx"), '""', "")
    for pattern, mark in ((f"{opens}{after}", _EITHER), (opens, _OPENING), (f'"{after}', _CLOSING)):
        text = F.regexp_replace(text, pattern, mark)
    return F.regexp_replace(text, _BETWEEN, "")


def line_class(line: Column, delimiters: str) -> Column:
    """4 times what the line does outside of quotes, plus what it does inside."""
    marks = _marks(line, delimiters)

    def step(state: Column, mark: Column) -> Column:
        may_open, may_close = mark.isin(_EITHER, _OPENING), mark.isin(_EITHER, _CLOSING)
        out, inn = F.shiftright(state, 2), F.pmod(state, F.lit(4))
        out = F.when(out == WHOLE, may_open.cast("int")).when((out == OPENS) & may_close, WHOLE).otherwise(BROKEN)
        inn = F.when(inn == CLASHES, CLASHES).when(inn == CLOSES, F.when(may_open, REOPENS).otherwise(CLOSES)).when(may_close, CLOSES).otherwise(CLASHES)
        return (out * 4 + inn).cast("int")

    walked = F.aggregate(F.split(marks, ""), F.lit(4 * WHOLE + STAYS), step)
    # Most lines hold no quotes, or fields that open and close.
    closed = F.replace(marks, F.lit(_OPENING + _CLOSING), F.lit("")) == ""
    return (
        F.when(~F.contains(line, F.lit('"')) | (marks == ""), 4 * WHOLE + STAYS).when(closed, 4 * WHOLE + CLASHES).otherwise(walked)
    ).cast("int")


def read_lines(spark: SparkSession, path: str, pattern: str, delimiters: str) -> DataFrame:
    """(file, block, line with its end, class, n_quotes): the lines of all files, split where Spark splits them."""
    lines = spark.read.option("pathGlobFilter", pattern).option("lineSep", "\n").text(path)
    # A carriage return alone ends a line too.
    ended = F.concat("value", F.lit("\n"))
    line = F.explode(F.when(F.rlike("value", F.lit("\r[^\n]")), F.split(ended, "(?<=\r)(?!\n)")).otherwise(F.array(ended)))
    rows = lines.select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), line.alias("line")
    )
    quotes = F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))
    return rows.select("*", line_class(F.col("line"), delimiters).alias("class"), quotes.cast("long").alias("n_quotes"))


def without_end(line: str) -> str:
    return line.removesuffix("\n").removesuffix("\r")


# First pass: splits

class _Reader:
    """A reader of one split, started outside or inside of quotes."""

    def __init__(self, state: int) -> None:
        self.state, self.fate = state, OPEN
        self.waits = state == INSIDE

    def read(self, code: int) -> None:
        if self.state == OUTSIDE:
            self.state = INSIDE if code >> 2 == OPENS else OUTSIDE
            return
        done = code & 3
        if done in (CLOSES, CLASHES):
            if self.waits:
                self.waits, self.fate = False, CLOSED if done == CLOSES else APART
            self.state = INSIDE if done == CLASHES and code >> 2 == OPENS else OUTSIDE


class _Split:
    def __init__(self, file: int, block: int) -> None:
        self.file, self.block = file, block
        self.outside, self.inside = _Reader(OUTSIDE), _Reader(INSIDE)
        self.n_quotes, self.head, self.headless = 0, None, block == 0
        self._header: list[str] = []

    def read(self, codes: np.ndarray, n_quotes: int, lines: pa.Array) -> None:
        self.n_quotes += n_quotes
        if self.headless:
            self._find_header(codes, lines)
        busy = codes[codes != 4 * WHOLE + STAYS]
        # Of lines that open nothing and take no open record further, one stands for those after it.
        idle = busy == 4 * WHOLE + CLASHES
        for code in busy[~(idle & np.concatenate([[False], idle[:-1]]))].tolist():
            self.outside.read(code)
            self.inside.read(code)

    def _find_header(self, codes: np.ndarray, lines: pa.Array) -> None:
        """The first record that is not blank; one that is never closed is its first line."""
        for code, line in zip(codes.tolist(), lines, strict=True):
            text = line.as_py()
            if not self._header and not text.strip():
                continue
            self._header.append(text)
            done = code & 3 if len(self._header) > 1 else CLOSES if code >> 2 != OPENS else STAYS
            if done in (CLOSES, CLASHES):
                self.head = without_end("".join(self._header) if done == CLOSES else self._header[0])
                self.headless, self._header = False, []
                return

    def summary(self) -> tuple:
        head = without_end(self._header[0]) if self._header else self.head
        return self.file, self.block, self.inside.fate, self.outside.state, self.inside.state, self.n_quotes, head


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[int, int, slice]]:
    """(file, block, rows) of the splits in a batch, in their order."""
    files, blocks = batch.column("file").to_numpy(), batch.column("block").to_numpy()
    edges = np.flatnonzero((np.diff(files) != 0) | (np.diff(blocks) != 0)) + 1
    for low, high in zip([0, *edges.tolist()], [*edges.tolist(), len(files)], strict=True):
        if high > low:
            yield int(files[low]), int(blocks[low]), slice(low, high)


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    current, found = None, []
    for batch in batches:
        codes, quotes, lines = batch.column("class").to_numpy(), batch.column("n_quotes").to_numpy(), batch.column("line")
        for file, block, rows in _runs(batch):
            if current is None or (current.file, current.block) != (file, block):
                found += [current] if current else []
                current = _Split(file, block)
            current.read(codes[rows], int(quotes[rows].sum()), lines.slice(rows.start, rows.stop - rows.start))
    found += [current] if current else []
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.string())
    columns = list(zip(*(split.summary() for split in found), strict=True)) or [()] * len(kinds)
    yield pa.RecordBatch.from_arrays(
        [pa.array(c, type=k) for c, k in zip(columns, kinds, strict=True)],
        names=["file", "block", "fate", "from_outside", "from_inside", "n_quotes", "head"],
    )


def read_splits(lines: DataFrame) -> DataFrame:
    """One row a split: (file, block, starts, begun, begun_closed, ends_closed, n_quotes, head), written once.

    ``starts`` tells whether the split starts inside of quotes, ``begun`` is the block where that record begins, ``begun_closed`` whether
    it is closed somewhere, ``ends_closed`` whether a record that begins in this split and is open at its end is. Splits whose readers end alike
    set the state, others keep or swap it; so the state after a split is that of the last one to set it, swapped as often as there
    are swaps since.
    """
    # Only the first split of a file can hold its header; the others send no text.
    sent = lines.select("file", "block", F.when(F.col("block") == 0, F.col("line")).alias("line"), "class", "n_quotes")
    rows = sent.mapInArrow(_summaries, _SUMMARY)
    order = Window.partitionBy("file").orderBy("block")
    until, later = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(1, Window.unboundedFollowing)
    known = F.when(F.col("from_outside") == F.col("from_inside"), F.col("from_outside"))
    swaps = (F.col("from_outside") > F.col("from_inside")).cast("int")
    rows = rows.withColumns({"_known": known, "_swaps": F.sum(swaps).over(until)})
    rows = rows.withColumns({
        "_last": F.coalesce(F.last("_known", True).over(until), F.lit(OUTSIDE)),
        "_since": F.col("_swaps") - F.coalesce(F.last(F.when(F.col("_known").isNotNull(), F.col("_swaps")), True).over(until), F.lit(0)),
    })
    rows = rows.withColumn("_after", F.pmod(F.col("_last") + F.col("_since"), F.lit(2)).cast("int"))
    rows = rows.withColumn("starts", F.lag("_after", 1, OUTSIDE).over(order) == INSIDE)
    opened = (F.col("_after") == INSIDE) & ~(F.col("starts") & (F.col("fate") == OPEN))
    rows = rows.withColumns({
        "_opened": F.when(opened, F.col("block")),
        "ends_closed": F.coalesce(F.first(F.when(F.col("fate") != OPEN, F.col("fate")), True).over(later) == CLOSED, F.lit(False)),
    })
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    own = F.when(F.col("fate") != OPEN, F.col("fate") == CLOSED).otherwise(F.col("ends_closed"))
    rows = rows.withColumns({"begun": F.when(F.col("starts"), F.last("_opened", True).over(before)), "begun_closed": F.col("starts") & own})
    columns = ("file", "block", "starts", "begun", "begun_closed", "ends_closed", "n_quotes", "head")
    return stage(rows.select(*columns), "csv-splits")


# Second pass: records

class _Joiner:
    """Puts the lines of one split together; ``out`` takes (record, literal, block where the record begins or None)."""

    def __init__(self, file: int, block: int, starts: bool, begun: int | None, begun_closed: bool, ends_closed: bool, out: list) -> None:
        self.file, self.block, self.begun, self.begun_closed, self.ends_closed, self.out = file, block, begun, begun_closed, ends_closed, out
        self.header = block == 0
        #: Lines of an open record, and whether it began before this split.
        self.open: list[tuple[str, int]] = []
        self.inside, self.foreign = starts, starts

    def put(self, text: str, literal: bool, begun: int | None = None) -> None:
        if begun is None:
            if not text.strip():
                return
            if self.header:
                self.header = False
                return
        self.out.append((self.file, text, literal, begun, self.block))

    def fall_apart(self) -> None:
        for text, code in self.open:
            self.put(text, code >> 2 != WHOLE)
        self.open, self.inside, self.foreign = [], False, False

    def read(self, text: str, code: int) -> None:
        if self.inside:
            done = code & 3
            if done in (STAYS, REOPENS):
                self.open.append((text, code))
                return
            if done == CLOSES:
                whole = "".join([*(t for t, _ in self.open), text])
                self.put(whole, False, self.begun if self.foreign else None)
                self.open, self.inside, self.foreign = [], False, False
                return
            self.fall_apart()
        if code >> 2 == OPENS:
            self.open, self.inside = [(text, code)], True
        else:
            self.put(text, code >> 2 == BROKEN)

    def finish(self) -> None:
        if not self.inside:
            return
        closed = self.begun_closed if self.foreign else self.ends_closed
        if not closed:
            self.fall_apart()
        elif self.open:
            # A header that crosses a split is marked by the flag that no other part of a record has.
            self.put("".join(t for t, _ in self.open), self.header, self.begun if self.foreign else self.block)
            self.header = False


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    current, out = None, []
    for batch in batches:
        codes = batch.column("class").to_numpy()
        for file, block, rows in _runs(batch):
            if current is None or (current.file, current.block) != (file, block):
                if current is not None:
                    current.finish()
                    yield _flush(out)
                first = {name: batch.column(name)[rows.start].as_py() for name in ("starts", "begun", "begun_closed", "ends_closed")}
                current = _Joiner(file, block, **first, out=out)
            lines = batch.column("line").slice(rows.start, rows.stop - rows.start)
            if not current.inside and not current.header and not ((codes[rows] >> 2) == OPENS).any():
                yield _flush(out)
                yield _as_they_are(file, block, lines, codes[rows])
                continue
            for text, code in zip(lines.to_pylist(), codes[rows].tolist(), strict=True):
                current.read(text, code)
        yield _flush(out)
    if current is not None:
        current.finish()
    yield _flush(out)


def _flush(out: list) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.string(), pa.bool_(), pa.int64(), pa.int64())
    columns: Iterable = list(zip(*out, strict=True)) or [()] * len(kinds)
    out.clear()
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=k) for c, k in zip(columns, kinds, strict=True)], names=["file", "record", "literal", "begun", "block"]
    )


def _as_they_are(file: int, block: int, lines: pa.Array, codes: np.ndarray) -> pa.RecordBatch:
    n = len(lines)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(n, file)), lines.cast(pa.string()), pa.array(codes >> 2 == BROKEN), pa.nulls(n, pa.int64()), pa.array(np.full(n, block))],
        names=["file", "record", "literal", "begun", "block"],
    )


#: Splits that a broadcast may describe; of more, the rows meet them by a shuffle and are put in order again.
MOST_BROADCAST = 1_000_000


def read_records(lines: DataFrame, splits: DataFrame, most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """(file, record, literal): all records but the header of each file, without the line break after them; blank ones are left out.

    A record spans lines where a quote that begins a field is closed, on a later line, by one that ends a field. A quote that isn't
    closed so is an ordinary character: its lines stand alone, and those with an odd number of quotes are ``literal``.
    """
    crossed = stage(
        splits.where("starts OR ends_closed").select("file", "block", "starts", "begun", "begun_closed", "ends_closed"), "crossed-splits"
    )
    rows = lines.select("file", "block", "line", "class")
    if crossed.count() <= most_broadcast:
        # A broadcast join keeps the order of the lines.
        known = rows.join(F.broadcast(crossed), ["file", "block"], "left")
    else:
        known = rows.withColumn("_place", F.monotonically_increasing_id()).join(crossed, ["file", "block"], "left")
        known = known.repartition("file", "block").sortWithinPartitions("file", "block", "_place").drop("_place")
    known = known.fillna(False, ["starts", "begun_closed", "ends_closed"])
    pieces = known.mapInArrow(_joined, _PIECES)
    parts = pieces.where(F.col("begun").isNotNull()).groupBy("file", "begun").agg(
        F.sort_array(F.collect_list(F.struct("block", "record"))).alias("_parts"), F.max("literal").alias("_header")
    )
    crossing = parts.where(~F.col("_header")).select("file", F.array_join("_parts.record", "").alias("record"), F.lit(False).alias("literal"))
    records = pieces.where(F.col("begun").isNull()).select("file", "record", "literal").union(crossing)
    odd = (F.length("record") - F.length(F.replace("record", F.lit('"'), F.lit("")))) % 2 == 1
    return records.where(F.trim(F.translate("record", "\t\r\n", "   ")) != "").select(
        "file", F.regexp_replace("record", "(?:\r\n|\n|\r)\\z", "").alias("record"), (F.col("literal") & odd).alias("literal")
    )
