"""Product codes of vectors in whole numbers: blocks along a Hilbert curve, shortlists of entries by boxes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from namewright.sources.staging import stage

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024

#: Vectors of a box, and of the row that holds boxes one after another.
BLOCK, ROW = 64, 4096

#: Parts of vectors that one task compares in a round, about.
ROWS_PER_TASK = 200_000

#: Components stay below this.
LIMIT = 1 << 28

#: Whole numbers below this are exact as doubles, in whatever order they are summed.
_EXACT = 1 << 53

_BLOCKS = "part int, n int, rows binary, components binary, low binary, high binary, sums binary"


# Codebooks

@dataclass
class Codebooks:
    """``entries[part, entry, position]``, whole numbers; fewer than ``ENTRIES`` where there are fewer vectors."""

    entries: np.ndarray

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def shortlist(low: np.ndarray, high: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Entries that may be nearest to some vector of the box, ties included, in ascending order.

    The least distance to the box must not exceed the smallest of the greatest distances.
    """
    under, over = low - entries, entries - high
    least = np.square(np.maximum(np.maximum(under, over), 0)).sum(axis=1)
    greatest = np.square(np.maximum(np.abs(under), np.abs(over))).sum(axis=1)
    return np.flatnonzero(least <= greatest.min())


def nearest(vectors: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each vector's nearest entry, the lowest of equals, and their squared distance, exactly.

    Squares and products are summed as doubles where a bound on the components shows that no sum leaves the whole numbers
    that doubles hold; else in 64-bit integers.
    """
    most = max(int(np.abs(vectors).max(initial=0)), int(np.abs(entries).max(initial=0)))
    kind = np.float64 if 4 * vectors.shape[1] * most * most < _EXACT else np.int64
    x, c = vectors.astype(kind), entries.astype(kind)
    rest = np.square(c).sum(axis=1) - 2 * (x @ c.T)
    best = rest.argmin(axis=1)
    distance = rest[np.arange(len(x)), best] + np.square(x).sum(axis=1)
    return best, distance.astype(np.int64)


# Hilbert curve

def hilbert(places: np.ndarray, bits: int) -> np.ndarray:
    """Number on the Hilbert curve of points with ``bits`` bits a coordinate (Skilling's transform), 63 bits in all at most."""
    axes = [column.astype(np.int64) for column in places.T]
    for level in range(bits - 1, 0, -1):
        lower = (1 << level) - 1
        for i, axis in enumerate(axes):
            turned = axis >> level & 1 == 1
            swap = np.where(turned, 0, (axes[0] ^ axis) & lower)
            axes[0] = np.where(turned, axes[0] ^ lower, axes[0] ^ swap)
            if i:
                axes[i] = axis ^ swap
    for i in range(1, len(axes)):
        axes[i] = axes[i] ^ axes[i - 1]
    flip = np.zeros(len(places), dtype=np.int64)
    for level in range(bits - 1, 0, -1):
        flip = np.where(axes[-1] >> level & 1 == 1, flip ^ ((1 << level) - 1), flip)
    number = np.zeros(len(places), dtype=np.int64)
    for level in range(bits - 1, -1, -1):
        for axis in axes:
            number = number << 1 | (axis ^ flip) >> level & 1
    return number


def curve_keys(components: np.ndarray, low: int, high: int) -> np.ndarray:
    """Order of part vectors along the curve; of more than 63 positions the first count."""
    used = components[:, :63]
    bits = min(63 // max(used.shape[1], 1), 16)
    return hilbert((used - low) * (1 << bits) // (high - low + 1), bits)


# Blocks

def whole_vectors(vectors: DataFrame, id_column: str, vector_column: str, label_column: str) -> DataFrame:
    """(_row, _id, _label, _components): the usable vectors in whole numbers, written once."""
    vector = F.col(vector_column).cast("array<double>")
    usable = F.coalesce(~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))), F.lit(False))
    # A component out of range becomes the limit here, and is then an error.
    whole = F.transform(vector, lambda x: F.floor(F.greatest(F.least(x, F.lit(float(LIMIT))), F.lit(float(-LIMIT))) * SCALE))
    whole = F.transform(whole, lambda x: F.greatest(F.least(x, F.lit(LIMIT)), F.lit(-LIMIT)).cast("int"))
    rows = vectors.select(F.col(id_column).alias("_id"), F.col(label_column).alias("_label"), whole.alias("_components"), usable.alias("_usable"))
    return stage(rows.where("_usable").drop("_usable").withColumn("_row", F.monotonically_increasing_id()), "whole-vectors")


def hilbert_blocks(whole: DataFrame, width: int, low: int, high: int, tasks: int) -> DataFrame:
    """The parts of all vectors in blocks along the curve of their part position: one row for ``ROW`` vectors.

    A row holds row numbers, components, and for each ``BLOCK`` of them the least and greatest components and their sums.
    Vectors that are equal in a part share a key; their row numbers decide, so they spread over tasks like others.
    """
    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(len(batch), PARTS, width)
            for part in range(PARTS):
                piece = np.ascontiguousarray(values[:, part], dtype="<i4")
                columns = [
                    pa.array(np.full(len(batch), part, dtype=np.int32)), pa.array(curve_keys(piece.astype(np.int64), low, high)),
                    batch.column(0), pa.array([row.tobytes() for row in piece], type=pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["part", "key", "row", "piece"])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows, values in _runs(batches, width):
            begins = np.arange(0, len(rows), BLOCK)
            columns = (
                rows, values, np.minimum.reduceat(values, begins), np.maximum.reduceat(values, begins),
                np.add.reduceat(values.astype(np.int64), begins),
            )
            arrays = [pa.array([part], type=pa.int32()), pa.array([len(rows)], type=pa.int32())]
            arrays += [pa.array([c.tobytes()], type=pa.binary()) for c in columns]
            yield pa.RecordBatch.from_arrays(arrays, names=["part", "n", "rows", "components", "low", "high", "sums"])

    parts = whole.select("_row", "_components").mapInArrow(keyed, "part int, key long, row long, piece binary")
    order = ["part", "key", "row"]
    return stage(parts.repartitionByRange(tasks, *order).sortWithinPartitions(*order).mapInArrow(blocks, _BLOCKS), "vector-blocks")


def _runs(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Consecutive rows of one part, ``ROW`` at a time."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    current, n = None, 0

    def take() -> tuple[int, np.ndarray, np.ndarray]:
        return current, np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])

    for batch in batches:
        parts, rows = batch.column("part").to_numpy(), batch.column("row").to_numpy()
        values = np.frombuffer(b"".join(batch.column("piece").to_pylist()), dtype="<i4").reshape(len(batch), width)
        at = 0
        while at < len(batch):
            if n and (n == ROW or parts[at] != current):
                yield take()
                held, n = [], 0
            current = int(parts[at])
            end = min(int(np.searchsorted(parts, current, side="right")), at + ROW - n)
            held.append((rows[at:end], values[at:end]))
            n += end - at
            at = end
    if n:
        yield take()


def _read(batch: pa.RecordBatch, width: int) -> Iterator[tuple]:
    """(part, rows, components, low, high, sums) of each row of blocks."""
    for row in batch.to_pylist():
        yield (
            row["part"], np.frombuffer(row["rows"], dtype="<i8"),
            *(np.frombuffer(row[name], dtype="<i4").reshape(-1, width).astype(np.int64) for name in ("components", "low", "high")),
            np.frombuffer(row["sums"], dtype="<i8").reshape(-1, width),
        )


# Rounds

def sums_by_entry(blocks: DataFrame, books: Codebooks) -> DataFrame:
    """(part, entry, n, sums): the vectors nearest to each entry, added up; entries without any are missing.

    A block whose shortlist is one entry gives its stored sums; its vectors are not compared. A task returns a row an entry at most.
    """
    entries = books.entries
    width = entries.shape[2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(entries.shape[:2], dtype=np.int64)
        total = np.zeros(entries.shape, dtype=np.int64)
        for batch in batches:
            for part, _, values, low, high, sums in _read(batch, width):
                for block, at in enumerate(range(0, len(values), BLOCK)):
                    piece, chosen = values[at : at + BLOCK], shortlist(low[block], high[block], entries[part])
                    if len(chosen) == 1:
                        n[part, chosen[0]] += len(piece)
                        total[part, chosen[0]] += sums[block]
                        continue
                    best = chosen[nearest(piece, entries[part][chosen])[0]]
                    np.add.at(n[part], best, 1)
                    np.add.at(total[part], best, piece)
        part, entry = np.nonzero(n)
        columns = [
            pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(n[part, entry]),
            pa.array(list(total[part, entry]), type=pa.list_(pa.int64())),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["part", "entry", "n", "sums"])

    partial = blocks.mapInArrow(run, "part int, entry int, n long, sums array<long>")
    added = F.array(*(F.sum(F.col("sums")[i]) for i in range(width)))
    return partial.groupBy("part", "entry").agg(F.sum("n").alias("n"), added.alias("sums"))


def fit(blocks: DataFrame, books: Codebooks, rounds: int = ROUNDS) -> Codebooks:
    """Moves each entry to the floor of the mean of its vectors, ``rounds`` times; unused entries stay.

    What reaches the driver in a round is a row for each entry of each part, whatever the number of vectors.
    """
    entries = books.entries.copy()
    for _ in range(rounds):
        moved = entries.copy()
        for row in sums_by_entry(blocks, Codebooks(entries)).collect():
            moved[row["part"], row["entry"]] = np.array(row["sums"], dtype=np.int64) // row["n"]
        entries = moved
    return Codebooks(entries)


def assign(blocks: DataFrame, books: Codebooks) -> DataFrame:
    """(row, part, entry, distance) for each part of each vector."""
    entries = books.entries
    width = entries.shape[2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, rows, values, low, high, _ in _read(batch, width):
                found = []
                for block, at in enumerate(range(0, len(values), BLOCK)):
                    chosen = shortlist(low[block], high[block], entries[part])
                    best, distance = nearest(values[at : at + BLOCK], entries[part][chosen])
                    found.append((chosen[best], distance))
                columns = [
                    pa.array(rows), pa.array(np.full(len(rows), part, dtype=np.int32)),
                    pa.array(np.concatenate([f[0] for f in found]).astype(np.int32)), pa.array(np.concatenate([f[1] for f in found])),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["row", "part", "entry", "distance"])

    return blocks.mapInArrow(run, "row long, part int, entry int, distance long")


def compress(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label"
) -> tuple[DataFrame, Codebooks]:
    """Codes of ``PARTS`` bytes for vectors, and the codebooks they refer to.

    Components become floor(``SCALE`` * x). Vectors are cut into ``PARTS`` equal parts; the entries of a part start as that of the
    vectors of the ``ENTRIES`` smallest ids, move ``ROUNDS`` times to the floor of their vectors' mean, and are then assigned. Everything
    is whole numbers, so neither the partitions nor lost executors change a code.

    Returns (id, label, code, error) a vector: two hexadecimal digits a part, and the squared distances added up. Rows whose vector is
    null or has null or non-finite components are dropped. A null id comes after all others; of rows that share an id the one of
    the lesser components comes first. Repeated rows yield repeated codes; without vectors there are no rows and no entries. Vectors of
    different widths, of a width that is no multiple of ``PARTS`` or of 0, and components of ``LIMIT`` / ``SCALE`` or more are errors;
    so are squared distances that might not fit 64 bits.
    """
    spark = vectors.sparkSession
    whole = whole_vectors(vectors, id_column, vector_column, label_column)
    reach = whole.agg(
        F.min(F.size("_components")).alias("narrow"), F.max(F.size("_components")).alias("wide"),
        F.min(F.array_min("_components")).alias("low"), F.max(F.array_max("_components")).alias("high"), F.count("*").alias("n"),
    ).first()
    kinds = {name: vectors.schema[name].dataType.simpleString() for name in (id_column, label_column)}
    if reach["narrow"] is None:
        return spark.createDataFrame([], f"_id {kinds[id_column]}, _label {kinds[label_column]}, code string, error long").toDF(
            id_column, label_column, "code", "error"), Codebooks(np.zeros((PARTS, 0, 0), dtype=np.int64))
    if reach["narrow"] != reach["wide"] or not reach["wide"] or reach["wide"] % PARTS:
        raise ValueError(f"vectors need one width, a multiple of {PARTS}: {reach['narrow']} to {reach['wide']}")
    width, most = reach["wide"] // PARTS, max(-reach["low"], reach["high"])
    if most >= LIMIT or 4 * width * most * most >= 1 << 63:
        raise ValueError(f"components of {most // SCALE}: their squared distances leave 64 bits")
    tasks = max(spark.sparkContext.defaultParallelism, -(-PARTS * reach["n"] // ROWS_PER_TASK))
    blocks = hilbert_blocks(whole, width, reach["low"], reach["high"], tasks)
    first = whole.orderBy(F.col("_id").asc_nulls_last(), "_components").limit(ENTRIES).select("_components").collect()
    start = np.array([r["_components"] for r in first], dtype=np.int64).reshape(len(first), PARTS, width).transpose(1, 0, 2)
    books = fit(blocks, Codebooks(start))
    found = assign(blocks, books).groupBy(F.col("row").alias("_row")).agg(
        *(F.max(F.when(F.col("part") == part, F.col("entry"))).alias(f"_{part}") for part in range(PARTS)), F.sum("distance").alias("error")
    )
    code = F.concat(*(F.lower(F.lpad(F.hex(F.col(f"_{part}").cast("long")), 2, "0")) for part in range(PARTS)))
    result = whole.join(found, "_row").select(F.col("_id").alias(id_column), F.col("_label").alias(label_column), code.alias("code"), "error")
    return result, books


def label_errors(codes: DataFrame, label_column: str = "label") -> DataFrame:
    """Adds ``label_error``, the errors of a label added up; nulls are one label. ``codes`` is written once and read twice.

    The sums combine before their shuffle, so a label that most vectors share is one row; the rows meet them by a join, not by a window.
    """
    codes = stage(codes, "codes")
    totals = stage(codes.groupBy(F.col(label_column).alias("_of")).agg(F.sum("error").alias("label_error")), "label-errors")
    return codes.join(totals, F.col(label_column).eqNullSafe(F.col("_of"))).drop("_of")
