"""The k most similar vectors of each query, exactly, with bounds that leave out most blocks.

Directions are points on a sphere, where angles obey the triangle inequality. Candidates are grouped by the nearest of a few pivots and,
within a group, by their angle to it; a query whose angle to the pivot lies far from those of a band can't be near to any vector of the
band. Queries first meet the bands that promise most, and then those that may hold a better vector than the k-th found. Bands that follow
each other make a part; a query travels once to each part, whatever number of its bands it needs, and there it skips the others. Products are
taken in single precision first; only pairs that may be among the best by their error bound are compared in double precision.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from namewright.sources.staging import stage

#: Pivots, and bands of each: the bound of what reaches the driver and the tasks, whatever the number of vectors.
PIVOTS, BANDS = 128, 16
#: Vectors of a part, and queries, that one group compares at most, about; fewer of wide vectors, for the bytes of each side.
BLOCK, QUERIES, SIDE_BYTES = 32_768, 32_768, 32 * 1024 * 1024
#: Queries and candidates of one product.
ROWS, COLUMNS = 1_024, 512
#: Digits of a similarity that count; more than a rounding error, far less than what angles are bounded by.
DECIMALS, SLACK = 9, 1e-7


def _unit(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    rows = np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), -1)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _angles(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    if not len(pivots):
        return np.zeros((len(vectors), 0))
    return np.arccos(np.clip(vectors @ pivots.T, -1, 1))


def usable(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, vector) of the vectors that have a direction: finite, and not all zero."""
    wide = F.col(vector).cast("array<double>")
    finite = ~F.exists(wide, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.select(key, wide.alias("vector")).where(F.coalesce(finite & F.exists(wide, lambda x: x != 0), F.lit(False)))


@dataclass(frozen=True)
class Bands:
    """What tasks need to know of the bands: at most ``pivots * bands`` entries."""

    pivots: np.ndarray
    pivot: np.ndarray
    band: np.ndarray
    low: np.ndarray
    high: np.ndarray
    n: np.ndarray

    def bounds(self, vectors: np.ndarray, chosen: np.ndarray | slice = slice(None)) -> np.ndarray:
        """The highest similarity that a vector of each band, of all or of the chosen ones, can have to each query."""
        pivots, at = np.unique(self.pivot[chosen], return_inverse=True)
        angles = _angles(vectors, self.pivots[pivots])[:, at]
        return np.cos(np.maximum(np.maximum(self.low[chosen] - angles, angles - self.high[chosen]), 0)) + SLACK


def _parts(n: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """First part, and number of parts, of each band: bands in a row share a part of ``block`` vectors, larger ones have several of their own."""
    first, several = np.zeros(len(n), dtype=np.int32), np.ceil(n / block).astype(np.int32)
    part, held = -1, block
    for at, (size, parts) in enumerate(zip(n.tolist(), several.tolist(), strict=True)):
        if held + size > block:
            part, held = part + 1, 0
        first[at], held = part, held + size
        part += parts - 1
    return first, several


class PivotIndex:
    """Candidates (key, vector) in bands around pivots, written once; the pivots are those of the lowest hashes."""

    def __init__(self, candidates: DataFrame, key: str, vector: str = "vector", pivots: int = PIVOTS, bands: int = BANDS, block: int = BLOCK) -> None:
        self.key, self.bands = key, bands
        written = stage(usable(candidates, key, vector), "directions")
        sizes = written.agg(F.min(F.size("vector")).alias("low"), F.max(F.size("vector")).alias("high")).first()
        if sizes["low"] != sizes["high"]:
            raise ValueError(f"vectors of width {sizes['low']} and {sizes['high']} can't be compared")
        self.width = sizes["high"]
        chosen = written.orderBy(F.xxhash64(key), key).limit(pivots).toArrow() if self.width else None
        self.pivots = _unit(chosen["vector"]) if chosen is not None and len(chosen) else np.zeros((0, 0))
        own = self.pivots

        def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not len(batch):
                    continue
                angles = _angles(_unit(batch.column("vector")), own)
                pivot = angles.argmin(axis=1)
                added = {"pivot": pa.array(pivot.astype(np.int32)), "angle": pa.array(angles[np.arange(len(pivot)), pivot])}
                yield pa.RecordBatch.from_pydict({n: batch.column(n) for n in batch.schema.names} | added)

        kind = written.schema[key].dataType.simpleString()
        placed = stage(written.mapInArrow(near, f"`{key}` {kind}, vector array<double>, pivot int, angle double"), "placed-directions")
        reach = placed.groupBy("pivot").agg(F.min("angle").alias("_low"), F.max("angle").alias("_high"))
        part = F.floor((F.col("angle") - F.col("_low")) / F.greatest(F.col("_high") - F.col("_low"), F.lit(1e-12)) * bands)
        banded = placed.join(F.broadcast(reach), "pivot").withColumn("band", F.least(part, F.lit(bands - 1)).cast("int")).drop("_low", "_high")
        counted = stage(banded.groupBy("pivot", "band").agg(F.min("angle").alias("low"), F.max("angle").alias("high"), F.count("*").alias("n")), "bands")
        reached = counted.orderBy("pivot", "band").toArrow()
        self.reach = Bands(self.pivots, *(reached[name].to_numpy() for name in ("pivot", "band", "low", "high", "n")))
        self.block = _bounded(block, self.width)
        self.first_part, self.n_parts = _parts(self.reach.n, self.block)
        at = pa.array(np.arange(len(self.reach.n), dtype=np.int32))
        places = pa.table({"pivot": reached["pivot"], "band": reached["band"], "at": at, "_part": self.first_part, "_parts": self.n_parts})
        spread = F.col("_part") + F.pmod(F.xxhash64(key, "vector"), F.col("_parts")).cast("int")
        self.members = banded.join(F.broadcast(written.sparkSession.createDataFrame(places)), ["pivot", "band"]).select(
            F.col(key).alias("_candidate"), F.col("vector").alias("_direction"), "at", spread.alias("part")
        )


def _bounded(rows: int, width: int | None) -> int:
    """``rows``, or as many of this width as one side of a group may have."""
    return max(1, min(rows, SIDE_BYTES // (8 * max(width or 1, 1))))


def _wanted(index: PivotIndex, queries: DataFrame, key: str, k: int, floor: bool, threshold: float) -> DataFrame:
    """(query, vector, floor, cut, parts, n_bands): the parts with the most promising bands that hold ``k`` vectors, or, with ``floor``, with all that may hold as good ones.

    The bands themselves are those whose bound is ``cut`` or more.
    """
    reach, first_part, n_parts = index.reach, index.first_part, index.n_parts
    total = int(first_part[-1] + n_parts[-1]) if len(n_parts) else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        belongs = np.zeros((len(n_parts), total), dtype=np.float32)
        for at, (low, n) in enumerate(zip(first_part, n_parts, strict=True)):
            belongs[at, low : low + n] = 1
        for batch in (b.slice(at, 1024) for b in batches for at in range(0, len(b), 1024)):
            lowest = batch.column("floor").to_numpy()
            bounds = reach.bounds(_unit(batch.column("vector")))
            cut = lowest
            if not floor and bounds.shape[1]:
                order = np.argsort(-bounds, axis=1, kind="stable")
                last = (np.cumsum(reach.n[order], axis=1) < k).sum(axis=1, keepdims=True)
                cut = np.take_along_axis(bounds, np.take_along_axis(order, np.minimum(last, bounds.shape[1] - 1), axis=1), axis=1)[:, 0]
            cut = np.maximum(cut, threshold)
            chosen = bounds >= cut[:, None]
            row, part = np.nonzero(chosen.astype(np.float32) @ belongs)
            offsets = np.searchsorted(row, np.arange(len(batch) + 1))
            yield pa.RecordBatch.from_pydict({
                key: batch.column(key), "vector": batch.column("vector"), "floor": pa.array(np.maximum(lowest, threshold)), "cut": pa.array(cut),
                "parts": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(part, pa.int32())), "n_bands": pa.array(chosen.sum(axis=1), pa.int32()),
            })

    kind = queries.schema[key].dataType.simpleString()
    return queries.mapInArrow(run, f"`{key}` {kind}, vector array<double>, floor double, cut double, parts array<int>, n_bands int")


class _Best:
    """The ``k`` best candidates so far of each of some queries."""

    def __init__(self, floor: np.ndarray, k: int, n: int) -> None:
        self.floor, self.k = floor, k
        self.similarity, self.place = np.full((len(floor), k), -np.inf), np.full((len(floor), k), n)
        self.low = floor.copy()

    def add(self, row: np.ndarray, similarity: np.ndarray, place: np.ndarray) -> None:
        """Pairs found; of equal ones the lower place is better."""
        last, latest = self.similarity[row, -1], self.place[row, -1]
        better = (similarity >= self.floor[row]) & ((similarity > last) | ((similarity == last) & (place < latest)))
        row, similarity, place = row[better], similarity[better], place[better]
        if not len(row):
            return
        touched = np.unique(row)
        row = np.concatenate([row, np.repeat(touched, self.k)])
        similarity = np.concatenate([similarity, self.similarity[touched].ravel()])
        place = np.concatenate([place, self.place[touched].ravel()])
        order = np.lexsort((place, -similarity, row))
        starts = np.searchsorted(row[order], touched)
        best = order[(starts[:, None] + np.arange(self.k)).ravel()]
        self.similarity[touched] = similarity[best].reshape(-1, self.k)
        self.place[touched] = place[best].reshape(-1, self.k)
        self.low[touched] = np.maximum(self.floor[touched], self.similarity[touched, -1])


def _cosines(left: np.ndarray, row: np.ndarray, right: np.ndarray, column: np.ndarray) -> np.ndarray:
    """Products of pairs of rows in double precision; those of equal vectors are equal, whatever they are computed with."""
    at_once = _bounded(65_536, left.shape[1])
    pieces = [slice(low, low + at_once) for low in range(0, len(row), at_once)]
    return np.concatenate([np.einsum("ij,ij->i", left[row[piece]], right[column[piece]]) for piece in pieces])


def _search(
    reach: Bands, vectors: np.ndarray, cut: np.ndarray, floor: np.ndarray, own: np.ndarray | None, directions: np.ndarray, at: np.ndarray, place: np.ndarray,
    names: np.ndarray | None, k: int, decimals: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, place, similarity) of the ``k`` best of the candidates, which lie band by band; ``own`` and ``names`` tell which ones a query leaves out."""
    slack = (vectors.shape[1] + 4) * 2.0**-23 + 10.0**-decimals
    slabs = [slice(low, min(low + COLUMNS, len(at))) for low in range(0, len(at), COLUMNS)]
    bands, first = np.unique(at, return_index=True)
    # The bands that reach into each slab.
    begin = [np.searchsorted(first, slab.start, "right") - 1 for slab in slabs]
    single = directions.astype(np.float32)
    found = []
    for start in range(0, len(vectors), ROWS):
        rows = slice(start, start + ROWS)
        queries, best = vectors[rows], _Best(floor[rows], k, len(at))
        narrow = queries.astype(np.float32)
        # The same bounds as those the parts were chosen by, but for a rounding error.
        asked = reach.bounds(queries, bands) >= cut[rows, None] - SLACK / 100
        for slab, low in zip(slabs, begin, strict=True):
            high = np.searchsorted(first, slab.stop, "left")
            here = np.flatnonzero(asked[:, low:high].any(axis=1))
            if not len(here):
                continue
            product = narrow[here] @ single[slab].T
            level = best.low[here] - slack
            near = product >= level.astype(np.float32)[:, None] - np.float32(1e-7)
            n_near = np.count_nonzero(near)
            if n_near > 4 * k * len(here) and product.shape[1] > k:
                # Whatever the others hold, only those that may be among the k best of these columns count.
                if own is not None:
                    product[own[rows][here][:, None] == names[slab]] = -np.inf
                kth = np.partition(product, product.shape[1] - k, axis=1)[:, product.shape[1] - k]
                near &= product >= kth[:, None] - np.float32(2 * slack + 1e-7)
                n_near = np.count_nonzero(near)
            if not n_near:
                continue
            row, column = np.nonzero(near)
            exact = _cosines(queries, here[row], directions[slab], column)
            if own is not None:
                exact[own[rows][here[row]] == names[slab][column]] = -np.inf
            best.add(here[row], np.round(exact, decimals), place[slab][column])
        row, column = np.nonzero(best.similarity > -np.inf)
        found.append((row + start, best.place[row, column], best.similarity[row, column]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _compared(index: PivotIndex, wanted: DataFrame, key: str, k: int, chunks: int, leave_out_itself: bool, decimals: int) -> DataFrame:
    """(query, candidate, similarity): the ``k`` best of each part for each of the queries that want it."""
    kinds = {name: frame.schema[name].dataType.simpleString() for name, frame in ((key, wanted), ("_candidate", index.members))}
    reach = index.reach
    chunk = F.pmod(F.xxhash64(key), F.lit(chunks)).cast("int")
    asked = wanted.select(key, "vector", "floor", "cut", F.explode("parts").alias("part"), chunk.alias("chunk"))
    offered = index.members.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))

    def block(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return pa.table({key: left[key].slice(0, 0), "_candidate": right["_candidate"].slice(0, 0), "similarity": pa.array([], pa.float64())})
        right = right.sort_by("_candidate")
        at = right["at"].to_numpy()
        order = np.argsort(at, kind="stable")
        names, directions = right["_candidate"].combine_chunks(), _unit(right["_direction"])
        own = codes = None
        if leave_out_itself:
            kinds_of_names = names.unique()
            codes = pc.index_in(names, kinds_of_names).to_numpy(zero_copy_only=False)[order]
            own = pc.index_in(left[key].combine_chunks().cast(names.type), kinds_of_names).fill_null(-1).to_numpy(zero_copy_only=False)
        row, place, similarity = _search(
            reach, _unit(left["vector"]), left["cut"].to_numpy(), left["floor"].to_numpy(), own, directions[order], at[order], order, codes, k, decimals
        )
        return pa.table({key: left[key].combine_chunks().take(pa.array(row)), "_candidate": names.take(pa.array(place)), "similarity": pa.array(similarity)})

    groups = ["part", "chunk"]
    return asked.groupBy(*groups).cogroup(offered.groupBy(*groups)).applyInArrow(
        block, f"`{key}` {kinds[key]}, _candidate {kinds['_candidate']}, similarity double"
    )


def most_similar(
    index: PivotIndex, queries: DataFrame, key: str, k: int, vector: str = "vector", query_block: int = QUERIES, leave_out_itself: bool = False,
    threshold: float = -1.0, decimals: int = DECIMALS,
) -> tuple[DataFrame, float]:
    """(query, candidate, similarity, place) of the ``k`` most similar candidates, and the share of (query, band) pairs that were compared.

    Similarities count to ``decimals``, those of ``threshold`` and more; of equal ones the lower candidate comes first. Queries need unique keys; those without a direction have no
    rows. The result is that of comparing all with all. ``leave_out_itself`` skips the candidate of the query's own key.
    """
    queries = stage(usable(queries, key, vector), "queries")
    n_bands = len(index.reach.n)
    n_queries = queries.count()
    k_found = k + 1 if leave_out_itself else k
    chunks = max(1, math.ceil(n_queries / _bounded(query_block, index.width)))
    place = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("similarity"), "_candidate"))

    def best(found: DataFrame) -> DataFrame:
        return found.where(F.col("similarity") >= threshold).withColumn("place", place).where(F.col("place") <= k)

    first = _wanted(index, queries.withColumn("floor", F.lit(-2.0)), key, k_found, False, threshold)
    found = best(_compared(index, first, key, k, chunks, leave_out_itself, decimals))
    enough = stage(found.where(F.col("place") == k).select(key, (F.col("similarity") - 2 * 10.0**-decimals).alias("floor")), "floors")
    bounded = queries.join(enough, key, "left").fillna(-2.0, ["floor"])
    wanted = stage(_wanted(index, bounded, key, k_found, True, threshold), "wanted-parts")
    share = (wanted.agg(F.sum("n_bands")).first()[0] or 0) / max(n_queries * n_bands, 1)
    compared = _compared(index, wanted, key, k, chunks, leave_out_itself, decimals)
    return best(compared).withColumnRenamed("_candidate", "candidate"), share
