"""Near-duplicate vectors: int8 tile products with error bounds, exact cosines near the threshold."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from namewright.llm.components import components, merge
from namewright.sources.staging import stage

#: Rows of a block; a tile holds two blocks, and is compared in slabs of SLAB rows.
BLOCK_ROWS = 2048
SLAB = 256
#: Candidate pairs recomputed at once.
PAIRS = 1 << 15
#: Slack for the rounding of double arithmetic, far above it and far below the quantisation error.
SLACK = 1e-9


def embedding_dedup(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    group_column: str = "label",
    threshold: float = 0.98,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Links vectors of equal group whose cosine is at least ``threshold``; one row per input row.

    Returns (id, n_links, component_id, kept), ids cast to long. Every vector is scaled to length 1 and quantised to
    int8; the Euclidean length of what the rounding left over is kept with it. For a pair, the
    integer product and the two lengths bound the cosine from above (Cauchy-Schwarz), and only pairs
    whose bound reaches the threshold are computed again in double precision. The integer products
    of a tile of two blocks are one matrix product of whole numbers, which floats hold exactly.

    Equal vectors are collapsed first, so a crowd of copies costs one row; what is left of a group
    is dealt to blocks of about ``block_rows`` rows by hash, so a hot group becomes many tiles of
    bounded size. A tile returns, per row, the number of links and one edge of a spanning forest:
    never its pairs. The products of one group still grow with the square of its distinct vectors,
    as comparing all of them must.

    Null vectors, vectors of zeros or with null or non-finite components, and rows of a null group
    link with nothing and are their own component. Vectors of different length never link. Repeated
    rows and repeated ids count as vectors of their own. A null id stays null, is smallest of none,
    and is kept if alone in its component. Other columns are ignored.
    """
    whole = F.col("_vector")
    rows = vectors.select(
        F.col(id_column).cast("long").alias("_id"),
        F.col(group_column).alias("_group"),
        F.col(vector_column).cast("array<double>").alias("_vector"),
    )
    usable = (
        F.col("_group").isNotNull()
        & F.forall(whole, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(whole, lambda x: x != 0)
    )
    # Zeros of either sign are equal; 128 bits of hash stand for a vector.
    hashed = F.transform(whole, lambda x: F.when(x == 0, 0.0).otherwise(x))
    keys = ["_group", "_size", "_key1", "_key2"]
    rows = rows.withColumn("_usable", F.coalesce(usable, F.lit(False)))
    members = rows.where("_usable").select(
        "_id", "_group", "_vector", F.size("_vector").alias("_size"),
        F.xxhash64(hashed).alias("_key1"), F.xxhash64(F.lit("second"), hashed).alias("_key2"),
    )
    distinct = members.groupBy(*keys).agg(
        F.min("_id").alias("_lowest"), F.count("*").alias("_copies"), F.any_value("_vector").alias("_vector")
    )
    distinct = stage(distinct.withColumn("_row", F.monotonically_increasing_id()), "distinct-vectors")

    parts = stage(_tiles(distinct, threshold, block_rows), "vector-links")
    links = parts.groupBy("_row").agg(F.sum("_links").alias("_links"))
    edges = parts.where("_peer IS NOT NULL").select(F.col("_row").alias("src"), F.col("_peer").alias("dst"))
    found = components(edges)
    placed = (
        distinct.drop("_vector").join(links, "_row", "left")
        .join(found.withColumnRenamed("id", "_row"), "_row", "left")
        .withColumn("component", F.coalesce("component", "_row"))
    )
    placed = stage(placed, "placed-vectors")
    lowest = placed.groupBy("component").agg(F.min("_lowest").alias("component_id"))
    placed = placed.join(lowest, "component").select(
        *keys, (F.coalesce("_links", F.lit(0)) + F.col("_copies") - 1).alias("n_links"), "component_id"
    )
    linked = members.select("_id", *keys).join(placed, keys).select("_id", "n_links", "component_id")
    alone = rows.where("NOT _usable").select("_id", F.lit(0).cast("long").alias("n_links"), F.col("_id").alias("component_id"))
    both = linked.unionByName(alone)
    return both.select(
        F.col("_id").alias(id_column), F.col("n_links").cast("long").alias("n_links"), "component_id",
        F.col("_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def _tiles(distinct: DataFrame, threshold: float, block_rows: int) -> DataFrame:
    """(_row, _links, _peer) of every tile, for the rows that have links there."""
    blocks = distinct.groupBy("_group", "_size").agg(F.ceil(F.count("*") / block_rows).alias("_blocks"))
    dealt = distinct.join(blocks, ["_group", "_size"]).withColumn(
        "_block", F.pmod(F.xxhash64(F.lit("block"), "_row"), F.col("_blocks"))
    )
    tiles = (
        dealt.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)))
        .withColumn("_low", F.least("_block", "_other")).withColumn("_high", F.greatest("_block", "_other"))
    )
    keys = ["_group", "_size", "_low", "_high"]
    compare = lambda pdf: compare_tile(pdf, threshold)
    return tiles.select(*keys, "_row", "_copies", "_block", "_vector").groupBy(*keys).applyInPandas(
        compare, "_row long, _links long, _peer long"
    )


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Whole numbers in -127..127, scale, length of the error, length of the quantised vector."""
    scale = np.abs(unit).max(axis=1) / 127
    whole = np.rint(unit / scale[:, None]).astype(np.int8)
    near = whole * scale[:, None]
    return whole, scale, np.linalg.norm(unit - near, axis=1), np.linalg.norm(near, axis=1)


def close_pairs(
    left: np.ndarray, right: np.ndarray, threshold: float
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of all pairs with cosine >= threshold, slab by slab."""
    a, b = left / np.abs(left).max(axis=1)[:, None], right / np.abs(right).max(axis=1)[:, None]
    norm_a, norm_b = np.sqrt((a * a).sum(axis=1)), np.sqrt((b * b).sum(axis=1))
    whole_a, scale_a, error_a, _ = quantise(a / norm_a[:, None])
    whole_b, scale_b, error_b, near_b = quantise(b / norm_b[:, None])
    # 127 * 127 * width stays below 2**24 up to 1,040 components, and far below 2**53 always.
    exact = np.float32 if left.shape[1] <= 1040 else np.float64
    columns = np.ascontiguousarray(whole_b.astype(exact).T)
    for start in range(0, len(a), SLAB):
        part = slice(start, start + SLAB)
        product = whole_a[part].astype(exact) @ columns
        bound = product * scale_a[part, None] * scale_b[None, :]
        bound += error_a[part, None] * near_b[None, :] + error_b[None, :]
        rows, others = np.nonzero(bound >= threshold - SLACK)
        rows += start
        for at in range(0, len(rows), PAIRS):
            i, j = rows[at : at + PAIRS], others[at : at + PAIRS]
            cosine = np.einsum("ij,ij->i", a[i], b[j]) / (norm_a[i] * norm_b[j])
            sure = cosine >= threshold
            yield i[sure], j[sure]


def compare_tile(pdf: pd.DataFrame, threshold: float) -> pd.DataFrame:
    low, high = pdf["_low"].iloc[0], pdf["_high"].iloc[0]
    first = np.nonzero(pdf["_block"].to_numpy() == low)[0]
    second = first if low == high else np.nonzero(pdf["_block"].to_numpy() == high)[0]
    empty = pd.DataFrame({c: pd.Series(dtype="Int64") for c in ("_row", "_links", "_peer")})
    if not len(first) or not len(second):
        return empty
    matrix = np.stack(pdf["_vector"].to_numpy()).astype(np.float64)
    copies = pdf["_copies"].to_numpy()
    links, root = np.zeros(len(pdf), dtype=np.int64), np.arange(len(pdf))
    for i, j in close_pairs(matrix[first], matrix[second], threshold):
        i, j = first[i], second[j]
        if low == high:
            i, j = i[i != j], j[i != j]
        np.add.at(links, i, copies[j])
        if low != high:
            np.add.at(links, j, copies[i])
        merge(root, i, j)
    shown = np.nonzero(links)[0]
    ids = pdf["_row"].to_numpy()
    peer = pd.array(ids[root[shown]], dtype="Int64")
    peer[root[shown] == shown] = pd.NA
    return pd.DataFrame({"_row": ids[shown], "_links": links[shown], "_peer": peer})
