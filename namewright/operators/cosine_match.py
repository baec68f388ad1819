"""Best candidate per vector by cosine similarity, as block-wise matrix products."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from namewright.operators.cosine_search import PivotIndex, most_similar
from namewright.sources.staging import stage

BROADCAST_ROWS = 20_000
BROADCAST_BYTES = 64 * 1024 * 1024
CANDIDATE_BLOCK = 4_096
QUERY_BLOCK = 32_768
PRODUCT_ROWS = 512
DECIMALS = 12


def _unit_rows(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors scaled to length 1; null, empty and all-zero ones become zero rows.

    Any other width is an error: there is no cosine between vectors of different width.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    rows = np.zeros((len(column), width))
    lengths = np.asarray(column.value_lengths().fill_null(0))
    if width and (wrong := set(lengths[lengths > 0]) - {width}):
        raise ValueError(f"vectors of width {width} and {wrong.pop()} can't be compared")
    filled = (lengths > 0) & (lengths == width)
    if width and filled.any():
        values = np.asarray(column.filter(pa.array(filled)).flatten(), dtype=np.float64)
        rows[filled] = values.reshape(-1, width)
    norms = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, norms, out=rows, where=norms > 0)


def _in_rank_order(candidates: pa.Table, width: int) -> tuple[pa.Table, np.ndarray]:
    names = [n for n in candidates.column_names if n not in ("rank", "vector")]
    table = candidates.sort_by([(n, "ascending") for n in ("rank", *names)])
    return table.drop_columns(["vector"]), _unit_rows(table["vector"], width)


def _size(candidates: DataFrame) -> tuple[int, int]:
    """Number of candidates and their one width, 0 if none has a vector."""
    size = F.when(F.size("vector") > 0, F.size("vector"))
    row = candidates.agg(F.count("*").alias("n"), F.min(size).alias("low"), F.max(size).alias("high")).first()
    if row["low"] != row["high"]:
        raise ValueError(f"vectors of width {row['low']} and {row['high']} can't be compared")
    return row["n"], row["high"] or 0


def _best(
    queries: pa.RecordBatch | pa.Table, candidates: pa.Table, matrix: np.ndarray, threshold: float
) -> pa.Table:
    """Query columns, columns of the best candidate and the similarity, from ``threshold`` up."""
    vectors = _unit_rows(queries.column("vector"), matrix.shape[1])
    best = np.zeros(len(vectors), dtype=np.int64)
    similarity = np.full(len(vectors), -np.inf)
    for start in range(0, len(vectors) if len(matrix) else 0, PRODUCT_ROWS):
        rows = slice(start, start + PRODUCT_ROWS)
        # Rounded, so that equal vectors tie and a vector is exactly 1.0 close to itself.
        product = np.round(vectors[rows] @ matrix.T, DECIMALS)
        best[rows] = product.argmax(axis=1)
        similarity[rows] = product.max(axis=1)
    kept = similarity >= threshold
    names = [n for n in queries.schema.names if n != "vector"]
    columns = {n: queries.column(n).filter(pa.array(kept)) for n in names}
    taken = candidates.take(pa.array(best[kept]))
    columns |= {n: taken[n] for n in taken.column_names}
    return pa.table(columns | {"similarity": similarity[kept]})


def _indexed(queries: DataFrame, candidates: DataFrame, threshold: float, candidate_block: int, query_block: int) -> DataFrame:
    """``cosine_matches`` of a threshold above 0 through an index. Numbers in the order of ranks stand for the candidates."""
    order = [n for n in candidates.columns if n not in ("rank", "vector")]
    numbered = stage(candidates.orderBy("rank", *order).withColumn("_candidate", F.monotonically_increasing_id()), "numbered-candidates")
    asked = stage(queries.withColumn("_query", F.monotonically_increasing_id()), "queries")
    index = PivotIndex(numbered, "_candidate", block=candidate_block)
    found, _ = most_similar(index, asked, "_query", 1, query_block=query_block, threshold=threshold, decimals=DECIMALS)
    payload = numbered.drop("vector").withColumnRenamed("_candidate", "candidate")
    return found.join(asked.drop("vector"), "_query").join(payload, "candidate")


def cosine_matches(
    queries: DataFrame,
    candidates: DataFrame,
    threshold: float,
    broadcast_rows: int = BROADCAST_ROWS,
    candidate_block: int = CANDIDATE_BLOCK,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """The best candidate of each query whose cosine similarity reaches ``threshold``.

    Both sides have a ``vector``; ``queries`` are distinct rows, ``candidates`` carry a ``rank``,
    the lowest of which wins a tie. Filtering before or after choosing the best is the same,
    since the choice is by similarity. Result: the query's columns, the candidate's columns and
    ``similarity``; vectors are left out.

    Spark has no cosine built in, and a matrix product in numpy is far cheaper than one expression
    per pair. Candidates are staged and counted. Up to ``broadcast_rows`` of them and 64 MB of vectors go to
    the executors as one matrix and queries stream past it without a shuffle. Beyond that, an index of pivots and bands
    (``cosine_search``) leaves out what can't reach the threshold or the best so far. With a threshold of 0 or less, where
    every pair counts, both sides are cut into blocks of bounded size, every pair of blocks meets in one co-group and yields one row per
    query, and the best of these is aggregated. All ways answer alike: all vectors must have one
    width, otherwise it is an error. Null, empty and all-zero vectors have similarity 0 to all.
    """
    spark = queries.sparkSession
    names = [f for f in queries.schema.fields if f.name != "vector"]
    added = [f for f in candidates.schema.fields if f.name != "vector"]
    schema = StructType(names + added).add("similarity", DoubleType())

    candidates = stage(candidates, "candidates")
    n_candidates, width = _size(candidates)
    if n_candidates <= broadcast_rows and n_candidates * width * 8 <= BROADCAST_BYTES:
        shared = spark.sparkContext.broadcast(_in_rank_order(candidates.toArrow(), width))

        def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield from _best(batch, *shared.value, threshold).to_batches()

        return queries.mapInArrow(stream, schema)

    if threshold > 0:
        return _indexed(queries, candidates, threshold, candidate_block, query_block).select(*schema.names)

    queries = stage(queries, "queries")
    query_blocks = max(1, math.ceil(queries.count() / query_block))
    candidate_blocks = max(1, math.ceil(n_candidates / candidate_block))
    key = [f.name for f in names]
    placed = queries.withColumn(
        "_query_block", F.pmod(F.xxhash64(*key), F.lit(query_blocks))
    ).withColumn("_candidate_block", F.explode(F.sequence(F.lit(0), F.lit(candidate_blocks - 1))))
    offered = candidates.withColumn(
        "_candidate_block", F.pmod(F.xxhash64(*[f.name for f in added]), F.lit(candidate_blocks))
    ).withColumn("_query_block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))

    def block_product(left: pa.Table, right: pa.Table) -> pa.Table:
        own = left.drop_columns(["_query_block", "_candidate_block"])
        other = right.drop_columns(["_query_block", "_candidate_block"])
        return _best(own, *_in_rank_order(other, width), threshold)

    blocks = ["_query_block", "_candidate_block"]
    found = placed.groupBy(*blocks).cogroup(offered.groupBy(*blocks)).applyInArrow(
        block_product, schema
    )
    fields = [f.name for f in added]
    order = F.struct(-F.col("similarity"), F.col("rank"), *[c for c in fields if c != "rank"])
    best = F.min_by(F.struct(*fields, "similarity"), order)
    return found.groupBy(*key).agg(best.alias("_best")).select(*key, "_best.*")
