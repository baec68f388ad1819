"""Near-duplicate documents: consistent weighted sampling over TF-IDF shingles, banded and verified."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from namewright.llm.components import components, merge
from namewright.llm.words import Words, grams, mix, short_grams, words
from namewright.sources.staging import stage

#: Buckets of the document frequencies. Their error is a share of all documents (shingles per
#: document / buckets), the same at every size, and lies below RARE for texts of ordinary length.
FREQUENCY_BUCKETS = 1 << 18
#: Share of the documents from which on a shingle loses weight; rarer ones all weigh the same.
RARE = 1 / 250
#: A shingle in every document weighs 1, a rare one 1 + DAMPING. The inverse frequency is damped so
#: that what a large group of near copies shares still outweighs what tells them apart.
DAMPING = 0.25
BANDS, ROWS = 12, 3
#: Limits of a block of a bucket; a tile holds two blocks.
BLOCK_ROWS, BLOCK_BYTES = 512, 4 << 20
#: Columns of one matrix product.
SLAB = 1024

_QUANTILES = 1 << 16


@dataclass(frozen=True)
class Settings:
    words: int = 5
    threshold: float = 0.8
    bands: int = BANDS
    rows: int = ROWS
    block_rows: int = BLOCK_ROWS
    block_bytes: int = BLOCK_BYTES


def near_dedup(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    settings: Settings = Settings(),
) -> DataFrame:
    """Groups documents whose weighted Jaccard similarity reaches the threshold, chains included.

    Returns one row per input row: (id, n_shingles, component_id, kept). ``component_id`` is the
    smallest id of the group; exactly one row of a group is kept, one with that id. Ids are cast to long.

    Words are runs of letters and digits (every non-ASCII character counts as a letter), A-Z as a-z.
    A document is the set of its shingles of five words; one of fewer words is a single shingle. A
    shingle weighs ``(1 + ln count) * idf``. The similarity of two documents is the sum of the
    smaller weights over the sum of the larger ones.

    1. Document frequencies: a count per hash bucket over all documents, a fixed table.
    2. One pass makes, per document, 36 consistent weighted samples (Ioffe 2010): two documents
       agree in one with a probability equal to their similarity. Three samples make a band.
    3. Equal texts are collapsed. Distinct texts that share a band form a bucket; buckets with the same
       members are taken once. A pair at the threshold shares a band with probability 0.9998.
    4. Buckets are verified where they lie: all pairs of a tile at once as a matrix product over the
       shingles that at least two of its texts have, whole texts, without sampling. A tile returns a
       spanning forest of its links, never pairs. Large buckets are cut into tiles of bounded size.
    5. Connected components join the links; copies follow their text.

    Null and empty texts, and texts without a word, are equal only to the same text (null equals null).
    A null id is larger than all others. Repeated rows are copies of each other. Other columns are ignored.
    """
    grouped = _grouped(documents, id_column, text_column, settings)
    return grouped.select(
        F.col("_id").alias(id_column), F.col("_shingles").alias("n_shingles"),
        F.nullif(F.col("_best.id"), F.lit(2**63 - 1)).alias("component_id"), "kept",
    )


def near_unique(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    settings: Settings = Settings(),
) -> DataFrame:
    """The documents, all columns, of which ``near_dedup`` keeps one of each group.

    Rows of the same id and text are first reduced to one, before the shuffle within each task, so a crowd of copies is not one task's
    work; the shuffle by id and text then serves the join as well. Of repeated rows that differ in other columns any one stays.
    """
    number = F.coalesce("_id", F.lit(2**63 - 1)).alias("_id")
    named = ["_id", "_key1", "_key2"]
    kept = _grouped(documents, id_column, text_column, settings).where("kept").select(number, "_key1", "_key2")
    keyed = documents.select(
        F.struct(*documents.columns).alias("_whole"), F.col(id_column).cast("long").alias("_id"), F.col(text_column).cast("string").alias("_text")
    )
    keyed = keyed.withColumns(_text_keys()).select("_whole", number, "_key1", "_key2")
    return keyed.dropDuplicates(named).join(kept, named, "left_semi").select("_whole.*")


def _grouped(documents: DataFrame, id_column: str, text_column: str, settings: Settings) -> DataFrame:
    """(_id, _shingles, _key1, _key2, _best, kept) of every row."""
    rows = documents.select(
        F.col(id_column).cast("long").alias("_id"), F.col(text_column).cast("string").alias("_text")
    )
    rows = rows.withColumns(_text_keys())
    weights = _weights(rows, settings)
    signed = rows.mapInArrow(
        lambda batches: _sign(batches, weights, settings),
        "_id long, _key1 long, _key2 long, _bytes long, _shingles long, _bands array<long>",
    )
    signed = stage(signed.withColumn("_row", F.monotonically_increasing_id()), "signatures")

    lowest = F.min(F.struct(F.coalesce("_id", F.lit(2**63 - 1)).alias("id"), F.col("_row").alias("row")))
    texts = stage(signed.groupBy("_key1", "_key2").agg(lowest.alias("_first")), "distinct-texts")
    links = stage(_links(rows, signed, texts, weights, settings), "text-links")
    found = components(links)

    placed = (
        texts.withColumn("_row", F.col("_first.row")).join(found.withColumnRenamed("id", "_row"), "_row", "left")
        .select("_key1", "_key2", "_first", F.coalesce("component", "_row").alias("_component"))
    )
    placed = stage(placed, "placed-texts")
    best = placed.groupBy("_component").agg(F.min("_first").alias("_best"))
    placed = placed.join(best, "_component").select("_key1", "_key2", "_best")
    return signed.join(placed, ["_key1", "_key2"]).select(
        "_id", "_shingles", "_key1", "_key2", "_best", (F.col("_row") == F.col("_best.row")).alias("kept")
    )


def _text_keys() -> dict:
    """128 bits of hash; null differs from the empty text."""
    null = F.col("_text").isNull()
    return {"_key1": F.xxhash64(null, "_text"), "_key2": F.xxhash64(F.lit("second"), null, "_text")}


# Weights

def _weights(rows: DataFrame, settings: Settings) -> np.ndarray:
    """The idf of each frequency bucket; at most FREQUENCY_BUCKETS rows reach the driver."""
    counted = rows.select("_text").mapInArrow(
        lambda batches: _count_shingles(batches, settings.words), "bucket int, n long"
    )
    counts = counted.groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    total = np.zeros(FREQUENCY_BUCKETS + 1)
    total[counts["bucket"].to_numpy(dtype=np.int64)] = counts["n"].to_numpy()
    documents = max(total[-1], 1.0)
    share = np.clip(total[:-1] / documents, RARE, 1.0)
    return (1 + DAMPING * np.log(share) / math.log(RARE)).astype(np.float32)


def _count_shingles(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    total = np.zeros(FREQUENCY_BUCKETS + 1, dtype=np.int64)
    for batch in batches:
        total[-1] += len(batch)
        for part in words(batch.column(0)):
            _, ids, _ = shingles(part, k)
            total[:-1] += np.bincount(_bucket(ids), minlength=FREQUENCY_BUCKETS)
    filled = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays(
        [pa.array(filled.astype(np.int32)), pa.array(total[filled])], names=["bucket", "n"]
    )


def _bucket(ids: np.ndarray) -> np.ndarray:
    return (mix(ids) >> np.uint64(46)).astype(np.int64)


def shingles(part: Words, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, 44-bit id and count of each row's distinct shingles, sorted by row."""
    rolled, whole = grams(part, k)
    is_short = (part.counts > 0) & (part.counts < k)
    short = part.begins[:-1][is_short]
    rolled[short] = short_grams(part.hashes, short, part.counts[is_short])
    whole[short] = True
    rows = np.repeat(np.arange(len(part.counts), dtype=np.uint64), part.counts)
    keys = np.sort((rows[whole] << np.uint64(44)) | (rolled[whole] >> np.uint64(20)))
    new = np.ones(len(keys), dtype=bool)
    new[1:] = keys[1:] != keys[:-1]
    first = np.flatnonzero(new)
    counts = np.diff(first, append=len(keys))
    keys = keys[first]
    return (keys >> np.uint64(44)).astype(np.int64), keys & np.uint64((1 << 44) - 1), counts


# Consistent weighted samples

def _gamma_quantiles() -> np.ndarray:
    """Quantiles of the gamma distribution of shape 2, by bisection of 1 - exp(-x) (1 + x)."""
    wanted = (np.arange(_QUANTILES) + 0.5) / _QUANTILES
    low, high = np.zeros(_QUANTILES), np.full(_QUANTILES, 40.0)
    for _ in range(60):
        middle = (low + high) / 2
        below = -np.expm1(-middle) - middle * np.exp(-middle) < wanted
        low, high = np.where(below, middle, low), np.where(below, high, middle)
    return (low + high) / 2


class Sampler:
    """``n`` independent samples; the random numbers of a shingle depend on the shingle alone."""

    def __init__(self, n: int) -> None:
        quantiles = _gamma_quantiles()
        self.r = quantiles.astype(np.float32)
        self.per_r = (1 / quantiles).astype(np.float32)
        self.log_c = np.log(quantiles).astype(np.float32)
        self.seeds = mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    def __call__(self, begins: np.ndarray, ids: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """(n, rows) codes of the sampled (shingle, step); each row from begins[i] to begins[i + 1] is filled."""
        logs = np.log(weights).astype(np.float32)
        places = np.arange(len(ids), dtype=np.uint64)
        out = np.empty((len(self.seeds), len(begins) - 1), dtype=np.uint64)
        for k, seed in enumerate(self.seeds):
            bits = mix(ids ^ seed)
            first, second = (bits & np.uint64(0xFFFF)).astype(np.intp), ((bits >> np.uint64(16)) & np.uint64(0xFFFF)).astype(np.intp)
            beta = (bits >> np.uint64(32)).astype(np.float32) * np.float32(2.0**-32)
            r = self.r[first]
            step = np.floor(logs * self.per_r[first] + beta)
            # Positive, so that the bits of the float sort as the number does.
            score = self.log_c[second] - r * (step - beta) - r + np.float32(64)
            packed = (np.maximum(score, np.float32(0)).view(np.uint32).astype(np.uint64) << np.uint64(32)) | places
            chosen = (np.minimum.reduceat(packed, begins[:-1]) & np.uint64(0xFFFFFFFF)).astype(np.intp)
            out[k] = mix(ids[chosen] * np.uint64(0x100000001B3) ^ step[chosen].astype(np.int64).astype(np.uint64))
        return out


def _sign(batches: Iterator[pa.RecordBatch], weights: np.ndarray, settings: Settings) -> Iterator[pa.RecordBatch]:
    sampler = Sampler(settings.bands * settings.rows)
    for batch in batches:
        text = batch.column("_text")
        total, bands = np.zeros(len(batch), dtype=np.int64), [None] * len(batch)
        for part in words(text):
            rows, ids, counts = shingles(part, settings.words)
            if not len(rows):
                continue
            found, begins = np.unique(rows, return_index=True)
            total[part.first + found] = np.diff(begins, append=len(rows))
            weight = weights[_bucket(ids)] * (1 + np.log(counts))
            codes = sampler(np.append(begins, len(rows)), ids, weight)
            for row, keys in zip(found, _band_keys(codes, settings).T, strict=True):
                bands[part.first + row] = keys
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("_id"), batch.column("_key1"), batch.column("_key2"),
                pa.compute.cast(pa.compute.fill_null(pa.compute.binary_length(text), 0), pa.int64()),
                pa.array(total), pa.array(bands, type=pa.list_(pa.int64())),
            ],
            names=["_id", "_key1", "_key2", "_bytes", "_shingles", "_bands"],
        )


def _band_keys(codes: np.ndarray, settings: Settings) -> np.ndarray:
    keys = np.zeros((settings.bands, codes.shape[1]), dtype=np.uint64)
    for row in range(settings.rows):
        keys = mix(keys + codes[row :: settings.rows])
    return keys.view(np.int64)


# Verification

def _links(
    rows: DataFrame, signed: DataFrame, texts: DataFrame, weights: np.ndarray, settings: Settings
) -> DataFrame:
    firsts = texts.select(F.col("_first.row").alias("_row"))
    sampled = signed.where("_bands IS NOT NULL").join(firsts, "_row").select(
        "_row", "_bytes", F.posexplode("_bands").alias("_band", "_key")
    )
    sampled = stage(sampled, "bands")
    second = F.xxhash64(F.lit("second"), "_row")
    buckets = (
        sampled.groupBy("_band", "_key")
        .agg(
            F.count("*").alias("_members"), F.sum("_bytes").alias("_size"),
            F.bit_xor(F.xxhash64("_row")).alias("_set1"), F.bit_xor(second).alias("_set2"),
        )
        .where("_members > 1")
    )
    # Buckets of the same members are compared once.
    buckets = buckets.groupBy("_members", "_size", "_set1", "_set2").agg(
        F.min(F.struct("_band", "_key")).alias("_bucket")
    )
    blocks = F.ceil(F.greatest(F.col("_members") / settings.block_rows, F.col("_size") / settings.block_bytes))
    buckets = buckets.select("_bucket._band", "_bucket._key", F.greatest(blocks, F.lit(1)).alias("_blocks"))
    members = (
        sampled.join(buckets, ["_band", "_key"])
        .withColumn("_block", F.pmod(F.xxhash64(F.lit("block"), "_row"), F.col("_blocks")))
        .withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)))
        .select(
            "_row", "_band", "_key", "_block", F.least("_block", "_other").alias("_low"),
            F.greatest("_block", "_other").alias("_high"),
        )
    )
    members = stage(members, "bucket-members")
    needed = _texts_of(rows, signed, members)
    tiles = members.join(needed, "_row").groupBy("_band", "_key", "_low", "_high")
    return tiles.applyInPandas(lambda pdf: _verify(pdf, weights, settings), "src long, dst long")


def _texts_of(rows: DataFrame, signed: DataFrame, members: DataFrame) -> DataFrame:
    """(_row, _text), once for each row in ``members``: repeats of its id and text fall away before they meet the tiles."""
    keys = signed.join(members.select("_row").distinct(), "_row").select("_row", "_id", "_key1", "_key2")
    same = [F.col("d._key1") == F.col("k._key1"), F.col("d._key2") == F.col("k._key2"), F.col("d._id").eqNullSafe(F.col("k._id"))]
    return rows.alias("d").join(keys.alias("k"), same).select("_row", "_text").dropDuplicates(["_row"])


def features(texts: pd.Series, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature, weight): a shingle of count c is c features whose weights add up to its own,
    so that the sum of the smaller weights of two texts is the weight of their common features."""
    column = pa.array(texts, pa.string())
    rows, ids, levels, gains = [], [], [], []
    for part in words(column):
        row, shingle, count = shingles(part, k)
        again = np.repeat(np.arange(len(row)), count)
        level = np.arange(len(again)) - np.repeat(np.cumsum(count) - count, count)
        gain = np.where(level == 0, 1.0, np.log(level + 1) - np.log(np.maximum(level, 1)))
        rows.append(row[again] + part.first)
        ids.append(shingle[again])
        levels.append(level)
        gains.append(gain * weights[_bucket(shingle)][again])
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0)
    code = mix(np.concatenate(ids) + np.concatenate(levels).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return np.concatenate(rows), code, np.concatenate(gains)


def similar_pairs(
    texts: pd.Series, weights: np.ndarray, settings: Settings, first: np.ndarray, second: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (one in ``first``, one in ``second``) of all pairs at or above the threshold."""
    row, code, gain = features(texts, weights, settings.words)
    total = np.bincount(row, weights=gain, minlength=len(texts))
    column, counts = np.unique(code, return_inverse=True, return_counts=True)[1:]
    shared = counts[column] > 1
    row, column, gain = row[shared], np.unique(column[shared], return_inverse=True)[1], gain[shared]
    common = np.zeros((len(first), len(second)))
    order = np.argsort(column, kind="stable")
    row, column, gain = row[order], column[order], gain[order]
    width = int(column[-1]) + 1 if len(column) else 0
    for at in range(0, width, SLAB):
        low, high = np.searchsorted(column, [at, at + SLAB])
        block = np.zeros((len(texts), min(SLAB, width - at)), dtype=np.float64)
        block[row[low:high], column[low:high] - at] = np.sqrt(gain[low:high])
        used = block.any(axis=1)
        a, b = np.flatnonzero(used[first]), np.flatnonzero(used[second])
        common[np.ix_(a, b)] += block[first[a]] @ block[second[b]].T
    union = total[first][:, None] + total[second][None, :] - common
    i, j = np.nonzero(common >= settings.threshold * union - 1e-9)
    yield first[i], second[j]


def _verify(pdf: pd.DataFrame, weights: np.ndarray, settings: Settings) -> pd.DataFrame:
    pdf = pdf.drop_duplicates("_row", ignore_index=True)
    low, high, block = pdf["_low"].iloc[0], pdf["_high"].iloc[0], pdf["_block"].to_numpy()
    first, second = np.flatnonzero(block == low), np.flatnonzero(block == high)
    root = np.arange(len(pdf))
    for i, j in similar_pairs(pdf["_text"], weights, settings, first, second):
        merge(root, i, j)
    joined = np.flatnonzero(root != np.arange(len(pdf)))
    ids = pdf["_row"].to_numpy()
    return pd.DataFrame({"src": ids[joined], "dst": ids[root[joined]]})
