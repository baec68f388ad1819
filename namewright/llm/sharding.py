"""Shards of nearly equal bytes through fixed virtual slots and a versioned slot-to-shard map."""

from __future__ import annotations

import heapq
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from namewright.llm.numbering import ROWS_PER_PART, number_within
from namewright.sources.staging import run_folder, stage

SLOTS = 8192
#: Bytes of a record besides its text.
OVERHEAD = 8
#: A slot heavier than 1 / HEAVY of a shard's fair share is dealt out in portions of half that.
HEAVY = 8
#: Share of a shard that is placed anew at each edit, in its smallest slots.
FINE = 64

MAP_SCHEMA = "version int, slot int, portion long, shard int, rows long, bytes long, first long"

Unit = tuple[int, int]


def shard_documents(
    documents: DataFrame,
    shards: int = 24,
    id_column: str = "doc_id",
    text_column: str = "text",
    slots: int = SLOTS,
    map_path: str | None = None,
    rows_per_part: int = ROWS_PER_PART,
) -> DataFrame:
    """Deals records to shards by bytes; returns one row per input row.

    Columns: id, size, text_crc32, virtual_slot, portion, shard, place (gapless from 0 within the shard).
    A record hashes by id and text to one of ``slots`` fixed slots. Rows and bytes are summed per
    slot, and the map from slots to shards is a small table whose versions are kept in
    ``map_path`` (by default in the shared folder): version 1 deals slots out in turn, each later
    one is an edit of the one before that moves as few slots as level the bytes. A further call with the same path
    rebalances from the newest version, whose number of shards may also change.

    A slot that weighs more than an eighth of a shard (a record repeated very often) is dealt
    out in portions by its rows' numbers. Only the map, ``slots`` rows and at most 16 more per
    shard, is on the driver or broadcast; texts are never shuffled.

    A null text has no bytes (size 8, checksum 0). Null ids hash by text. Repeated rows stay rows. Shards
    may be empty when there are fewer records than shards. A single record larger than a shard's share can't be split.
    """
    spark = documents.sparkSession
    text = F.encode(F.coalesce(F.col(text_column).cast("string"), F.lit("")), "UTF-8")
    records = documents.select(
        F.col(id_column).alias("_id"), (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.pmod(F.xxhash64(F.col(id_column), text), F.lit(slots)).cast("int").alias("slot"),
        F.spark_partition_id().alias("_part"),
    )
    records = stage(records, "records")
    weights = records.groupBy("slot").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))
    total = records.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("bytes")).first()["bytes"]
    limit = max(total // (shards * HEAVY), 1)
    portions = F.when(F.col("bytes") > limit, F.ceil(2 * F.col("bytes") / limit)).otherwise(1).cast("long")
    weights = stage(weights.withColumn("portions", F.least(portions, F.col("n"))), "slots")

    numbered = number_within(records, "slot", ["_id", "size", "text_crc32"], weights.select("slot", "n"), "_place", rows_per_part)
    numbered = numbered.join(F.broadcast(weights.select("slot", "portions")), "slot").withColumn(
        "portion", F.col("_place") % F.col("portions")
    )
    numbered = stage(numbered.withColumn("_place", F.floor(F.col("_place") / F.col("portions"))), "numbered")
    units = numbered.groupBy("slot", "portion").agg(F.count("*").alias("rows"), F.sum("size").alias("bytes")).collect()
    sizes = {(u["slot"], u["portion"]): (u["rows"], u["bytes"]) for u in units}
    placed = next_map(spark, map_path or f"{run_folder(spark)}/slot-map-{uuid.uuid4().hex}", sizes, shards, slots)
    placed = placed.select("slot", "portion", "shard", "first")
    return numbered.join(F.broadcast(placed), ["slot", "portion"]).select(
        F.col("_id").alias(id_column), "size", "text_crc32", F.col("slot").alias("virtual_slot"), "portion", "shard",
        (F.col("first") + F.col("_place")).alias("place"),
    )


def next_map(
    spark: SparkSession, path: str, sizes: dict[Unit, tuple[int, int]], shards: int, slots: int
) -> DataFrame:
    """Append the next version of the map to ``path`` and return its rows.

    The new version is an edit of the newest one; the first is an edit of slots dealt out in turn, stored as version 1.
    """
    fits = spark._jvm.org.apache.hadoop.fs.Path(path)
    exists = fits.getFileSystem(spark._jsc.hadoopConfiguration()).exists(fits)
    before = {}
    version = 0
    if exists:
        known = spark.read.schema(MAP_SCHEMA).parquet(path)
        version = known.agg(F.max("version").alias("v")).first()["v"] or 0
        before = {(r["slot"], r["portion"]): r["shard"] for r in known.where(F.col("version") == version).collect()}
    if not version:
        before = {unit: unit[0] % shards for unit in sizes} | {(s, 0): s % shards for s in range(slots)}
        version = 1
        _append(spark, path, version, before, sizes, slots)
    after = rebalance(before, {u: b for u, (_, b) in sizes.items()}, shards)
    after |= {(s, 0): after.get((s, 0), before.get((s, 0), s) % shards) for s in range(slots)}
    _append(spark, path, version + 1, after, sizes, slots)
    return spark.read.schema(MAP_SCHEMA).parquet(path).where(F.col("version") == version + 1)


def _append(spark, path: str, version: int, placed: dict[Unit, int], sizes, slots: int) -> None:
    first: dict[int, int] = {}
    rows = []
    for unit in sorted(placed):
        shard, (n, size) = placed[unit], sizes.get(unit, (0, 0))
        rows.append((version, *unit, shard, n, size, first.get(shard, 0)))
        first[shard] = first.get(shard, 0) + n
    spark.createDataFrame(rows, MAP_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def rebalance(before: dict[Unit, int], sizes: dict[Unit, int], shards: int) -> dict[Unit, int]:
    """Edit a map: units leave shards above the mean and go, largest first, to the lightest shard.

    A full shard gives up the largest units that don't take it below the mean, then one more. Every shard gives up its smallest
    units, 1 / FINE of the mean, which level the rest. Units of shards that no longer exist, or new to the map, are placed anew.
    """
    mean = sum(sizes.values()) / shards
    held: list[list[Unit]] = [[] for _ in range(shards)]
    loose = []
    for unit in sorted(sizes):
        at = before.get(unit, shards)
        (held[at] if at < shards else loose).append(unit)
    for units in held:
        load = sum(sizes[u] for u in units)
        stay = []
        for unit in sorted(units, key=lambda u: (-sizes[u], u)):
            if load - sizes[unit] >= mean:
                load -= sizes[unit]
                loose.append(unit)
            else:
                stay.append(unit)
        if load > mean and stay:
            load -= sizes[stay[-1]]
            loose.append(stay.pop())
        rest = load - mean / FINE
        while stay and load - sizes[stay[-1]] >= rest:
            load -= sizes[stay[-1]]
            loose.append(stay.pop())
        units[:] = stay
    loads = [(sum(sizes[u] for u in units), at) for at, units in enumerate(held)]
    heapq.heapify(loads)
    for unit in sorted(loose, key=lambda u: (-sizes[u], u)):
        load, at = heapq.heappop(loads)
        held[at].append(unit)
        heapq.heappush(loads, (load + sizes[unit], at))
    return {unit: at for at, units in enumerate(held) for unit in units}
