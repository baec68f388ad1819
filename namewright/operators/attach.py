"""Left join of rows to per-key results that stays even when one key holds most of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from namewright.sources.staging import stage

ROWS_PER_SPLIT = 1_000_000


def attach(
    rows: DataFrame,
    results: DataFrame,
    counts: DataFrame,
    key: str,
    rows_per_split: int = ROWS_PER_SPLIT,
) -> DataFrame:
    """``rows LEFT JOIN results USING (key)``, hot keys spread over several join partitions.

    ``results`` has one row per key, ``counts`` the columns (key, n_rows) of ``rows``. A key with
    more than ``rows_per_split`` rows is split: its rows are dealt to ``n_rows / rows_per_split``
    salts and its one result row is repeated per salt. Rows without a key meet no result; each gets
    a salt of its own. Hot keys travel as 8-byte hashes and are staged, so Spark knows their size and
    broadcasts them or not by its own threshold. A hash collision only adds salts, on both sides alike.
    """
    hot = (
        counts.where(F.col("n_rows") > rows_per_split)
        .groupBy(F.xxhash64(key).alias("_hash"))
        .agg(F.max(F.ceil(F.col("n_rows") / rows_per_split)).alias("_salts"))
    )
    hot = stage(hot, "hot-keys")
    # The salt depends on content and partition alone, so a recomputed task deals rows alike.
    hashable = [f.name for f in rows.schema.fields if "map" not in f.dataType.simpleString()]
    row_hash = F.xxhash64(F.spark_partition_id(), *hashable)
    salts = F.coalesce("_salts", F.lit(1))
    salt = F.when(F.col(key).isNull(), row_hash).when(salts > 1, F.pmod(row_hash, salts)).otherwise(0)
    dealt = (
        rows.withColumn("_hash", F.xxhash64(key))
        .join(hot, "_hash", "left")
        .withColumn("_salt", salt)
        .drop("_hash", "_salts")
    )
    repeated = (
        results.where(F.col(key).isNotNull())
        .withColumn("_hash", F.xxhash64(key))
        .join(hot, "_hash", "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), salts - 1)))
        .drop("_hash", "_salts")
    )
    joined = dealt.join(repeated, [key, "_salt"], "left")
    added = [c for c in results.columns if c != key]
    return joined.select(*rows.columns, *added)
