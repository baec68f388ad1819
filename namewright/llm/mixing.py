"""Mixing sources to target weights by Poisson replication, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from namewright.sources.staging import stage

#: Mean of one draw; a source with a higher rate sums several independent draws.
DRAW_MEAN = 32.0
#: Terms of the distribution function; beyond them lies less than 1e-30 of a mean of 32.
TERMS = 128


def tempered_targets(documents: DataFrame, source_column: str = "source", power: float = 0.5) -> DataFrame:
    """(source, weight): the sources' row counts raised to ``power`` (1 as they are, 0 all equal)."""
    counts = documents.groupBy(F.col(source_column).alias("source")).agg(F.count("*").alias("n"))
    return counts.select("source", F.pow(F.col("n"), F.lit(power)).alias("weight"))


def mix_sources(
    documents: DataFrame,
    targets: DataFrame,
    size: float = 1.0,
    seed: int = 7,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
) -> DataFrame:
    """Repeats each document a Poisson number of times, so that sources reach their target weights.

    ``targets`` has (source, weight), one row a source; weights need not add up to 1. The mean of a
    document's count is ``size * rows * weight share / rows of its source``, so that about ``size * rows`` rows come out.
    The count inverts the Poisson distribution at a uniform number hashed from seed, id, source and text: a
    rerun or a recomputed task repeats it, and no state is shared between documents. The copies then go to random
    partitions and a random order within them, ``shuffle_key``.

    Returns the input columns and ``copy`` (from 0), ``shuffle_key``; input columns of these names are replaced. Sources without a positive weight
    in ``targets`` yield nothing; targets without documents don't count. A null source is a source of its own, matched by a
    null target. Null ids, sources and texts hash as empty ones; equal rows get equal counts. An empty table stays empty.
    """
    columns = [c for c in documents.columns if c not in ("copy", "shuffle_key")]
    counts = documents.groupBy(F.col(source_column).alias("_source")).agg(F.count("*").alias("_n"))
    rates = counts.join(
        targets.where("weight > 0").select(F.col("source").alias("_target"), F.col("weight").cast("double").alias("_weight")),
        F.col("_source").eqNullSafe(F.col("_target")),
    ).drop("_target")
    weights, rows = rates.agg(F.sum("_weight")).scalar(), counts.agg(F.sum("_n")).scalar()
    rate = F.lit(float(size)) * rows * (F.col("_weight") / weights) / F.col("_n")
    rates = rates.withColumn("_rate", rate)
    draws = F.greatest(F.ceil(F.col("_rate") / DRAW_MEAN), F.lit(1)).cast("int")
    rates = rates.withColumn("_draws", draws).select(
        "_source", "_draws", poisson_cdf(F.col("_rate") / F.col("_draws")).alias("_cdf")
    )
    rates = stage(rates, "rates")

    def hashed() -> Column:
        parts = [F.lit(str(seed)), *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (id_column, source_column)), F.md5(F.coalesce(F.col(text_column), F.lit("")))]
        return F.md5(F.concat_ws(":", *parts))

    keyed = documents.select(F.struct(*columns).alias("_whole"), F.col(source_column).alias("_own"), hashed().alias("_hash"))
    drawn = keyed.join(rates, F.col("_own").eqNullSafe(F.col("_source")))
    draws = F.transform(
        F.sequence(F.lit(0), F.col("_draws") - 1), lambda draw: uniform(F.md5(F.concat_ws(":", "_hash", draw.cast("string"))))
    )
    count = F.aggregate(draws, F.lit(0), lambda total, u: total + F.size(F.filter("_cdf", lambda p: p <= u)))
    copies = (
        drawn.withColumn("_count", count).where("_count > 0")
        .withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("_count") - 1)))
        .withColumn("shuffle_key", F.md5(F.concat_ws(":", F.lit("order"), "_hash", F.col("copy").cast("string"))))
    )
    return copies.select("_whole.*", "copy", "shuffle_key").repartition("shuffle_key").sortWithinPartitions("shuffle_key")


def uniform(hashed: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of a hexadecimal hash."""
    return F.conv(F.substring(hashed, 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def poisson_cdf(mean: Column) -> Column:
    """P(X <= k) for k from 0 to TERMS - 1; as many of them as do not exceed u is the inverse at u."""
    first = F.exp(-mean)
    start = F.struct(first.alias("p"), first.alias("sum"), F.array(first).alias("cdf"))

    def grow(state: Column, k: Column) -> Column:
        p = state["p"] * mean / k
        total = state["sum"] + p
        return F.struct(p.alias("p"), total.alias("sum"), F.array_append(state["cdf"], total).alias("cdf"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(TERMS - 1)), start, grow)["cdf"]
