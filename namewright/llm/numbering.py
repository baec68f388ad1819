"""Gapless numbers within a key, also for a key that holds most rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows of one key that one task sorts, about.
ROWS_PER_PART = 100_000


def number_within(
    rows: DataFrame, key: str, order: list[str], counts: DataFrame, name: str, rows_per_part: int = ROWS_PER_PART
) -> DataFrame:
    """Adds ``name``: 0, 1, ... within each value of ``key``.

    ``rows`` must be a written table (it is read more than once) with a column ``_part``, the
    partition that wrote the row, which spreads even equal rows; ``counts`` has (key, n) and as
    many rows as the key has values, a bound that the caller's parameters set. Rows of a key are
    dealt to parts of about ``rows_per_part``, numbered there, and moved by the sizes of the parts before.
    """
    parts = counts.select(key, F.ceil(F.col("n") / rows_per_part).alias("_parts"))
    dealt = rows.join(F.broadcast(parts), key).withColumn(
        "_sub", F.pmod(F.xxhash64("_part", *order), F.col("_parts"))
    )
    place = F.row_number().over(Window.partitionBy(key, "_sub").orderBy(*order)) - 1
    sizes = dealt.groupBy(key, "_sub").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(key).orderBy("_sub")) - F.col("_n")
    return (
        dealt.withColumn("_spot", place)
        .join(sizes.select(key, "_sub", before.alias("_before")), [key, "_sub"])
        .withColumn(name, F.col("_before") + F.col("_spot"))
        .drop("_sub", "_parts", "_spot", "_before")
    )
