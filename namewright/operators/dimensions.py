"""De-duplication, vocabularies and lookups on dimension tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from namewright.functions import text


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row per key in ``order``; null keys count as one key.

    The rank filter prunes each input partition before the shuffle, so a hot key costs one row
    per partition.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn("_rank", F.row_number().over(window))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def distinct_words(words: DataFrame, column: str = "words") -> DataFrame:
    """The distinct words of a column, as correction targets ranked alphabetically."""
    return words.select(F.col(column).alias("target")).distinct()


def vocabulary(texts: DataFrame, column: str, min_count: int = 2) -> DataFrame:
    """Match tokens of ``column`` with their number of occurrences, from ``min_count`` up."""
    tokens = texts.select(F.explode(text.match_tokens(F.col(column))).alias("word"))
    counted = tokens.groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= min_count)


def first_match(df: DataFrame, matches: str = "matched_words", name: str = "matched_type") -> DataFrame:
    """Add the first of the pipe-separated ``matches``."""
    return df.withColumn(name, text.first_pipe_word(F.col(matches)))


def lookup_level(df: DataFrame, keywords: DataFrame) -> DataFrame:
    """Left join of ``matched_type`` to the keywords (clean_word, type); adds ``degree_level``.

    There is no broadcast hint: Spark broadcasts the keywords while their size allows it.
    """
    levels = keywords.select(
        F.col("clean_word").alias("matched_type"), F.col("type").alias("degree_level")
    )
    return df.join(levels, "matched_type", "left")


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename columns; a column that already has a new name is replaced."""
    return df.drop(*names.values()).withColumnsRenamed(dict(names))


def corpus_shape(df: DataFrame) -> DataFrame:
    """One row with the number of rows and of columns."""
    return df.agg(F.count("*").alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))
