"""Cleaning of a text column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from namewright.config import LETTERS, LETTERS_AND_DIGITS, LETTERS_ONLY, STOPWORDS
from namewright.functions import text


def clean_column(
    df: DataFrame,
    column: str,
    stopwords: Sequence[str] = STOPWORDS,
    letters: text.Letters = LETTERS,
    punctuation: str = LETTERS_ONLY,
    mode: str = "strip_first",
) -> DataFrame:
    """Overwrite ``column`` by its cleaned value; the column keeps its position.

    ``strip_first`` deletes punctuation before it folds letters and removes repeated words;
    ``fold_first`` folds before it strips and turns punctuation into spaces.
    """
    if mode == "strip_first":
        cleaned = text.clean_strip_first(F.col(column), stopwords, letters, punctuation)
    elif mode == "fold_first":
        cleaned = text.clean_fold_first(F.col(column), stopwords, letters)
    else:
        raise ValueError(f"unknown cleaning mode: {mode}")
    return df.withColumn(column, cleaned)


def taxonomy_words(taxonomy: DataFrame, column: str = "degree_name") -> DataFrame:
    """Clean ``column`` and add one row per word of it, in the column ``words``."""
    cleaned = clean_column(taxonomy, column, punctuation=LETTERS_AND_DIGITS)
    return cleaned.withColumn("words", F.explode(F.split(F.col(column), " ")))
