"""Brute-force forms of some queries, to time the others against: every pair is compared."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from namewright.config import LETTERS_AND_DIGITS
from namewright.functions import similarity, text
from namewright.operators import dimensions, fuzzy
from namewright.operators.cleaning import clean_column, taxonomy_words
from workload import queries, tables


def _best_targets(tokens: DataFrame, keys: list[str], targets: DataFrame, threshold: float) -> DataFrame:
    close = similarity.edit_similarity(F.col("token"), F.col("target"))
    pairs = tokens.crossJoin(F.broadcast(targets)).withColumn("similarity", close)
    order = F.struct(-F.col("similarity"), F.col("rank"), F.col("target"))
    best = F.min_by(F.struct("target", "similarity"), order)
    return pairs.where(F.col("similarity") >= threshold).groupBy(*keys).agg(best.alias("b")).select(*keys, "b.*")


def fuzzy_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = fuzzy.text_tokens(tables.cleaned_entities(spark, sf_dir), "name")
    targets = fuzzy.as_targets(spark, queries.taxonomy_word_list(spark, sf_dir))
    return _best_targets(tokens, ["token"], targets, 0.75)


def _overlap(rows: DataFrame, taxonomy: DataFrame, words: Column) -> DataFrame:
    entries = taxonomy.select(
        F.col("id").alias("master_degree_id"), "degree_name",
        F.split(F.lower("degree_name"), " ").alias("master_tokens"),
    )
    scored = rows.withColumn("education_tokens", words).crossJoin(F.broadcast(entries)).withColumn(
        "match_score", similarity.shared_words(F.col("education_tokens"), F.col("master_tokens"))
    )
    window = Window.partitionBy("id").orderBy(F.desc("match_score"), "master_degree_id")
    return scored.withColumn("rank", F.row_number().over(window)).where(F.col("rank") == 1)


def overlap_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = text.overlap_words(F.col("matched_speciality"))
    return _overlap(tables.specialities(spark, sf_dir), tables.taxonomy(spark, sf_dir), words)


def overlap_large_taxonomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = text.overlap_words(F.col("matched_speciality"))
    return _overlap(tables.specialities(spark, sf_dir), tables.part_taxonomy(spark, sf_dir), words)


def _corrected(rows: DataFrame, targets: DataFrame, threshold: float) -> DataFrame:
    """Every word of every row against every target; only ``name`` and ``matched`` are kept up."""
    words = rows.select("id", F.posexplode(F.split("name", " ")).alias("p", "token"))
    best = _best_targets(words, ["id", "p", "token"], targets, threshold)
    joined = words.join(best, ["id", "p", "token"], "left").groupBy("id").agg(
        F.array_sort(F.collect_list(F.struct("p", "token", "target"))).alias("w")
    )
    fixed = joined.select(
        "id", F.array_join(F.transform("w", lambda w: F.coalesce(w["target"], w["token"])), " ").alias("name"),
        F.array_join(F.filter(F.col("w.target"), lambda t: t.isNotNull()), "|").alias("matched"),
    )
    return rows.drop("name", "matched").join(fixed, "id", "left")


def classify_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tables.cleaned_entities(spark, sf_dir)
    keywords = dimensions.keep_first(tables.keyword_rows(spark, sf_dir), ["clean_word"], ["load_order"])
    types = keywords.select(F.col("clean_word").alias("target"), F.col("load_order").alias("rank"))
    taxonomy = clean_column(tables.taxonomy(spark, sf_dir), "degree_name", punctuation=LETTERS_AND_DIGITS)
    words = fuzzy.as_targets(spark, dimensions.distinct_words(taxonomy_words(taxonomy)))
    typed = _corrected(rows, types, 0.75).withColumn("matched_type", text.first_pipe_word(F.col("matched")))
    leveled = dimensions.lookup_level(typed, keywords)
    return _overlap(_corrected(leveled, words, 0.8), taxonomy, text.overlap_words(F.col("matched")))


NAIVE = {
    f.__name__: f
    for f in (fuzzy_dictionary, overlap_best, overlap_large_taxonomy, classify_names)
}
