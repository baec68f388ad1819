"""End-to-end classification of messy names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from namewright.config import LETTERS_AND_DIGITS, Thresholds
from namewright.functions import text
from namewright.operators import dimensions, fuzzy
from namewright.operators.attach import ROWS_PER_SPLIT, attach
from namewright.operators.cleaning import clean_column, taxonomy_words
from namewright.operators.overlap import MAX_POSTINGS, MAX_SUBSET, OverlapIndex, best_per_id, gate
from namewright.sources import csv, tables
from namewright.sources.staging import stage
from namewright.sources.workbook import read_workbook

RESULT_COLUMNS = (
    "id", "name", "cluster", "degree_name", "degree_level", "matched_type", "education_tokens",
    "master_tokens", "match_score", "model_source_specialities", "model_source_types",
)


def _correct(names: DataFrame, column: str, tokens: DataFrame, targets: DataFrame, threshold: float,
             vectors: DataFrame | None, label: str) -> DataFrame:
    dictionary = fuzzy.correction_dictionary(tokens, targets, threshold, vectors)
    return fuzzy.apply_dictionary(names, column, stage(dictionary, label), "|")


def classify(
    entities: DataFrame,
    keywords: DataFrame,
    taxonomy: DataFrame,
    keyword_order: str,
    vectors: DataFrame | None = None,
    thresholds: Thresholds = Thresholds(),
    rows_per_split: int = ROWS_PER_SPLIT,
    max_postings: int = MAX_POSTINGS,
    max_subset: int = MAX_SUBSET,
) -> DataFrame:
    """Clean, correct and classify ``entities`` (id, name, cluster); one row per id.

    ``keywords`` (clean_word, type) give the level, ``taxonomy`` (id, degree_name) the degree.
    The first keyword row per word in ``keyword_order`` counts, and a lower one wins ties of similarity: name the
    column that holds the load order (``read_dimension`` adds one), as rows have no order of their own. All work runs once per distinct
    cleaned name, partitioned by name from the first correction to the taxonomy match, and is
    joined to the rows at the end. ``max_postings`` and ``max_subset`` are those of ``OverlapIndex``; the result doesn't depend on them.
    """
    keywords = stage(dimensions.keep_first(keywords, ["clean_word"], [keyword_order]), "keywords")
    cleaned_taxonomy = clean_column(
        taxonomy.withColumn("id", F.col("id").cast("string")), "degree_name",
        punctuation=LETTERS_AND_DIGITS,
    )
    types = keywords.select(F.col("clean_word").alias("target"), F.col(keyword_order).alias("rank"))
    specialities = dimensions.distinct_words(taxonomy_words(cleaned_taxonomy))
    spark = entities.sparkSession

    rows = clean_column(
        entities.select(F.col("id").cast("string").alias("id"), "name", "cluster"), "name",
        punctuation=LETTERS_AND_DIGITS,
    )
    counts = stage(rows.groupBy("name").agg(F.count("*").alias("n_rows")), "names")
    names = counts.select(F.col("name").alias("_name")).repartition("_name")
    # What the first correction inserts are words of its targets: the second needs no look at its result.
    tokens = fuzzy.text_tokens(counts, "name")
    more = tokens.union(fuzzy.text_tokens(types.withColumnRenamed("target", "name"), "name")).distinct()

    typed = _correct(
        names.withColumn("name", F.col("_name")), "name", tokens,
        fuzzy.as_targets(spark, types), thresholds.category, vectors, "types",
    )
    typed = dimensions.lookup_level(dimensions.first_match(typed), keywords)
    typed = dimensions.rename(
        typed.drop("original_tokens_matched", "matched_words"),
        {"model_sources": "model_source_types", "name_corrected": "name"},
    )
    specified = _correct(
        typed, "name", more, fuzzy.as_targets(spark, specialities),
        thresholds.speciality, vectors, "specialities",
    )
    specified = dimensions.rename(
        specified.drop("original_tokens_matched"),
        {"model_sources": "model_source_specialities", "name_corrected": "name",
         "matched_words": "matched_speciality"},
    )
    education = text.overlap_words(F.col("matched_speciality"))
    index = OverlapIndex(cleaned_taxonomy.select("id", "degree_name"), max_postings, max_subset)
    best = index.complete(index.best(specified, specified.columns, education, keep_all=True), education)
    results = best.select(
        F.col("_name"), F.col("name").alias("corrected"), "degree_level", "matched_type",
        "model_source_types", "model_source_specialities",
        education.alias("education_tokens"), "entry.*", "match_score",
    )
    matched = attach(
        rows.withColumnRenamed("name", "_name"), results, counts.withColumnRenamed("name", "_name"),
        "_name", rows_per_split,
    )
    matched = matched.drop("_name").withColumnRenamed("corrected", "name")
    ranked = best_per_id(matched, [F.desc_nulls_last("match_score"), F.asc("master_degree_id")])
    shaped = gate(ranked, thresholds.min_overlap).withColumns({
        "education_tokens": text.render_list(F.col("education_tokens")),
        "master_tokens": text.render_list(F.col("master_tokens")),
    })
    return shaped.select(*RESULT_COLUMNS)


def _dimension(spark: SparkSession, path: str, sheet: int, schema: str, order_column: str | None = None) -> DataFrame:
    if path.lower().endswith(".xlsx"):
        return read_workbook(spark, path, sheet, schema, order_column)
    return tables.read_dimension(spark, path, schema, order_column=order_column)


def classify_files(
    spark: SparkSession,
    entities: str,
    keywords: str,
    taxonomy: str,
    result: str,
    vectors: DataFrame | None = None,
    thresholds: Thresholds = Thresholds(),
    multi_line: bool = False,
) -> None:
    """``classify`` from CSV to CSV: paths of the entities, the keywords (in load order) and the taxonomy, and of the result.

    Keywords and taxonomy may be the first and second sheet of a workbook (.xlsx), of the same one or of two. With ``multi_line`` entities whose
    quotes don't pair up are an error, as in ``read_entities``.
    """
    rows = csv.read_entities(spark, entities, multi_line=multi_line)
    ordered = _dimension(spark, keywords, 0, tables.KEYWORD_SCHEMA, "load_order")
    degrees = _dimension(spark, taxonomy, 1, tables.TAXONOMY_SCHEMA)
    csv.write_result(classify(rows, ordered, degrees, "load_order", vectors, thresholds), result)
