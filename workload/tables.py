"""Input tables of the registered queries, derived from the test data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from namewright.functions import text
from namewright.config import LETTERS_AND_DIGITS


#: Tables of long texts; a file of one row group is one split, however many cores there are.
TEXTS = ("documents",)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; one of texts with fewer splits than cores is dealt out, which large tables never need."""
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return rows.repartition(cores) if name in TEXTS and rows.rdd.getNumPartitions() < cores else rows


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Type and name of each part, one character deleted: (id, name, cluster)."""
    part = table(spark, sf_dir, "part")
    full = F.concat(F.lower("p_type"), F.lit(" "), F.col("p_name"))
    place = (F.col("p_partkey") % F.length(full)).cast("int") + 1
    name = F.concat(
        F.substring(full, F.lit(1), place - 1), F.substring(full, place + 1, F.length(full))
    )
    return part.select(
        F.col("p_partkey").cast("string").alias("id"), name.alias("name"), F.col("p_brand").alias("cluster")
    )


def cleaned_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = text.clean_strip_first(F.col("name"), punctuation=LETTERS_AND_DIGITS)
    return entities(spark, sf_dir).withColumn("name", name)


def specialities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned entities with their words as pipe-separated specialities; some have none."""
    words = F.regexp_replace("name", " ", "|")
    return cleaned_entities(spark, sf_dir).withColumn(
        "matched_speciality", F.when(F.col("cluster") != "Brand#7", words)
    )


def taxonomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct part names with the lowest key: (id, degree_name)."""
    named = table(spark, sf_dir, "part").groupBy(F.col("p_name").alias("degree_name"))
    return named.agg(F.lpad(F.min("p_partkey").cast("string"), 12, "0").alias("id")).select(
        "id", "degree_name"
    )


def part_taxonomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct type, brand and name of the parts with the lowest key: (id, degree_name)."""
    whole = F.concat_ws(" ", F.lower("p_type"), F.col("p_brand"), F.col("p_name"))
    named = table(spark, sf_dir, "part").groupBy(whole.alias("degree_name"))
    return named.agg(F.lpad(F.min("p_partkey").cast("string"), 12, "0").alias("id")).select("id", "degree_name")


def keyword_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A keyword row per part, with many repeats: (clean_word, type, load_order)."""
    return table(spark, sf_dir, "part").select(
        F.lower("p_type").alias("clean_word"),
        F.concat(F.lit("Level "), F.col("p_type"), F.lit(" "), F.col("p_brand")).alias("type"),
        F.col("p_partkey").alias("load_order"),
    )


def benchmark_taxonomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = text.clean_strip_first(F.col("text"), punctuation=LETTERS_AND_DIGITS)
    return table(spark, sf_dir, "benchmark").select(
        F.lpad(F.col("item_id").cast("string"), 12, "0").alias("id"), name.alias("degree_name")
    )


def word_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A vector per word of the entities and the taxonomy, picked by the word's letters."""
    words = cleaned_entities(spark, sf_dir).select("name").unionByName(
        taxonomy(spark, sf_dir).select(F.col("degree_name").alias("name"))
    )
    word = F.col("word")
    embeddings = table(spark, sf_dir, "embeddings")
    picked = (
        words.select(F.explode(F.split("name", " ")).alias("word")).distinct()
        .where(word != "")
        .withColumn("n", embeddings.select(F.count("*")).scalar())
        .withColumn(
            "vec_id",
            (F.ascii(word) * 7 + F.ascii(F.right(word, F.lit(1))) * 31 + F.length(word) * 3) % F.col("n"),
        )
    )
    vectors = embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("vector"))
    return picked.join(vectors, "vec_id").select("word", "vector")


def labelled_vectors(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All vectors, and the first vector of each label."""
    embeddings = table(spark, sf_dir, "embeddings").withColumnRenamed("embedding", "vector")
    firsts = embeddings.groupBy("label").agg(
        F.min("vec_id").alias("rank"), F.min_by("vector", "vec_id").alias("vector")
    )
    return embeddings.select("vec_id", "vector"), firsts.withColumnRenamed("label", "best_label")
