"""The registered queries of the subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from namewright.llm.byte_bpe import decode_documents, encode_documents
from namewright.llm.embedding_dedup import embedding_dedup
from namewright.llm.fill_in_middle import fill_in_middle, restored
from namewright.llm.license_scan import license_scan
from namewright.llm.mixing import mix_sources, tempered_targets
from namewright.llm.near_dedup import near_dedup
from namewright.llm.packing import best_fit_pack, tokenise
from namewright.llm.preference import format_pairs, rival_replies
from namewright.llm.quality_classifier import quality_classifier
from namewright.llm.quality_rules import quality_rules
from namewright.llm.secret_scan import secret_scan
from namewright.llm.sharding import shard_documents
from namewright.llm.vector_codes import compress, label_errors


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup(_table(spark, sf_dir, "embeddings"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = tokenise(_table(spark, sf_dir, "documents"))
    return best_fit_pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


def op3_preference_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    def spans(mask: str) -> Column:
        return F.array_join(F.transform(mask, lambda m: F.concat_ws(":", m["begin"].cast("string"), m["end"].cast("string"))), ",")

    made = format_pairs(rival_replies(_table(spark, sf_dir, "conversations")))
    return made.withColumns({mask: spans(mask) for mask in ("chosen_mask", "rejected_mask")})


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grades from the labels: 0 low quality, 1 toxic, 2 neither."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when((F.col("quality") == 1) & (F.col("toxic") == 0), 2)
    return _table(spark, sf_dir, "labels").select("doc_id", grade.alias("grade"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier(_table(spark, sf_dir, "documents"), ratings(spark, sf_dir))


def op5_poisson_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return mix_sources(documents, tempered_targets(documents))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    def spans(found: Column) -> Column:
        places = F.transform(found, lambda f: F.concat_ws(":", f["kind"], f["start"].cast("string"), f["end"].cast("string")))
        return F.array_join(places, ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("findings", lambda f: f["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("findings", lambda f: f["kind"] != "learned")
    return secret_scan(_table(spark, sf_dir, "documents")).select(
        "doc_id", count("assign"), count("access"), count("hex"), F.sha2(spans(base), 256).alias("base_sha256"),
        spans(F.col("findings")).alias("spans"), count("learned"), "n_scored",
    )


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
        F.col("place").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "virtual_slot",
    )


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"), "score",
    )


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(_table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(_table(spark, sf_dir, "documents"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(_table(spark, sf_dir, "documents"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = compress(_table(spark, sf_dir, "embeddings"))
    return label_errors(codes).select("vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encode_documents(_table(spark, sf_dir, "documents"))
    return encoded.select(
        "doc_id", F.size("starts").cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(decode_documents(F.col("ids")), 256).alias("decoded_sha256"),
        F.coalesce(F.try_element_at("ends", F.lit(-1)), F.lit(0)).cast("long").alias("n_chars"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_embedding_dedup, op2_best_fit_packing, op3_preference_formatting, op4_quality_classifier, op5_poisson_mixing,
        op6_secret_scan, op7_sharding, op8_license_scan, op9_near_dedup, op10_quality_rules, op11_fill_in_middle, op12_vector_codes,
        op13_byte_bpe,
    )
}
