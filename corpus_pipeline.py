"""The corpus pipeline: documents in, packed training sequences out."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from namewright.llm.mixing import mix_sources, tempered_targets
from namewright.llm.near_dedup import near_unique
from namewright.llm.packing import best_fit_pack, tokenise
from namewright.llm.quality_classifier import select_quality
from namewright.llm.queries import ratings
from namewright.llm.secret_scan import redact_secrets
from namewright.sources.staging import run_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal classifier, fitted on the labels, rejects go."""
    return select_quality(docs, ratings(spark, sf_dir))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one of the smallest id."""
    return near_unique(docs)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets give way to a mark; ``n_chars`` follows."""
    return redact_secrets(docs).withColumn("n_chars", F.length("text").cast("long"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources repeat by Poisson counts towards the square roots of their sizes."""
    return mix_sources(docs, tempered_targets(docs)).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences of at most 1024 tokens."""
    pieces = tokenise(docs)
    return best_fit_pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


STAGES: list[tuple[str, Stage]] = [
    ("quality", drop_low_quality), ("near_dedup", drop_near_duplicates), ("secrets", redact), ("mixing", mix), ("packing", pack),
]

#: The classifier, the network and the tokenizer can't be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{run_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for place, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{place}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
