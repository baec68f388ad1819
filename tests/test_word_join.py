from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from namewright.operators.vector_match import word_mean_vectors
from namewright.operators.word_join import join_vectors

SCHEMA = "id long, word string"


def vocabulary(spark, words):
    return spark.createDataFrame([(w, [float(i), 1.0]) for i, w in enumerate(words)], "word string, vector array<double>")


@pytest.mark.parametrize("broadcast_bytes", [1 << 20, 500, 0])
def test_every_occurrence_meets_its_vector(spark, broadcast_bytes):
    draw = random.Random(3)
    words = [f"w{i}" for i in range(60)]
    rows = [(i, draw.choice(["w0", "w1", None, "unknown", "", draw.choice(words)])) for i in range(3000)]
    got = join_vectors(spark.createDataFrame(rows, SCHEMA), vocabulary(spark, words[:50]), broadcast_bytes)
    assert got.columns == ["id", "word", "vector"]
    found = Counter((r.id, r.word, r.vector[0]) for r in got.collect())
    assert found == Counter((i, w, float(w[1:])) for i, w in rows if w and w[1:].isdigit() and int(w[1:]) < 50)


def test_empty_tables_null_words_and_null_vectors(spark):
    rows = spark.createDataFrame([(1, "a"), (2, None), (2, "a")], SCHEMA)
    none = spark.createDataFrame([], "word string, vector array<double>")
    odd = spark.createDataFrame([("a", None), (None, [1.0])], "word string, vector array<double>")
    for size in (1 << 20, 0):
        assert join_vectors(rows, none, size).count() == 0
        assert join_vectors(rows.limit(0), vocabulary(spark, ["a"]), size).count() == 0
        assert sorted((r.id, r.vector) for r in join_vectors(rows, odd, size).collect()) == [(1, None), (2, None)]


def test_one_word_in_nine_of_ten_rows_is_spread_evenly(spark):
    """Without adaptive execution, and with a vocabulary that is too large to be broadcast."""
    rows = spark.range(0, 80_000, 1, 8).select("id", F.when(F.col("id") % 10 == 0, F.concat(F.lit("w"), F.col("id") % 4001)).otherwise("hot").alias("word"))
    vectors = vocabulary(spark, ["hot", *(f"w{i}" for i in range(4001))])
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = join_vectors(rows, vectors, 50_000)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        plain = rows.join(vectors.hint("shuffle_merge"), "word").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert sum(sizes) == 80_000 and max(sizes) <= 9_100
    assert max(r["count"] for r in plain) >= 72_000


def test_means_are_the_same_either_way(spark):
    texts = spark.createDataFrame([(i, "tax law " * (i % 3) + f"w{i % 7}") for i in range(100)], "id long, t string")
    vectors = vocabulary(spark, ["tax", "law", *(f"w{i}" for i in range(5))])
    means = [
        {r.id: [round(x, 9) for x in r.vector] for r in word_mean_vectors(texts, F.split("t", " "), vectors, keys=["id"], broadcast_bytes=size).collect()}
        for size in (1 << 20, 100)
    ]
    assert means[0] == means[1] and len(means[0]) > 80
