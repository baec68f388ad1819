from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from namewright.operators import vector_match
from namewright.operators.cosine_match import cosine_matches


def vector_table(spark, rows, key):
    return spark.createDataFrame(rows, f"{key}, vector array<double>")


@pytest.mark.parametrize("threshold", [0.3, 0.0, -1.0])
@pytest.mark.parametrize("broadcast_rows", [1000, 5])
def test_best_candidate_equals_all_pairs(spark, threshold, broadcast_rows):
    rng = np.random.default_rng(3)
    queries = [(i, rng.normal(size=6).tolist()) for i in range(200)] + [(200, [0.0] * 6), (201, None)]
    vectors = [rng.normal(size=6).tolist() for _ in range(40)]
    vectors += [[2 * x for x in vectors[0]], vectors[1]]
    candidates = [(f"c{i}", i, v) for i, v in enumerate(vectors)]
    found = cosine_matches(
        vector_table(spark, queries, "q int"), vector_table(spark, candidates, "name string, rank int"),
        threshold, broadcast_rows=broadcast_rows, candidate_block=8, query_block=32)
    got = {r.q: (r["rank"], r["name"], round(r.similarity, 9)) for r in found.collect()}
    unit = np.array([np.array(v) / np.linalg.norm(v) for v in vectors])
    expected = {}
    for q, v in queries:
        v = np.array(v or [0.0] * 6)
        scores = np.round(unit @ (v / (np.linalg.norm(v) or 1.0)), 12)
        best = int(scores.argmax())
        if scores[best] >= threshold:
            expected[q] = (best, f"c{best}", round(float(scores[best]), 9))
    assert got == expected


@pytest.mark.parametrize("broadcast_rows", [1000, 0])
def test_no_candidates(spark, broadcast_rows):
    queries = vector_table(spark, [(1, [1.0])], "q int")
    none = vector_table(spark, [], "name string, rank int")
    assert cosine_matches(queries, none, 0.1, broadcast_rows=broadcast_rows).count() == 0


def test_a_vector_is_exactly_one_close_to_itself(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=100).tolist()) for i in range(50)]
    found = cosine_matches(vector_table(spark, rows, "q int"), vector_table(spark, rows, "rank int"), 1.0)
    assert {(r.q, r["rank"], r.similarity) for r in found.collect()} == {(i, i, 1.0) for i in range(50)}


def test_mean_of_known_words(spark):
    vectors = vector_table(spark, [("tax", [1.0, 0.0]), ("law", [0.0, 1.0]), ("the", [9.0, 9.0])], "word string")
    texts = spark.createDataFrame([("tax|Tax|law|nope|the",), ("nope",)], "t string")
    means = vector_match.word_mean_vectors(texts, F.split("t", r"\|"), vectors)
    rows = means.collect()
    assert len(rows) == 1 and rows[0].vector == pytest.approx([2 / 3, 1 / 3])
    kept = vector_match.word_mean_vectors(texts, F.split("t", r"\|"), vectors, keep_unknown=True)
    assert {r.t: r.vector is None for r in kept.collect()} == {"tax|Tax|law|nope|the": False, "nope": True}


def test_match_by_vector(spark):
    vectors = vector_table(
        spark, [("tax", [1.0, 0.0]), ("finance", [0.9, 0.2]), ("law", [0.0, 1.0]), ("civil", [0.1, 0.9])],
        "word string")
    taxonomy = spark.createDataFrame(
        [("3", "tax finance"), ("1", "civil law"), ("2", "law civil"), ("4", "unknown")],
        "id string, degree_name string")
    rows = spark.createDataFrame(
        [("a", "tax"), ("b", "law|civil"), ("c", "nothing"), ("d", None), (None, "tax"), ("e", "nothing"),
         ("e", "law")], "id string, matched_speciality string")
    got = vector_match.match_by_vector(rows, taxonomy, vectors, threshold=0.7, rows_per_split=1)
    found = sorted((str(r.id), str(r.matched_speciality), r.best_match_degree_name) for r in got.collect())
    # A shared id shares its best match; a row without id has none.
    assert found == [("None", "tax", None), ("a", "tax", "tax finance"), ("b", "law|civil", "civil law"),
                     ("c", "nothing", None), ("d", "None", None), ("e", "law", "civil law"),
                     ("e", "nothing", "civil law")]


def test_threshold_of_zero_matches_unknown_words_to_the_lowest_id(spark):
    vectors = vector_table(spark, [("tax", [1.0])], "word string")
    taxonomy = spark.createDataFrame([("2", "tax"), ("1", "law")], "id string, degree_name string")
    rows = spark.createDataFrame([("a", "none")], "id string, matched_speciality string")
    row = vector_match.match_by_vector(rows, taxonomy, vectors, threshold=0.0).head()
    assert (row.best_match_degree_name, row.best_match_similarity) == ("law", 0.0)


def test_nearest_words(spark):
    vectors = vector_table(
        spark, [("a", [1.0, 0.0]), ("b", [1.0, 0.1]), ("c", [0.0, 1.0]), ("d", [2.0, 0.2])], "word string")
    assert [r.word for r in vector_match.nearest_words(vectors, "a", 2).collect()] == ["b", "d"]
    assert vector_match.nearest_words(vectors, "zzz", 2).collect() == []
    twice = vectors.unionByName(vectors.where("word = 'a'"))
    assert [r.word for r in vector_match.nearest_words(twice, "a", 2).collect()] == ["b", "d"]
