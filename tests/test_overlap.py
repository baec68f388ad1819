from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from namewright.operators import overlap
from namewright.operators.overlap import OverlapIndex, classify_by_overlap
from tests import brute

ROWS = "id string, matched_speciality string"
TAXONOMY = "id string, degree_name string"


def texts(rng, n, pool):
    return ["|".join(rng.sample(pool, rng.randint(1, 5))) for _ in range(n)]


@pytest.mark.parametrize("max_postings", [1000, 8, 3, 0])
@pytest.mark.parametrize("keep_all", [True, False])
@pytest.mark.parametrize("max_subset", [8, 2])
def test_index_equals_comparing_all_pairs(spark, max_postings, keep_all, max_subset):
    rng = random.Random(max_postings)
    pool = [f"w{i}" for i in range(14)]
    # Word w0 is in most names, so that frequent and rare words mix.
    names = [" ".join(sorted({"w0", *rng.sample(pool, rng.randint(1, 4))})) for _ in range(60)]
    taxonomy = [(f"{i:03d}", n) for i, n in enumerate(names)]
    queries = sorted(set(texts(rng, 120, [*pool, "x1", "x2"])))
    index = OverlapIndex(spark.createDataFrame(taxonomy, TAXONOMY), max_postings, max_subset)
    keyed = spark.createDataFrame([(q,) for q in queries], "q string")
    tokens = F.split("q", r"\|")
    best = index.best(keyed, ["q"], tokens, keep_all)
    complete = index.complete(keyed.join(best, "q", "left"), tokens).collect()
    got = {r.q: (r.match_score, r.entry.master_degree_id, r.entry.degree_name) for r in complete}
    assert got == {q: brute.best_entry(q.split("|"), taxonomy) for q in queries}
    assert not keep_all or best.count() == len(queries)


def classify(spark, rows, taxonomy, score=2, **options):
    best = classify_by_overlap(
        spark.createDataFrame(rows, ROWS), spark.createDataFrame(taxonomy, TAXONOMY), score, **options)
    return {r.id: r for r in best.collect()}


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_null_zero_low_and_full_scores(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        taxonomy = [("2", "Finance Tax"), ("1", "law degree"), ("3", None)]
        rows = [("a", "finance|tax"), ("b", "TAX|other"), ("c", "none"), ("d", None), ("e", "")]
        got = classify(spark, rows, taxonomy)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    assert {k: (r.match_score, r.master_degree_id, r.degree_name) for k, r in got.items()} == {
        "a": (2, "2", "Finance Tax"), "b": (1, "2", None), "c": (0, "1", None),
        "d": (None, None, None), "e": (0, "1", None)}
    assert got["a"].matched_speciality_cleaned == "finance tax"
    assert got["b"].education_tokens == ["tax", "other"] and got["a"].master_tokens == ["finance", "tax"]
    assert got["d"].education_tokens is None and all(r["rank"] == 1 for r in got.values())


def test_empty_taxonomy_keeps_rows(spark):
    got = classify(spark, [("a", "x")], [])
    assert got["a"].match_score is None and got["a"].degree_name is None


def test_repeated_and_null_ids_collapse_to_the_best_row(spark):
    rows = [("a", "law"), ("a", "finance|tax"), (None, "law"), (None, "tax|finance|x"), (None, None)]
    got = classify(spark, rows, [("1", "law"), ("2", "finance tax")], 1)
    assert len(got) == 2
    assert got["a"].degree_name == "finance tax" and got[None].match_score == 2


def test_equal_scores_take_the_lowest_id_and_repeated_words_count_once(spark):
    got = classify(spark, [("a", "tax|tax|law")], [("9", "tax law"), ("5", "law tax tax"), ("7", "tax")], 1)
    assert (got["a"].master_degree_id, got["a"].match_score) == ("5", 2)


def test_hot_speciality_is_split_without_change(spark):
    rows = [(str(i), "finance|tax" if i % 3 else f"law|w{i}") for i in range(300)]
    taxonomy = [("1", "law"), ("2", "finance tax")]
    split = classify(spark, rows, taxonomy, 1, rows_per_split=7)
    assert len(split) == 300
    assert split == classify(spark, rows, taxonomy, 1)


def test_other_taxonomy_columns_come_along(spark):
    taxonomy = spark.createDataFrame([("1", "law", 5)], "id string, degree_name string, level int")
    rows = spark.createDataFrame([("a", "law")], ROWS)
    assert classify_by_overlap(rows, taxonomy, 1).head().level == 5


def test_plan_has_no_python_and_no_product(spark):
    rows = spark.createDataFrame([("a", "law")], ROWS)
    taxonomy = spark.createDataFrame([("1", "law")], TAXONOMY)
    best = classify_by_overlap(rows, taxonomy, 1)
    plan = best._jdf.queryExecution().toString()
    for operator in ("EvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in plan
    assert "WindowGroupLimit" in plan


def test_gate(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "match_score int, degree_name string")
    assert [r.degree_name for r in overlap.gate(df, 2).collect()] == [None, "b", None]


def test_candidates_do_not_grow_with_the_taxonomy(spark):
    rng = random.Random(7)
    pool = [f"w{i}" for i in range(60)]
    queries = sorted({"|".join(sorted(rng.sample(pool, 5))) for _ in range(200)})
    keyed = spark.createDataFrame([(q,) for q in queries], "q string")
    met = []
    for n in (500, 4_000):
        names = {" ".join(sorted(rng.sample(pool, 5))) for _ in range(n)}
        taxonomy = spark.createDataFrame([(f"{i:05d}", name) for i, name in enumerate(sorted(names))], TAXONOMY)
        index = OverlapIndex(taxonomy, max_postings=20)
        met.append(index.candidates(keyed, ["q"], F.split("q", r"\|")).count() / len(queries))
    assert max(met) <= 2**5 and met[1] < 2 * met[0]


def test_pairs_are_spread_however_few_bytes_their_words_have(spark, monkeypatch):
    monkeypatch.setattr("namewright.operators.overlap.PAIRS_PER_TASK", 50)
    taxonomy = spark.createDataFrame([(f"{i:02}", f"common word{i}") for i in range(20)], "id string, degree_name string")
    keyed = spark.createDataFrame([(f"k{i}", ["common", f"word{i % 20}"]) for i in range(100)], "_key string, tokens array<string>")
    for max_postings, pairs in ((1000, 2000), (5, 300)):
        scored = OverlapIndex(taxonomy, max_postings).candidates(keyed, ["_key"], F.col("tokens"))
        rows = {(r["_key"], r["number"]): r["score"] for r in scored.collect()}
        assert sum(score == 2 for score in rows.values()) == 100 and len(rows) <= pairs
        assert scored.rdd.getNumPartitions() >= 2 + (max_postings == 1000) * 38
