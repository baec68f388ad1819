from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from namewright.config import LETTERS, STOPWORDS
from namewright.operators import fuzzy
from namewright.operators.edit_match import candidate_pairs, edit_matches
from tests import brute

LETTER_POOL = "abcdeñ"


def words(rng, n, longest=9, pool=LETTER_POOL):
    return sorted({"".join(rng.choices(pool, k=rng.randint(1, longest))) for _ in range(n)})


@pytest.mark.parametrize("threshold", [0.3, 0.5, 0.7, 0.75, 0.8, 1.0])
def test_segments_find_every_pair(spark, threshold):
    rng = random.Random(int(threshold * 100))
    tokens = [w for w in words(rng, 150) if len(w) >= 2]
    targets = words(rng, 60, 12)
    found = edit_matches(
        spark.createDataFrame([(t,) for t in tokens], "token string"),
        spark.createDataFrame([(t, t) for t in targets], "target string, rank string"), threshold)
    pairs = {(r.token, r.target, r.similarity) for r in found.collect()}
    expected = {(a, b, s) for a in tokens for b in targets
                if (s := brute.edit_similarity(a, b)) >= threshold}
    assert pairs == expected


@pytest.mark.parametrize("threshold", [0.2, 0.3, 0.5, 0.6, 0.8])
def test_pairs_are_verified_once(spark, threshold):
    rng = random.Random(int(threshold * 100) + 1)
    tokens = [w for w in words(rng, 200, 15, "abcdefghijklmnop") if len(w) >= 2] + ["aaaaaaaa", "abababab", "aabbaabb"]
    targets = words(rng, 80, 15, "abcdefghijklmnop") + ["aaaaaaa", "ababab", "a"]
    token_table = spark.createDataFrame([(t,) for t in dict.fromkeys(tokens)], "token string")
    target_table = spark.createDataFrame([(t, t) for t in dict.fromkeys(targets)], "target string, rank string")
    pairs = [(r.token, r.target) for r in candidate_pairs(token_table, target_table, threshold).collect()]
    assert len(pairs) == len(set(pairs))
    found = [(r.token, r.target) for r in edit_matches(token_table, target_table, threshold).collect()]
    near = {(a, b) for a in tokens for b in targets if brute.edit_similarity(a, b) >= threshold}
    assert len(found) == len(set(found)) and set(found) == near <= set(pairs)
    # Pairs whose lengths alone allow the threshold are far more.
    banded = sum(min(len(a), len(b)) >= threshold * max(len(a), len(b)) for a in set(tokens) for b in set(targets))
    assert len(pairs) < (0.9 if threshold < 0.5 else 0.7) * banded


@pytest.mark.parametrize("threshold", [0, 1.1])
def test_threshold_is_checked(spark, threshold):
    df = spark.createDataFrame([("a", "a", 1)], "token string, target string, rank int")
    with pytest.raises(ValueError):
        edit_matches(df.select("token"), df.select("target", "rank"), threshold)


def corrected(df, targets, threshold=0.75, vectors=None, **options):
    return fuzzy.correct_words(df, "name", targets, STOPWORDS, LETTERS, threshold, "|", vectors, **options)


def check(spark, texts, targets, threshold=0.75, **options):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, name string")
    rows = corrected(df, targets, threshold, **options).orderBy("i").collect()
    got = [tuple(r[c] for c in fuzzy.CORRECTION_COLUMNS) for r in rows]
    assert got == [brute.correct(t, targets, threshold) for t in texts]


def test_named_cases(spark):
    texts = ["Masters of Fnance", "fnance", None, "", "de la", "mba2 mba", "Finance FINANCE fnance",
             "fnance, (finance); fnance", "gestión gestion", "masterx Master", "x\nfnance\ny"]
    check(spark, texts, ["master", "finance", "mba", "gestion", "degree"])


def test_targets_with_blanks_and_special_characters(spark):
    check(spark, ["masterdegree degre", "c$st a\\bcdef", "degre masterdegre"],
          ["master degree", "degree", "c$sts", "a\\bcdef"], 0.7)


def test_ties_take_the_first_target(spark):
    check(spark, ["abcx"], ["abcz", "abcy"], 0.7)
    check(spark, ["abcx"], ["abcy", "abcz"], 0.7)


def test_random_texts(spark):
    rng = random.Random(7)
    pool = words(rng, 60, 8)
    join = lambda: "".join(
        rng.choice([w, w.upper(), w.title(), rng.choice(STOPWORDS)]) + rng.choice([" ", "  ", "-", ", ", "2 ", "_"])
        for w in rng.choices(pool, k=rng.randint(0, 8)))
    check(spark, [join() for _ in range(200)], words(rng, 25, 8), 0.6)


def test_clean_random_texts(spark):
    rng = random.Random(8)
    pool = words(rng, 60, 8, "abcde1")
    texts = [" ".join(rng.sample(pool, rng.randint(1, 6))) for _ in range(200)]
    check(spark, texts, words(rng, 25, 8, "abcde"), 0.6)


def test_hot_text_is_split_without_change(spark):
    texts = ["fnance master"] * 300 + [f"fnance {chr(97 + i % 26)}zz" for i in range(60)]
    check(spark, texts, ["finance", "master"], 0.75, rows_per_split=10)


def test_long_text(spark):
    rng = random.Random(9)
    pool = words(rng, 400, 9)
    check(spark, [" ".join(rng.choices(pool, k=3000)), " ".join(pool)], words(rng, 20, 6), 0.7)


def test_missing_arguments(spark):
    df = spark.createDataFrame([("a",)], "name string")
    for missing in range(3):
        arguments = [["a"], STOPWORDS, LETTERS]
        arguments[missing] = None
        with pytest.raises(ValueError):
            fuzzy.correct_words(df, "name", *arguments)


def test_embeddings_win_ties_and_edits_must_be_better(spark):
    vectors = {"money": [1.0, 0.0], "finance": [0.9, 0.1], "master": [0.0, 1.0], "finanse": [0.6, 0.6]}

    def cosine(a, b):
        if a not in vectors or b not in vectors:
            return None
        (x, y), (z, w) = vectors[a], vectors[b]
        return round((x * z + y * w) / ((x * x + y * y) * (z * z + w * w)) ** 0.5, 12)

    targets = ["master", "finance", "zebra"]
    texts = ["money finance", "finanse", "zebra masters money"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, name string")
    table = spark.createDataFrame(list(vectors.items()), "word string, vector array<double>")
    rows = corrected(df, targets, 0.7, table).orderBy("i").collect()
    got = [tuple(r[c] for c in fuzzy.CORRECTION_COLUMNS) for r in rows]
    assert got == [brute.correct(t, targets, 0.7, cosine=cosine) for t in texts]
    assert got[0][3] == "1|1" and got[1][3] == "3"


def test_no_python_and_no_cross_join_in_the_plan(spark):
    df = spark.createDataFrame([("fnance",)], "name string")
    plan = corrected(df, ["finance"])._jdf.queryExecution().toString()
    for operator in ("EvalPython", "MapInArrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in plan


def test_texts_stay_in_place_until_the_final_join(spark, monkeypatch):
    staged = []
    whole = fuzzy.stage
    monkeypatch.setattr(fuzzy, "stage", lambda df, name: staged.append(df.columns) or whole(df, name))
    rows = spark.createDataFrame([("fnance tax", 1), ("law", 2)], "name string, n int")
    fuzzy.correct_words(rows, "name", ["finance"], [], (), 0.7).collect()
    assert staged and all("name" not in columns and "text" not in columns for columns in staged)


def test_replacement_is_not_quadratic(spark):
    import time

    def seconds(n):
        words = [f"wrd{i:05d}" for i in range(n)]
        matches = [(-8, i, w, w.replace("wrd", "word"), 3) for i, w in enumerate(words)]
        schema = "name string, _matches array<struct<order int, position int, token string, target string, source int>>"
        df = spark.createDataFrame([(" ".join(words), matches)], schema)
        best = float("inf")
        for _ in range(3):
            start = time.perf_counter()
            (row,) = fuzzy._with_corrections(df, ["name"], "name", ",").collect()
            best = min(best, time.perf_counter() - start)
        assert row.name_corrected == " ".join(w.replace("wrd", "word") for w in words)
        return best

    seconds(500)
    small, large = seconds(5_000), seconds(20_000)
    assert large < 6 * small + 1
