from __future__ import annotations

import math
import random

import numpy as np
import pyarrow as pa

from namewright.llm.quality_classifier import (
    POWER, Ordinal, Settings, _first_cuts, _sample, _values, fit, likelihood_gradient, quality_classifier, select_quality, text_features,
)
from tests.llm.tables import awkward, documents, empty, prose

RATINGS = "doc_id long, grade int, extra string"


def test_gradient_matches_differences():
    draw = np.random.default_rng(1)
    scores, cuts, grades = draw.normal(size=30), np.array([-1.0, 0.2, 1.5]), draw.integers(0, 4, 30)

    def likelihood(scores, cuts):
        tail = Ordinal(np.zeros(1), cuts, np.zeros(1)).tail(scores)
        p = np.concatenate([np.ones((30, 1)), tail], axis=1) - np.concatenate([tail, np.zeros((30, 1))], axis=1)
        return np.log(p[np.arange(30), grades])

    by_score, by_cut = likelihood_gradient(scores, cuts, grades)
    assert np.allclose(by_score, (likelihood(scores + 1e-6, cuts) - likelihood(scores - 1e-6, cuts)) / 2e-6, atol=1e-5)
    for k in range(3):
        step = np.eye(3)[k] * 1e-6
        assert np.isclose(by_cut[k], ((likelihood(scores, cuts + step) - likelihood(scores, cuts - step)) / 2e-6).sum(), atol=1e-4)


def test_features_are_those_of_the_whole_text():
    texts = [prose(1, 200_000), None, "", "same words", "same words", "Same WORDS", "| | |"]
    found = {}
    for first, row, bucket in text_features(pa.array(texts, pa.string()), 1 << 18):
        for r in np.unique(row):
            found[first + r] = set(bucket[row == r].tolist())
    assert found[3] == found[4] == found[5] and 1 not in found and 2 not in found and found[6]
    (end,) = text_features(pa.array([texts[0][-60:].split(" ", 1)[1]]), 1 << 18)
    assert set(end[2].tolist()) <= found[0]


def graded(n, seed):
    """Three grades: marks everywhere, one rude word, neither."""
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        grade = draw.choice((0, 1, 2, 2, 2))
        words = prose(seed * 10_000 + i, draw.randint(20, 120)).split(" ")
        if grade == 0:
            words = [w + draw.choice(("%%%", "&&&")) for w in words]
        if grade == 1:
            words.insert(draw.randrange(len(words)), draw.choice(("rubbishy", "vileness")))
        rows.append((i, " ".join(words), grade))
    return rows


def test_held_out_accuracy(spark):
    train, other = graded(900, 1), graded(400, 2)
    table = documents(spark, [(i, t) for i, t, _ in train] + [(5000 + i, t) for i, t, _ in other])
    ratings = spark.createDataFrame([(i, g, "x") for i, _, g in train] + [(1, None, None), (None, 2, None), (99_999, 2, None)], RATINGS)
    rows = {r["doc_id"]: r for r in quality_classifier(table, ratings).collect()}
    assert len(rows) == 1300
    mean = [np.mean([rows[5000 + i]["expected_grade"] for i, _, g in other if g == k]) for k in range(3)]
    assert mean[0] < mean[1] < mean[2]
    kept = [np.mean([rows[5000 + i]["kept"] for i, _, g in other if g == k]) for k in range(3)]
    assert kept[0] < 0.02 and kept[1] < 0.05 and kept[2] > 0.97
    stay = select_quality(table, ratings)
    assert stay.columns == table.columns and {r["doc_id"] for r in stay.collect()} == {i for i, r in rows.items() if r["kept"]}


def test_awkward_and_empty(spark):
    table, none = awkward(spark), spark.createDataFrame([], RATINGS)
    ratings = spark.createDataFrame([(1, 0, "a"), (5, 1, "b"), (7, 1, "b"), (2, 0, "c")], RATINGS)
    assert quality_classifier(table, ratings).count() == table.count()
    unlearned = quality_classifier(table, none).collect()
    assert all(r["kept"] and r["expected_grade"] is None for r in unlearned) and len(unlearned) == table.count()
    assert select_quality(table, none).count() == table.count()
    assert quality_classifier(empty(spark), ratings).count() == 0
    assert fit([np.array([1]), np.array([2])], np.array([1, 1]), Settings()) is None


def plain_judgement(text, model, settings):
    """One text at a time: its features looked up one by one, the logistic of each threshold, their sum."""
    found = [b for _, _, buckets in text_features(pa.array([text], pa.string()), settings.buckets) for b in buckets.tolist() if model.seen[b]]
    score = sum(float(model.weights[b]) for b in found) / max(len(found), 1) ** POWER
    tails = [1 / (1 + math.exp(cut - score)) for cut in model.cuts.tolist()]
    return sum(tails), tails[-1], tails[-1] >= model.threshold


def test_every_row_is_judged_as_one_text_alone_would_be(spark):
    train, other = graded(500, 3), graded(150, 4)
    texts = [(i, t) for i, t, _ in train] + [(1000 + i, t) for i, t, _ in other]
    texts += [(5000, None), (5001, ""), (5002, other[0][1]), (5003, "%%% &&&"), (5004, prose(5, 120_000)), (None, other[1][1])]
    table = documents(spark, texts).repartition(7)
    ratings = spark.createDataFrame([(i, g, "x") for i, _, g in train], RATINGS)
    settings = Settings(buckets=1 << 16)
    model = fit(*_sample(table, ratings, settings, "doc_id", "text"), settings)
    rows = {r["doc_id"]: r for r in quality_classifier(table, ratings, settings).collect()}
    assert len(rows) == len(texts)
    for i, text in texts:
        grade, tail, kept = plain_judgement(text, model, settings)
        assert abs(rows[i]["expected_grade"] - grade) < 1e-5 and abs(rows[i]["tail_probability"] - tail) < 1e-5
        assert rows[i]["kept"] == kept or abs(tail - model.threshold) < 1e-5


def test_likelihood_is_that_of_a_plain_ascent():
    """Full-batch ascent over the same features, whole matrix and all thresholds at once. With a few hundred ratings the fit stops short of it."""
    settings = Settings(buckets=1 << 12)
    rows = graded(3000, 6)
    features = [np.concatenate([b for _, _, b in text_features(pa.array([t]), settings.buckets)]) for _, t, _ in rows]
    grades = np.array([g for _, _, g in rows])
    model = fit(features, grades, settings)
    dense = np.zeros((len(rows), settings.buckets))
    for i, found in enumerate(features):
        known = found[model.seen[found]]
        dense[i, known] = max(len(known), 1) ** -POWER

    used = np.random.default_rng(settings.seed).permutation(len(rows))[len(rows) // 5 :]
    value = _values([features[i] for i in used], grades[used], 3, settings)

    def likelihood(scores, cuts):
        tail = Ordinal(np.zeros(1), cuts, np.zeros(1)).tail(scores)
        p = np.concatenate([np.ones((len(scores), 1)), tail], axis=1) - np.concatenate([tail, np.zeros((len(scores), 1))], axis=1)
        return np.log(p[np.arange(len(scores)), grades[used]]).mean()

    weights, cuts, x = np.zeros(settings.buckets), _first_cuts(grades, 3), dense[used] * value
    start = likelihood(x @ weights, cuts)
    for _ in range(200):
        by_score, by_cut = likelihood_gradient(x @ weights, cuts, grades[used])
        weights += 0.5 * (x.T @ by_score) / len(used)
        cuts = np.maximum.accumulate(cuts + 0.5 * by_cut / len(used) + np.array([0, 1e-3])) - np.array([0, 1e-3])
    reached = likelihood(dense[used] @ model.weights.astype(float), model.cuts)
    assert reached >= likelihood(x @ weights, cuts) - 0.02 and reached > start + 0.1
