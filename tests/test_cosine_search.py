from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from namewright.operators import cosine_search
from namewright.operators.cosine_search import PivotIndex, most_similar
from namewright.operators.vector_match import nearest_words_of

SCHEMA = "id long, vector array<double>"


def clusters(n, width, seed, spread):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(12, width))
    return [(i, (centres[i % 12] + draw.normal(scale=spread, size=width)).tolist()) for i in range(n)]


def brute(queries, candidates, k, itself=True):
    unit = lambda v: np.array(v) / np.linalg.norm(v)
    names, rows = [c[0] for c in candidates], np.array([unit(c[1]) for c in candidates])
    out = {}
    for name, v in queries:
        scored = sorted((-round(float(s), 9), c) for s, c in zip(rows @ unit(v), names, strict=True) if itself or c != name)
        out[name] = [(c, -s) for s, c in scored[:k]]
    return out


def listed(found):
    out = {}
    for r in sorted(found.collect(), key=lambda r: r["place"]):
        out.setdefault(r["id"], []).append((r["candidate"], r["similarity"]))
    return out


@pytest.mark.parametrize(("spread", "k", "pivots", "block"), [(0.05, 5, 16, 4096), (1.0, 3, 8, 20), (0.2, 200, 4, 50)])
def test_against_all_pairs(spark, spread, k, pivots, block):
    rows = clusters(400, 8, 1, spread) + [(1000 + i, [1.0] + [0.0] * 7) for i in range(30)]
    queries = clusters(60, 8, 1, spread)[::2] + [(5000, [2.0] + [0.0] * 7)]
    odd = [(7000, None), (7001, [0.0] * 8), (7002, [float("nan")] * 8), (7003, [])]
    index = PivotIndex(spark.createDataFrame(rows + odd, SCHEMA), "id", pivots=pivots, bands=4, block=block)
    found, share = most_similar(index, spark.createDataFrame(queries + odd, SCHEMA), "id", k, query_block=17)
    got, expected = listed(found), brute(queries, rows, k)
    assert {q: [c for c, _ in v] for q, v in got.items()} == {q: [c for c, _ in v] for q, v in expected.items()}
    assert all(np.isclose([s for _, s in got[q]], [s for _, s in expected[q]], atol=2e-9).all() for q in got)
    assert share < 0.5 if spread == 0.05 else share <= 1


def test_words_and_their_neighbours(spark):
    rows = [(f"w{i:03}", v) for i, v in clusters(90, 6, 3, 0.1)]
    vectors = spark.createDataFrame(rows, "word string, vector array<double>")
    words = spark.createDataFrame([("w001",), ("w001",), ("w050",), ("none",), (None,)], "word string")
    found = nearest_words_of(vectors, words, 4).orderBy("word", "place").collect()
    expected = brute([r for r in rows if r[0] in ("w001", "w050")], rows, 4, itself=False)
    assert [(r["word"], r["neighbour"]) for r in found] == [(q, c) for q in sorted(expected) for c, _ in expected[q]]


def test_empty_sides_and_widths(spark):
    none = spark.createDataFrame([], SCHEMA)
    some = spark.createDataFrame(clusters(5, 3, 1, 1), SCHEMA)
    assert most_similar(PivotIndex(none, "id"), some, "id", 2)[0].count() == 0
    assert most_similar(PivotIndex(some, "id"), none, "id", 2)[0].count() == 0
    with pytest.raises(ValueError):
        PivotIndex(some.union(spark.createDataFrame([(9, [1.0])], SCHEMA)), "id")


def test_a_query_travels_once_to_each_part(spark):
    rows = spark.createDataFrame(clusters(300, 8, 5, 1.0), SCHEMA)
    index = PivotIndex(rows, "id", pivots=16, bands=4, block=100)
    wanted = cosine_search._wanted(index, rows.withColumn("floor", F.lit(-2.0)), "id", 3, True, -1.0).collect()
    n_bands = len(index.reach.n)
    assert n_bands > 20 and len(wanted) == 300 and {r["n_bands"] for r in wanted} == {n_bands}
    members = {r["part"]: r["count"] for r in index.members.groupBy("part").count().collect()}
    assert {tuple(r["parts"]) for r in wanted} == {tuple(sorted(members))} and len(members) < 6 and max(members.values()) <= 100


def test_parts_hold_bands_in_a_row_and_large_bands_have_several():
    first, several = cosine_search._parts(np.array([3, 4, 5, 25, 2, 8, 1]), 10)
    assert first.tolist() == [0, 0, 1, 2, 5, 5, 6] and several.tolist() == [1, 1, 1, 3, 1, 1, 1]


def copies_and_close_ones():
    """Forty copies, and vectors closer to them than single precision tells."""
    base = np.random.default_rng(8).normal(size=6)
    base /= np.linalg.norm(base)
    turned = np.eye(6)[0] - base[0] * base
    close = [(100 + i, (base + 2e-4 * (1 + (i * 7) % 60 / 60) * turned).tolist()) for i in range(60)]
    return clusters(100, 6, 9, 0.3) + [(1000 - i, base.tolist()) for i in range(40)] + close


@pytest.mark.parametrize("itself", [True, False])
def test_copies_and_vectors_closer_than_single_precision_tells(spark, itself):
    rows = copies_and_close_ones()
    vectors = spark.createDataFrame(rows, SCHEMA)
    found, _ = most_similar(PivotIndex(vectors, "id", pivots=8, bands=4, block=90), vectors, "id", 45, query_block=70, leave_out_itself=not itself)
    got, expected = listed(found), brute(rows, rows, 45, itself)
    assert {q: [c for c, _ in v] for q, v in got.items()} == {q: [c for c, _ in v] for q, v in expected.items()}


@pytest.mark.parametrize(("itself", "k"), [(True, 45), (False, 45), (False, 3)])
def test_search_in_small_products(monkeypatch, itself, k):
    monkeypatch.setattr(cosine_search, "ROWS", 50)
    monkeypatch.setattr(cosine_search, "COLUMNS", 7)
    rows = sorted(copies_and_close_ones())
    vectors = np.array([v for _, v in rows])
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    n = len(rows)
    at = np.arange(n) % 5
    order = np.argsort(at, kind="stable")
    reach = cosine_search.Bands(vectors[:1], np.zeros(5, int), np.arange(5), np.zeros(5), np.full(5, np.pi), np.full(5, n // 5))
    names = np.arange(n)
    row, place, similarity = cosine_search._search(
        reach, vectors, np.full(n, -2.0), np.full(n, -2.0), None if itself else names, vectors[order], at[order], order, None if itself else names[order], k, 9)
    expected = brute(rows, rows, k, itself)
    got = {}
    for r, p in zip(row.tolist(), place.tolist(), strict=True):
        got.setdefault(rows[r][0], []).append(rows[p][0])
    assert got == {q: [c for c, _ in v] for q, v in expected.items()}
