from __future__ import annotations

import hashlib
import math
from collections import Counter

import pytest

from namewright.llm.mixing import mix_sources, tempered_targets
from tests.llm.tables import SCHEMA, awkward, empty


def poisson(mean, u):
    k, p = 0, math.exp(-mean)
    total = p
    while total <= u:
        k += 1
        p = p * mean / k
        total += p
    return k


def plain_count(rate, doc, source, text):
    draws = max(math.ceil(rate / 32), 1)
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    own = md5(f"7:{'' if doc is None else doc}:{source or ''}:{md5(text or '')}")
    return sum(poisson(rate / draws, int(md5(f"{own}:{j}")[:13], 16) / 2**52) for j in range(draws))


@pytest.fixture(scope="module")
def table(spark):
    rows = [(i, f"text {i}", "en", "big" if i % 3 else ("small" if i % 2 else None), 6) for i in range(3000)]
    return spark.createDataFrame(rows, SCHEMA)


def test_counts_invert_the_distribution(spark, table):
    targets = spark.createDataFrame([("big", 1.0), ("small", 2.0), (None, 1.0), ("absent", 9.0)], "source string, weight double")
    rows = mix_sources(table, targets, size=1.5).collect()
    got = Counter(r["doc_id"] for r in rows)
    sizes = Counter(r["source"] for r in table.select("source").collect())
    weights = {"big": 1.0, "small": 2.0, None: 1.0}
    for r in table.collect():
        rate = 1.5 * 3000 * (weights[r["source"]] / 4) / sizes[r["source"]]
        assert got[r["doc_id"]] == plain_count(rate, r["doc_id"], r["source"], r["text"])
    assert all(sorted(r["copy"] for r in rows if r["doc_id"] == d) == list(range(got[d])) for d in list(got)[:50])
    shares = Counter(r["source"] for r in rows)
    assert abs(shares["small"] / len(rows) - 0.5) < 0.05


def test_high_rates_and_missing_targets(spark, table):
    targets = spark.createDataFrame([("small", 1.0), ("big", 0.0)], "source string, weight double")
    rows = mix_sources(table, targets, size=20.0).collect()
    assert {r["source"] for r in rows} == {"small"}
    assert abs(len(rows) / 60_000 - 1) < 0.02


def test_tempered_targets_and_order(spark, table):
    weights = {r["source"]: r["weight"] for r in tempered_targets(table).collect()}
    assert weights == {"big": math.sqrt(2000), "small": math.sqrt(500), None: math.sqrt(500)}
    parts = mix_sources(table, tempered_targets(table)).rdd.glom().map(lambda p: [r["shuffle_key"] for r in p]).collect()
    assert all(p == sorted(p) for p in parts)
    assert len({key for p in parts for key in p}) == sum(map(len, parts))


def test_awkward_and_empty(spark):
    table = awkward(spark)
    got = mix_sources(table, tempered_targets(table), size=3.0)
    assert [c for c in got.columns if c not in ("copy", "shuffle_key")] == [c for c in table.columns if c != "copy"]
    assert {r["source"] for r in got.collect()} <= {"a", "b", "c", None}
    assert mix_sources(empty(spark), tempered_targets(empty(spark))).count() == 0
