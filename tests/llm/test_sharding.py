from __future__ import annotations

import random
import zlib

import pytest

from namewright.llm.queries import op7_sharding
from namewright.llm.sharding import MAP_SCHEMA, rebalance, shard_documents
from tests.llm.tables import awkward, documents, empty, prose


def checked(rows):
    by_shard = {}
    for r in rows:
        by_shard.setdefault(r["shard"], []).append(r)
    for shard in by_shard.values():
        assert sorted(r["place"] for r in shard) == list(range(len(shard)))
    return {k: sum(r["size"] for r in v) for k, v in by_shard.items()}


def test_query(spark, tmp_path):
    texts = [prose(i, 1 + i % 90) for i in range(600)] + [None, "", "été"]
    documents(spark, texts).write.parquet(str(tmp_path / "documents.parquet"))
    rows = op7_sharding(spark, str(tmp_path)).collect()
    raw = [(t or "").encode() for t in texts]
    assert sorted((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == [(i, len(t) + 8, zlib.crc32(t)) for i, t in enumerate(raw)]
    loads = {}
    for r in rows:
        loads.setdefault(r["shard"], []).append(r)
    assert set(loads) <= set(range(24)) and {r["law"] for r in rows} == {"bytes"}
    for shard in loads.values():
        assert sorted(r["slot"] for r in shard) == list(range(len(shard)))
    sizes = [sum(r["size"] for r in shard) for shard in loads.values()]
    assert len(sizes) == 24 and max(sizes) - min(sizes) <= max(len(t) + 8 for t in raw)


@pytest.mark.parametrize("part", [100_000, 40])
def test_hot_record_is_split(spark, part):
    rows = shard_documents(documents(spark, [(7, "the same text again")] * 500 + [(i, prose(i, 9)) for i in range(700)]), 4, slots=64, rows_per_part=part).collect()
    assert len(rows) == 1200
    loads = checked(rows)
    assert max(loads.values()) < 1.1 * min(loads.values())


def test_map_keeps_versions_and_moves_little(spark, tmp_path):
    path = str(tmp_path / "map")
    table = documents(spark, [prose(i, 1 + i % 60) for i in range(800)])
    shard_documents(table, 5, slots=256, map_path=path).count()
    shard_documents(table, 6, slots=256, map_path=path).count()
    kept = spark.read.schema(MAP_SCHEMA).parquet(path).collect()
    assert {r["version"] for r in kept} == {1, 2, 3}
    second, third = ({r["slot"]: r["shard"] for r in kept if r["version"] == v} for v in (2, 3))
    assert set(second) == set(third) == set(range(256))
    assert sum(second[s] != third[s] for s in second) < 256 * 0.35


def test_rebalance_levels():
    draw = random.Random(4)
    sizes = {(i, 0): draw.randint(1, 100) for i in range(900)}
    after = rebalance({u: 0 for u in sizes}, sizes, 7)
    loads = [sum(sizes[u] for u in sizes if after[u] == s) for s in range(7)]
    assert set(after) == set(sizes) and max(loads) - min(loads) <= 100


def test_awkward_and_empty(spark):
    rows = shard_documents(awkward(spark), 3).collect()
    assert len(rows) == awkward(spark).count()
    checked(rows)
    assert [r["size"] for r in rows if r["doc_id"] == 2] == [8]
    assert shard_documents(empty(spark), 3).count() == 0
