from __future__ import annotations

import hashlib
import itertools

import numpy as np
import pytest

from namewright.llm import vector_codes as codes
from namewright.llm.queries import op12_vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int, code string, _row long, error string"


def usable(v):
    return v is not None and all(x is not None and np.isfinite(x) for x in v)


def plain(rows):
    kept = [r for r in rows if usable(r[1])]
    whole = np.array([[int(np.floor(1024 * np.float64(np.float32(x)))) for x in r[1]] for r in kept], dtype=object)
    width = whole.shape[1] // 4
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, list(whole[i])))[:256]
    books = [[list(whole[i][p * width : p * width + width]) for i in order] for p in range(4)]
    for turn in range(5):
        chosen, far = [[0] * len(kept) for _ in range(4)], [0] * len(kept)
        for p in range(4):
            entries = np.array(books[p], dtype=np.int64)
            for i in range(len(kept)):
                d = np.square(entries - whole[i][p * width : p * width + width].astype(np.int64)).sum(axis=1)
                chosen[p][i] = int(d.argmin())
                far[i] += int(d.min())
        if turn == 4:
            break
        for p in range(4):
            for e in range(len(books[p])):
                own = [whole[i][p * width : p * width + width] for i in range(len(kept)) if chosen[p][i] == e]
                if own:
                    books[p][e] = [sum(column) // len(own) for column in zip(*own, strict=True)]
    total = {}
    for r, d in zip(kept, far, strict=True):
        total[r[2]] = total.get(r[2], 0) + d
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return [(r[0], "".join(f"{chosen[p][i]:02x}" for p in range(4)), far[i], total[r[2]], digest) for i, r in enumerate(kept)]


def key(row):
    return [(v is None, str(v)) for v in row]


def table(n, width, seed=1, scale=1.0):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(9, width))
    rows = [(3 * i, [float(x) * scale for x in centres[i % 9] + draw.normal(scale=0.2, size=width)], i % 4 or None, "z", 1, "e") for i in range(n)]
    rows += [rows[0], rows[0], (1, rows[5][1], 2, None, None, None), (None, rows[7][1], None, None, None, None), (None, [0.0] * width, 7, None, 1, "x")]
    rows += [(5, None, 1, None, None, None), (6, [None] * width, 1, None, 1, None), (7, [float("nan")] * width, 1, None, 1, None),
             (8, [1.0] * (width - 1) + [float("-inf")], 1, None, 1, None)]
    return rows


@pytest.mark.parametrize(("n", "width", "scale"), [(700, 8, 1.0), (40, 16, 1.0), (300, 4, 40_000.0), (8, 8, 1.0)])
def test_query_against_plain_form(spark, tmp_path, n, width, scale):
    rows = table(n, width, scale=scale)
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(str(tmp_path / "embeddings.parquet"))
    got = op12_vector_codes(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got), key=key) == sorted(plain(rows), key=key)


@pytest.mark.parametrize(("block", "row"), [(1, 1), (4, 8), (64, 64)])
def test_blocks_of_any_size_give_the_same_codes(spark, tmp_path, monkeypatch, block, row):
    monkeypatch.setattr(codes, "BLOCK", block)
    monkeypatch.setattr(codes, "ROW", row)
    rows = table(120, 8)
    found, _ = codes.compress(spark.createDataFrame(rows, SCHEMA))
    expected = sorted(((r[0], r[1], r[2]) for r in plain(rows)), key=key)
    assert sorted(((r["vec_id"], r["code"], r["error"]) for r in found.collect()), key=key) == expected


def test_shortlists_hold_every_nearest_entry():
    draw = np.random.default_rng(2)
    singles = 0
    for spread in (0, 1, 5, 30, 200):
        for _ in range(40):
            values = draw.integers(-100, 100, size=3) + draw.integers(-spread, spread + 1, size=(16, 3))
            entries = draw.integers(-100, 100, size=(50, 3))
            entries = np.concatenate([entries, entries[:5]])
            chosen = codes.shortlist(values.min(axis=0), values.max(axis=0), entries)
            best, distance = codes.nearest(values, entries[chosen])
            exact = np.square(values[:, None] - entries[None]).sum(axis=2)
            assert (chosen[best] == exact.argmin(axis=1)).all() and (distance == exact.min(axis=1)).all()
            singles += len(chosen) == 1
    assert singles


def test_kernels_are_exact_beyond_doubles():
    draw = np.random.default_rng(4)
    values, entries = (draw.integers(-(1 << 27), 1 << 27, size=(n, 4)) for n in (20, 9))
    best, distance = codes.nearest(values, entries)
    exact = [[sum((int(a) - int(b)) ** 2 for a, b in zip(v, e, strict=True)) for e in entries] for v in values]
    assert distance.tolist() == [min(d) for d in exact] and best.tolist() == [d.index(min(d)) for d in exact]


@pytest.mark.parametrize(("width", "bits"), [(2, 4), (3, 3), (4, 2)])
def test_curve_visits_neighbours(width, bits):
    points = np.array(list(itertools.product(range(1 << bits), repeat=width)))
    numbers = codes.hilbert(points, bits)
    assert sorted(numbers.tolist()) == list(range(len(points)))
    assert (np.abs(np.diff(points[np.argsort(numbers)], axis=0)).sum(axis=1) == 1).all()


def test_a_hot_vector_spreads_over_tasks(spark):
    rows = [(i, [1.0, 2.0, 3.0, 4.0] if i % 3 else [float(i)] * 4, 1, None, None, None) for i in range(3000)]
    whole = codes.whole_vectors(spark.createDataFrame(rows, SCHEMA), "vec_id", "embedding", "label")
    blocks = codes.hilbert_blocks(whole, 1, 0, 3000 * 1024, 8)
    sizes = [r["n"] for r in blocks.selectExpr("_metadata.file_name AS f", "n").groupBy("f").sum("n").toDF("f", "n").collect()]
    assert sum(sizes) == 12_000 and max(sizes) < 4000


def test_errors_and_empty(spark):
    found, books = codes.compress(spark.createDataFrame([(1, None, 1, None, None, None)], SCHEMA))
    assert found.columns == ["vec_id", "label", "code", "error"] and found.count() == 0 and books.sha256() == hashlib.sha256(b"").hexdigest()
    assert codes.label_errors(found).count() == 0
    for rows in ([(1, [1.0] * 4), (2, [1.0] * 8)], [(1, [1.0] * 6)], [(1, [])], [(1, [1e30] * 4)], [(1, [-3e5] * 4)]):
        with pytest.raises(ValueError):
            codes.compress(spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS label"))
