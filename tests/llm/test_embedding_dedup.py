from __future__ import annotations

import numpy as np
import pytest

from namewright.llm.embedding_dedup import close_pairs, embedding_dedup, quantise

SCHEMA = "vec_id long, embedding array<float>, label int, kept boolean, _row long"


def brute(rows, threshold):
    linked = {i: set() for i in range(len(rows))}
    for i, (_, v, a, *_) in enumerate(rows):
        for j, (_, w, b, *_) in enumerate(rows):
            if i == j or a is None or a != b or not usable(v) or not usable(w) or len(v) != len(w):
                continue
            v64, w64 = (np.array(x, dtype=np.float32).astype(np.float64) for x in (v, w))
            if v64 @ w64 / (np.linalg.norm(v64) * np.linalg.norm(w64)) >= threshold:
                linked[i].add(j)
    out = []
    for i, row in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in linked[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        lowest = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((row[0], len(linked[i]), lowest, row[0] == lowest))
    return out


def usable(v):
    return v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)


def key(row):
    return [(v is None, str(v)) for v in row]


@pytest.mark.parametrize("block", [2048, 7])
def test_against_brute_force(spark, block):
    draw = np.random.default_rng(3)
    centres = draw.normal(size=(6, 16))
    rows = []
    for i in range(120):
        vector = centres[i % 6] + draw.normal(scale=0.12, size=16)
        rows.append((200 - i, [float(x) for x in vector], int(i % 2) if i % 11 else None, True, 1))
    rows += [rows[3], rows[3], (900, rows[5][1], rows[5][2], True, 1)]
    rows += [
        (901, None, 0, None, None), (902, [0.0] * 16, 0, True, 1), (903, [float("nan")] + [1.0] * 15, 0, True, 1), (904, [None] + [1.0] * 15, 0, True, 1),
        (905, [float("inf")] * 16, 0, True, 1), (906, [1.0] * 3, 0, True, 1), (907, [1.0] * 3, 0, True, 1), (None, [1.0] * 3, 0, True, 1), (908, [], 0, True, 1),
        (909, [0.0, -0.0, 1.0], 1, True, 1), (910, [-0.0, 0.0, 2.0], 1, True, 1),
    ]
    got = embedding_dedup(spark.createDataFrame(rows, SCHEMA), block_rows=block).collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute(rows, 0.98), key=key)


def test_empty_table(spark):
    assert embedding_dedup(spark.createDataFrame([], SCHEMA)).count() == 0


def test_error_bound_is_rigorous():
    draw = np.random.default_rng(8)
    unit = draw.normal(size=(300, 24))
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    whole, scale, error, near = quantise(unit)
    product = (whole.astype(int) @ whole.astype(int).T) * scale[:, None] * scale[None, :]
    assert (unit @ unit.T <= product + error[:, None] * near[None, :] + error[None, :] + 1e-12).all()
    pairs = {(i, j) for a, b in close_pairs(unit, unit, 0.4) for i, j in zip(a.tolist(), b.tolist(), strict=True)}
    cosine = unit @ unit.T
    assert {tuple(p) for p in np.argwhere(cosine >= 0.4 + 1e-9).tolist()} <= pairs <= {tuple(p) for p in np.argwhere(cosine >= 0.4 - 1e-9).tolist()}
