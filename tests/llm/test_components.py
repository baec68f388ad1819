from __future__ import annotations

import random

from namewright.llm.components import components


def plain(edges):
    near = {}
    for a, b in edges:
        if a is not None and b is not None and a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    out = {}
    for node in near:
        seen, todo = {node}, [node]
        while todo:
            for other in near[todo.pop()] - seen:
                seen.add(other)
                todo.append(other)
        out[node] = min(seen)
    return out


def test_paths_stars_and_noise(spark):
    draw = random.Random(2)
    path = [(i, i + 1) for i in range(100, 180)]
    star = [(500, i) for i in range(501, 560)]
    noise = [(draw.randrange(1000, 1100), draw.randrange(1000, 1100)) for _ in range(60)]
    edges = path + star + noise + noise[:9] + [(7, 7), (None, 3), (-5, -9)]
    got = components(spark.createDataFrame(edges, "src long, dst long")).collect()
    assert {r["id"]: r["component"] for r in got} == plain(edges)


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "src long, dst long")).count() == 0
