from __future__ import annotations

import random

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from namewright.llm import near_dedup as module
from namewright.llm.near_dedup import FREQUENCY_BUCKETS, Sampler, Settings, near_dedup, near_unique, similar_pairs
from namewright.llm.words import words
from tests.llm.tables import awkward, changed, documents, empty, prose

ENTRY_DIR = "/root/testdata/sf0.001"
EVEN = np.ones(FREQUENCY_BUCKETS, dtype=np.float32)


def similarity(a, b):
    def weights(text):
        words, counts = text.lower().split(), {}
        for i in range(max(len(words) - 4, 1)):
            gram = tuple(words[i : i + 5])
            counts[gram] = counts.get(gram, 0) + 1
        return {g: 1 + np.log(n) for g, n in counts.items()}

    x, y = weights(a), weights(b)
    common = sum(min(x[g], y[g]) for g in x.keys() & y.keys())
    return common / (sum(x.values()) + sum(y.values()) - common)


def test_pairs_are_exact():
    base = prose(1, 200)
    texts = [base, changed(base, 60), changed(base, 40), changed(base, 25), base + " " + base[:300], prose(2, 150), "one two three", "one two three four"]
    places = np.arange(len(texts))
    got = {(i, j) for a, b in similar_pairs(pd.Series(texts), EVEN, Settings(threshold=0.6), places, places) for i, j in zip(a.tolist(), b.tolist(), strict=True)}
    assert {(i, j) for i, j in got if i != j} == {
        (i, j) for i, a in enumerate(texts) for j, b in enumerate(texts) if i != j and similarity(a, b) >= 0.6
    }


def test_samples_agree_as_often_as_texts_are_similar():
    draw = np.random.default_rng(4)
    ids = draw.integers(0, 1 << 44, 600).astype(np.uint64)
    left, right = draw.uniform(0.5, 3, 400), draw.uniform(0.5, 3, 400)
    both = np.concatenate([ids[:400], ids[200:]])
    codes = Sampler(3000)(np.array([0, 400, 800]), both, np.concatenate([left, right]))
    a, b = dict(zip(ids[:400].tolist(), left, strict=True)), dict(zip(ids[200:].tolist(), right, strict=True))
    low = sum(min(a[i], b[i]) for i in a.keys() & b.keys())
    expected = low / (sum(a.values()) + sum(b.values()) - low)
    assert abs((codes[:, 0] == codes[:, 1]).mean() - expected) < 0.035


@pytest.mark.parametrize("blocks", [(1024, 16 << 20), (3, 4000)])
def test_groups(spark, blocks):
    base, other = prose(5, 220), prose(6, 300)
    texts = [changed(base, 100), base, base, other, changed(base, 90), changed(other, 150), prose(7, 90), "few words", "few words", "few other words"]
    got = near_dedup(documents(spark, texts), settings=Settings(block_rows=blocks[0], block_bytes=blocks[1])).collect()
    groups = {r["doc_id"]: r["component_id"] for r in got}
    assert groups == {0: 0, 1: 0, 2: 0, 4: 0, 3: 3, 5: 3, 6: 6, 7: 7, 8: 7, 9: 9}
    assert sorted(r["doc_id"] for r in got if r["kept"]) == [0, 3, 6, 7, 9]


def test_awkward_rows(spark):
    table = awkward(spark)
    got = near_dedup(table).collect()
    assert len(got) == table.count()
    kept = [r for r in got if r["kept"]]
    # Two texts of id 1; null text with and without an id is one group; the long text twice; five others.
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept) == [(False, 1), (False, 1), (False, 2), (False, 3), (False, 4), (False, 5), (False, 7), (False, 8), (True, 0)]
    single = near_unique(table)
    assert single.columns == table.columns and single.count() == len(kept)


def test_empty_table(spark):
    assert near_dedup(empty(spark)).count() == 0 and near_unique(empty(spark)).count() == 0


def test_long_text_is_read_whole():
    base = prose(9, 300_000)
    assert len(base) > module.FREQUENCY_BUCKETS
    texts = pd.Series([base, base[: len(base) // 2] + prose(10, 150_000)])
    assert list(similar_pairs(texts, EVEN, Settings(), np.array([0]), np.array([1])))[0][0].size == 0


def test_short_texts_do_not_depend_on_what_follows(spark):
    short = ["Thank you!", "thank you", "Thank\nYOU\n", "you thank", "thank you so", "One", "one.", "one one", "A b c d", "a, b, c, d!", "a b c d e"]
    texts = [t for i, s in enumerate(short) for t in (s, prose(100 + i, 40))]
    expected = {0: 0, 1: 0, 2: 0, 3: 3, 4: 4, 5: 5, 6: 5, 7: 7, 8: 8, 9: 8, 10: 10}
    got = near_dedup(documents(spark, texts).coalesce(1)).collect()
    groups = {r["doc_id"]: r["component_id"] for r in got}
    assert {i: groups[2 * i] // 2 for i in range(len(short))} == expected
    assert all(groups[2 * i + 1] == 2 * i + 1 for i in range(len(short)))
    assert {r["n_shingles"] for r in got if r["doc_id"] % 2 == 0} == {1}
    # A batch or a tile of their own, and in another order.
    apart = near_dedup(documents(spark, list(enumerate(short))[::-1]).repartition(11)).collect()
    assert {r["doc_id"]: r["component_id"] for r in apart} == expected


def test_repeated_rows_meet_the_tiles_once(spark):
    base = prose(11, 120)
    rows = documents(spark, [(1, base)] * 50 + [(None, base)] * 50 + [(2, changed(base, 60))]).selectExpr("doc_id AS _id", "text AS _text")
    rows = rows.withColumns(module._text_keys())
    signed = rows.dropDuplicates().withColumn("_row", F.expr("coalesce(_id, 9L)"))
    members = spark.createDataFrame([(1, 0), (1, 1), (2, 0), (9, 0)], "_row long, _high long")
    got = module._texts_of(rows.repartition(7), signed, members).collect()
    assert sorted((r["_row"], r["_text"]) for r in got) == [(1, base), (2, changed(base, 60)), (9, base)]


def every_link(texts, weights):
    """All pairs at or above 0.8, by the weights of the whole table, through lists of what each shingle is in."""
    vectors, holders, links = [], {}, set()
    for i, text in enumerate(texts):
        found = {}
        for part in words(pa.array([text], pa.string())):
            _, ids, counts = module.shingles(part, 5)
            found |= dict(zip(ids.tolist(), (weights[module._bucket(ids)] * (1 + np.log(counts))).tolist(), strict=True))
        vectors.append(found)
        for shingle in found:
            holders.setdefault(shingle, []).append(i)
    shared = {(a, b) for group in holders.values() for n, a in enumerate(group) for b in group[n + 1 :]}
    for a, b in shared:
        x, y = vectors[a], vectors[b]
        common = sum(min(w, y[g]) for g, w in x.items() if g in y)
        if common >= 0.8 * (sum(x.values()) + sum(y.values()) - common) - 1e-9:
            links.add((a, b))
    return links


def test_recall_against_all_pairs_with_the_weights_of_the_table(spark):
    given = [r["text"] for r in spark.read.parquet(f"{ENTRY_DIR}/documents.parquet").orderBy("doc_id").collect()]
    draw, texts = random.Random(12), list(given)
    for i in range(40):
        base = prose(700 + i, draw.randint(60, 400))
        texts += [base, *(changed(base, draw.choice((30, 45, 50, 60, 80, 120)), draw.choice(("changed", "altered"))) for _ in range(3))]
    table = documents(spark, texts)
    keyed = table.selectExpr("doc_id AS _id", "text AS _text")
    weights = module._weights(keyed, Settings())
    assert len(set(weights.round(3).tolist())) > 3
    links = every_link(texts, weights)
    root = list(range(len(texts)))
    for a, b in sorted(links):
        low, high = sorted((root[a], root[b]))
        root = [low if r == high else r for r in root]
    groups = {r["doc_id"]: r["component_id"] for r in near_dedup(table).collect()}
    unequal = [(a, b) for a, b in links if texts[a] != texts[b]]
    assert len(unequal) > 60
    found = sum(groups[a] == groups[b] for a, b in unequal)
    assert found >= 0.99 * len(unequal)
    # No document is in a group that the links don't make.
    assert all(root[i] == root[g] for i, g in groups.items())
