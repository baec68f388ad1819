from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from namewright.llm.packing import _Stock, best_fit_pack, encode, plan_patterns, sequences, tokenise, vocabulary
from namewright.llm.queries import op2_best_fit_packing
from tests.llm.tables import awkward, documents, empty, prose

PATH = vocabulary("byte_bpe_50k.json")


def plain_ids(text):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(PATH)
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


@settings(max_examples=200, deadline=None)
@given(st.one_of(st.text(max_size=80), st.text(alphabet="aé 'st\n\t|<%1 ́", max_size=60)))
def test_both_encoders_agree(text):
    assert [*encode(text, PATH), 2] == plain_ids(text)


def test_long_runs_and_special_strings():
    for text in ("a" * 3000, " " * 3000, "\n" * 1500 + "x", "<|endoftext|>", prose(1, 3000), "!?" * 900):
        assert [*encode(text, PATH), 2] == plain_ids(text)


def test_an_added_token_in_a_text_is_that_token():
    for text in ("a <|endoftext|> b", "<|endoftext|>" * 3, prose(2, 900) + "<|endoftext|>"):
        assert 50256 in encode(text, PATH) and [*encode(text, PATH), 2] == plain_ids(text)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(0, 9), max_size=25))
def test_patterns_use_everything_up(lengths):
    patterns = plan_patterns(lengths, 40)
    used = Counter()
    for pattern, times in patterns:
        assert times > 0 and sum(pattern) <= 40
        used.update({length: n * times for length, n in Counter(pattern).items()})
    assert used == Counter({k: v for k, v in lengths.items() if v})
    assert len(patterns) <= 80
    assert sum(times for _, times in patterns) <= best_fit_decreasing(lengths, 40)


def best_fit_decreasing(lengths, capacity):
    gaps = []
    for length in sorted(Counter(lengths).elements(), reverse=True):
        fitting = [gap for gap in gaps if gap >= length]
        if fitting:
            gaps.remove(min(fitting))
        gaps.append((min(fitting) if fitting else capacity) - length)
    return len(gaps)


@pytest.mark.parametrize("seed", range(6))
def test_no_more_sequences_than_best_fit_decreasing(seed):
    draw = random.Random(seed)
    spread = (lambda: draw.randint(1, 1024), lambda: min(1024, int(draw.lognormvariate(5.5, 1)) + 1), lambda: draw.choice([1024, 700, 130, 324, 5, 512, 171]))
    lengths = Counter(spread[seed % 3]() for _ in range(1500))
    n = sum(times for _, times in plan_patterns(lengths, 1024))
    assert -(-sum(length * c for length, c in lengths.items()) // 1024) <= n <= best_fit_decreasing(lengths, 1024)


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 3), min_size=1, max_size=12), st.randoms())
def test_sums_follow_the_lengths_in_stock(lengths, draw):
    stock = _Stock(lengths, 30)
    for length in draw.sample(sorted(lengths), draw.randint(0, len(lengths))):
        while stock.counts[length]:
            stock.spend(Counter([length]))
    left = [k for k, n in stock.counts.items() if n]
    pairs, triples = Counter(a + b for a in left for b in left), Counter(a + b + c for a in left for b in left for c in left)
    assert stock.pairs.tolist() == [pairs[s] for s in range(31)] and stock.triples.tolist() == [triples[s] for s in range(31)]


def test_exact_complements_fill_sequences():
    # A single, a pair and a triple complement; nothing is left over.
    assert sorted(plan_patterns({90: 2, 10: 2}, 100)) == [((90, 10), 2)]
    assert plan_patterns({80: 1, 12: 1, 8: 1, 9: 1}, 100)[0] == ((80, 12, 8), 1)
    assert plan_patterns({70: 3, 14: 3, 10: 3, 6: 3}, 100) == [((70, 14, 10, 6), 3)]
    assert plan_patterns({60: 2, 20: 3, 5: 1}, 100) == [((60, 20, 20), 1), ((60, 20, 5), 1)]
    draw = random.Random(3)
    lengths = Counter(draw.randint(1, 1024) for _ in range(20_000))
    n = sum(times for _, times in plan_patterns(lengths, 1024))
    assert n <= 1.01 * sum(length * c for length, c in lengths.items()) / 1024 + 1


def checked(rows, capacity=1024):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in by_sequence.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= capacity
    return len(by_sequence)


def test_query_against_plain_packing(spark, tmp_path):
    texts = [prose(i, 3 + 37 * i % 900) for i in range(60)] + [prose(90, 2500), "", None, "tiny"]
    documents(spark, texts).write.parquet(str(tmp_path / "documents.parquet"))
    rows = op2_best_fit_packing(spark, str(tmp_path)).collect()
    expected = []
    for doc, text in enumerate(texts):
        ids = plain_ids(text)
        first = len(ids) % 1024 or 1024
        edges = [0, *range(first, len(ids), 1024), len(ids)]
        for piece, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
            expected.append((doc, piece, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == sorted(expected)
    assert checked(rows) <= -(-sum(e[3] for e in expected) // 1024) + 1


@pytest.mark.parametrize("part", [100_000, 5])
def test_hot_length_in_parts(spark, part):
    pieces = spark.createDataFrame([(i, 0, 7 if i % 3 else 100) for i in range(300)], "doc_id long, piece int, length long")
    rows = best_fit_pack(pieces, 128, part).collect()
    assert len(rows) == 300 and checked(rows, 128) == 100


def test_sequences_hold_the_ids(spark):
    table = documents(spark, ["one two three", "four five", "six " * 40, None])
    packed = best_fit_pack(tokenise(table, capacity=16), 16)
    found = {r["sequence_id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in sequences(packed).collect()}
    for r in packed.collect():
        assert found[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]] == np.frombuffer(r["ids"], "<u4").tolist()
    assert all(len(ids) <= 16 for ids in found.values())


def test_awkward_and_empty(spark):
    table = awkward(spark)
    rows = best_fit_pack(tokenise(table).drop("ids")).collect()
    checked(rows)
    assert Counter(r["doc_id"] for r in rows if r["piece"] == 0) == Counter(r["doc_id"] for r in table.select("doc_id").collect())
    assert best_fit_pack(tokenise(empty(spark))).count() == 0
    with pytest.raises(ValueError):
        best_fit_pack(table.select("doc_id", F.lit(0).alias("piece"), F.lit(2000).alias("length")))
