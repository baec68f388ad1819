from __future__ import annotations

import math
import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from namewright.llm.quality_rules import COMMON_WORDS, Rules, quality_rules
from tests.llm.tables import SCHEMA, awkward, documents, empty, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside)


@settings(max_examples=12, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "b", "c", "aa", "\n", "\n\n", " ", "\t", " ", "#%", "|", "é", "\U0001f600", "\x0b", "a b c\n", "\x1c"]), max_size=40).map(" ".join), min_size=1, max_size=30))
def test_counts(spark, texts):
    rows = {r["doc_id"]: r for r in quality_rules(documents(spark, texts)).collect()}
    for i, text in enumerate(texts):
        r, expected = rows[i], counts(text)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == expected
        assert r["base_failed"] == (expected[0] < 50 or 100 * expected[4] > 50 * expected[0])


def english(seed, n, common):
    words = prose(seed, n).split(" ")
    return " ".join(COMMON_WORDS["en"][i // 3 % 16] if common and i % 3 == 0 else w for i, w in enumerate(words))


def distance(p, q):
    total = sum(p)
    p = [x / total for x in p]
    return round(math.sqrt(max(sum(a * math.log2(2 * a / (a + b)) for a, b in zip(p, q, strict=True) if a) + sum(b * math.log2(2 * b / (a + b)) for a, b in zip(p, q, strict=True) if b), 0) / 2), 6)


def bins(text):
    words, hist = WORD.findall(text), [0] * 6
    for c in text:
        hist[0 if "a" <= c <= "z" else 1 if "A" <= c <= "Z" else 2 if "0" <= c <= "9" else 4 if c > "\x7f" else 5 if WORD.match(c) else 3] += 1
    common = [words.count(w) for w in COMMON_WORDS["en"]]
    return hist, [*common, len(words) - sum(common)]


def test_divergence_from_the_language(spark):
    texts = [english(i, 200 + i, True) for i in range(40)]
    texts += [english(90, 300, False), " ".join(w + "%%%" for w in english(91, 300, True).split(" ")), english(92, 60, False), english(93, 20, True)]
    rows = {r["doc_id"]: r for r in quality_rules(documents(spark, texts), Rules(max_chars_distance=0.2)).collect()}
    judged = [t for t in texts if len(t) >= 200]
    reference = [[sum(h[k] / sum(h) for h in part) / len(part) for k in range(len(part[0]))] for part in ([bins(t)[0] for t in judged], [bins(t)[1] for t in texts if len(t.split(" ")) >= 150])]
    for i, text in enumerate(texts):
        chars, common = bins(text)
        r = rows[i]
        assert r["chars_distance"] is None if len(text) < 200 else abs(r["chars_distance"] - distance(chars, reference[0])) < 2e-6
        assert r["words_distance"] is None if len(text.split(" ")) < 150 else abs(r["words_distance"] - distance(common, reference[1])) < 2e-6
    assert all(rows[i]["kept"] for i in range(40)) and rows[42]["kept"]
    assert not rows[40]["kept"] and not rows[41]["kept"] and not rows[43]["kept"]


def test_long_text_and_awkward_rows(spark):
    text = prose(1, 60_000)
    (row,) = quality_rules(documents(spark, [text + " " + text[:2000]])).collect()
    assert (row["n_words"], row["n_repeat_words"]) == (counts(text + " " + text[:2000])[0], counts(text + " " + text[:2000])[4])
    table = awkward(spark)
    rows = quality_rules(table).collect()
    assert len(rows) == table.count() and all(r["chars_distance"] is None for r in rows)
    assert quality_rules(empty(spark)).count() == 0
    other = spark.createDataFrame([(i, text[:4000], None, "a", 1) for i in range(25)], SCHEMA)
    assert {(r["chars_distance"], r["words_distance"]) for r in quality_rules(other).collect()} == {(0.0, None)}
