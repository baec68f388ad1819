from __future__ import annotations

import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from namewright.llm.license_scan import PHRASES, TEMPLATES, Voting, license_scan
from namewright.llm.queries import op8_license_scan
from tests.llm.tables import awkward, documents, empty, prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(text):
    words = WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))
    places, labels = [], set()
    for phrase, label in PHRASES.items():
        wanted = phrase.split(" ")
        for i in range(len(words) - len(wanted) + 1):
            if words[i : i + len(wanted)] == wanted:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["MIT", "license", "Apache", "general", "public", "Public License", "\n", "–", "x", ".", "é"]), max_size=25).map(" ".join), min_size=1, max_size=40))
def test_base_places(spark, texts):
    got = {r["doc_id"]: r for r in license_scan(documents(spark, texts)).collect()}
    for i, text in enumerate(texts):
        r = got[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], ",".join(r["base_labels"])) == plain(text)
        assert (r["n_base"] > 0) <= (r["score"] == 1.0) and set(r["base_labels"]) <= set(r["labels"])


TEXTS = dict((label, text) for label, text in TEMPLATES)


def test_notices_whole_damaged_and_absent(spark):
    mit = TEXTS["mit-text"]
    words = mit.split(" ")
    inserted = " ".join([*words[:20], "really", *words[20:40], *words[42:]])
    texts = [
        f"{prose(1, 30)} {mit} {prose(2, 10)}", f"{prose(3, 900)}\n{inserted}", " ".join(words[: len(words) // 3]), prose(4, 200),
        "Licensed under CC BY-NC 4.0.", " ".join(reversed(words)), f"{mit} {prose(5, 8)} {mit}", mit.upper(), " ".join(w + " filler" for w in words),
    ]
    got = {r["doc_id"]: r for r in license_scan(documents(spark, texts)).collect()}
    assert [got[i]["labels"] for i in range(9)] == [["mit-text"], ["mit-text"], [], [], ["cc-by-nc-notice"], [], ["mit-text"], ["mit-text"], []]
    assert [len(got[i]["spans"]) for i in (0, 1, 6)] == [1, 1, 2]
    (span,) = got[0]["spans"]
    assert (span["first_word"], span["last_word"], span["score"]) == (30, 30 + len(WORD.findall(mit)) - 1, 1.0)
    assert 0.6 <= got[1]["score"] < 1.0


@pytest.mark.parametrize("voting", [Voting(), Voting(k=3)])
def test_query_on_whole_texts(spark, tmp_path, voting):
    long = f"{prose(7, 250_000)} Released under the MIT License."
    documents(spark, [long, long, None, ""]).write.parquet(str(tmp_path / "documents.parquet"))
    rows = {r["doc_id"]: r for r in op8_license_scan(spark, str(tmp_path)).collect()}
    n = len(WORD.findall(long.lower()))
    for i in (0, 1):
        assert rows[i]["first_word"] == rows[i]["last_word"] == n - 2 and rows[i]["labels"] == "mit,mit-notice"
    assert rows[2]["n_words"] == 0 and rows[3]["labels"] == "" and rows[3]["score"] == 0.0
    assert license_scan(spark.read.parquet(str(tmp_path / "documents.parquet")), voting=voting).count() == 4


def test_awkward_and_empty(spark):
    assert license_scan(awkward(spark)).count() == awkward(spark).count()
    assert license_scan(empty(spark)).count() == 0


def test_whole_texts_are_told_apart(spark):
    whole = [label for label in TEXTS if label.endswith("-license") or label in ("unlicense", "apache-header", "gpl-header")]
    got = {r["doc_id"]: r for r in license_scan(documents(spark, [f"{prose(i, 40)}\n{TEXTS[label]}\n{prose(i + 50, 9)}" for i, label in enumerate(whole)])).collect()}
    for i, label in enumerate(whole):
        best = max(got[i]["spans"], key=lambda s: (s["score"], s["last_word"] - s["first_word"]))
        assert best["label"] == label
        others = {s["label"] for s in got[i]["spans"] if s["label"] in whole} - {label}
        # The disclaimer that both share is most of the shorter one.
        assert others == ({"bsd-2-license"} if label == "bsd-3-license" else set())
        (span,) = [s for s in got[i]["spans"] if s["label"] == label]
        assert (span["first_word"], span["last_word"], span["score"]) == (40, 39 + len(WORD.findall(TEXTS[label].lower())), 1.0)


def plain_spans(text, voting):
    """All pairs of places with the same words, by template and diagonal."""
    words = WORD.findall((text or "").lower())
    spans, k = [], voting.k
    for label, template in TEMPLATES:
        wanted = WORD.findall(template.lower())
        n = len(wanted) - k + 1
        diagonals = {}
        for i in range(len(words) - k + 1):
            for j in range(n):
                if words[i : i + k] == wanted[j : j + k]:
                    diagonals.setdefault(i - j, []).append((i, j))
        bands, before = [], None
        for diagonal, hits in sorted(diagonals.items()):
            first, last = hits[0][0], hits[-1][0]
            if before is None or diagonal - before[0] > voting.band or first - before[1] > n:
                bands.append([])
            bands[-1] += hits
            before = (diagonal, last)
        for hits in bands:
            score, first, last = len({j for _, j in hits}) / n, min(i for i, _ in hits), max(i for i, _ in hits) + k - 1
            if score >= voting.coverage and last - first + 1 <= voting.stretch * (n + k - 1):
                spans.append((first, last, label, round(score, 9)))
    return sorted(spans)


def test_spans_are_those_of_all_pairs_of_places(spark):
    draw = random.Random(8)
    texts = [None, "", "x"]
    for i in range(60):
        pieces = [prose(200 + i, draw.randint(0, 15))]
        for _ in range(draw.randint(1, 4)):
            words = draw.choice(TEMPLATES)[1].split(" ")
            a, b = sorted((draw.randint(0, len(words) // 5), draw.randint(len(words) * 3 // 4, len(words))))
            words = [w for w in words[a:b] if draw.random() > 0.02]
            if draw.random() < 0.4:
                words.insert(draw.randrange(len(words) + 1), "really so")
            pieces.append(" ".join(words))
        texts.append("\n".join(pieces))
    for voting in (Voting(), Voting(k=3, band=1, coverage=0.5)):
        got = {r["doc_id"]: r["spans"] for r in license_scan(documents(spark, texts), voting=voting).collect()}
        found = {i: [(s["first_word"], s["last_word"], s["label"], round(s["score"], 9)) for s in got[i]] for i in got}
        assert found == {i: plain_spans(t, voting) for i, t in enumerate(texts)}
        assert sum(map(len, found.values())) > 60
