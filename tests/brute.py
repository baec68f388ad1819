"""Plain restatements of the operators' results, row by row, for small inputs."""

from __future__ import annotations

import re

from namewright.config import LETTERS, STOPWORDS


def distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        diagonal, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            diagonal, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, diagonal + (x != y))
    return row[-1]


def edit_similarity(a: str, b: str) -> float:
    return 1 - distance(a, b) / max(len(a), len(b))


def tokens(text: str) -> list[str]:
    folded = text.lower()
    for old, new in LETTERS:
        folded = folded.replace(old, new)
    runs = re.findall(r"(?:(?!\d)\w)+", folded)
    return [t for t in runs if 2 <= len(t) <= 15 and not t.startswith("_")]


def best_target(token, targets, threshold, cosine=lambda a, b: None):
    """Candidates by similarity, then source, then list order."""
    found = []
    for rank, target in enumerate(targets):
        near = cosine(token, target)
        if near is not None and near >= threshold:
            found.append((-near, 1, rank, target))
        close = edit_similarity(token, target)
        if close >= threshold:
            found.append((-close, 3, rank, target))
    return min(found)[1::2] if found else None


def correct(text, targets, threshold, delimiter="|", cosine=lambda a, b: None):
    if text is None:
        return None, None, None, None
    best = {}
    for token in tokens(text):
        found = None if token in STOPWORDS else best_target(token, targets, threshold, cosine)
        if found:
            best.setdefault(token, found)
    order = sorted(best, key=len, reverse=True)
    for token in order:
        target = best[token][1]
        text = re.sub(rf"(?i)\b{re.escape(token)}\b", lambda _: target, text, count=1)
    if not order:
        return text, None, None, None
    return (text, delimiter.join(best[t][1] for t in order), delimiter.join(order),
            delimiter.join(str(best[t][0]) for t in order))


def best_entry(tokens, taxonomy):
    """(score, id, name) of the best of (id, name) pairs; tokens may be None."""
    if tokens is None or not taxonomy:
        return None
    scored = [(-len(set(tokens) & set(name.split(" "))), i, name) for i, name in taxonomy]
    score, i, name = min(scored)
    return -score, i, name
