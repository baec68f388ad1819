"""Small tables for the tests of the subpackage."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that operators also use for themselves or return.
CLASHING = "_id long, _text string, _row long, _key1 long, kept boolean, n_words long, size long, shard int, copy int, component_id long, _rate double, length long"


def prose(seed: int, n: int) -> str:
    draw = random.Random(seed)
    return " ".join("".join(draw.choices("abcdefghijklmnop", k=draw.randint(2, 7))) for _ in range(n))


def changed(text: str, every: int, word: str = "changed") -> str:
    return " ".join(word if i % every == every - 1 else w for i, w in enumerate(text.split(" ")))


def documents(spark, texts):
    """Texts, or (id, text) pairs, as a table of documents."""
    rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame([(i, t, "en", "a", None if t is None else len(t)) for i, t in rows], SCHEMA)


def awkward(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, and clashing columns."""
    long = prose(1, 40_000)
    rows = [
        (1, "some plain text with a few words", "en", "a"), (1, "some plain text with a few words", "en", "a"),
        (1, "another text of the same id", "fr", "b"), (2, None, "de", "a"), (3, "", None, None), (None, "text of a null id", "xx", "a"),
        (None, None, None, None), (None, None, None, None), (4, " \n\t ", "en", "a"), (5, long, "en", "a"), (6, long, "es", "c"),
        (7, "x" * 5000, "en", "a"), (8, "été 東京 \U0001f600 ıſK", "fr", "b"),
    ]
    names = [c.split(" ") for c in CLASHING.split(", ")]
    table = spark.createDataFrame([(*r, None if r[1] is None else len(r[1])) for r in rows], SCHEMA)
    return table.selectExpr("*", *(f"CAST(7 AS {kind}) AS {name}" if kind != "boolean" else f"true AS {name}" for name, kind in names))


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
