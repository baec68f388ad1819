from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from namewright import config
from namewright.config import LETTERS_AND_DIGITS
from namewright.functions import similarity, text
from namewright.operators import fuzzy
from namewright.operators.cleaning import clean_column, taxonomy_words


def values(spark, inputs, expression):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(inputs)], "i int, t string")
    rows = df.select("i", expression(F.col("t")).alias("v")).orderBy("i").collect()
    return [r.v for r in rows]


def test_strip_first_deletes_accented_letters_and_repeats(spark):
    clean = lambda c: text.clean_strip_first(c, punctuation=LETTERS_AND_DIGITS)
    inputs = ["Gestión", "Finance/Tax", "Master  de\tla Master", "", None, "de la", "MBA 2x"]
    assert values(spark, inputs, clean) == ["gestin", "financetax", "master", "", "", "", "mba 2x"]


def test_strip_first_default_pattern_deletes_digits(spark):
    assert values(spark, ["mba 2024 x9"], text.clean_strip_first) == ["mba x"]


def test_strip_first_keeps_and_folds_letters_the_pattern_allows(spark):
    clean = lambda c: text.clean_strip_first(c, punctuation="[!]")
    assert values(spark, ["Gestión!"], clean) == ["gestion"]


def test_fold_first(spark):
    inputs = ["Gestión de Niños", "finance/tax, law", "deé de_x de", None, "a  the  b.", "the"]
    expected = ["gestion ninos", "finance/tax  law", "dee de_x", None, "b", ""]
    assert values(spark, inputs, text.clean_fold_first) == expected


def test_fold_letters_in_sequence(spark):
    chain = lambda c: text.fold_letters(c, [("a", "b"), ("b", "cc")])
    assert values(spark, ["aba"], chain) == ["cccccc"]


def test_match_tokens(spark):
    inputs = ["MBA2x Gestión_a _b 2024 master's", "x" * 16 + " " + "y" * 15, None]
    assert values(spark, inputs, text.match_tokens) == [["mba", "gestion_a", "master"], ["y" * 15], None]


def test_match_words_drop_stopwords_and_repeats(spark):
    assert values(spark, ["master de finance Master"], text.match_words) == [["master", "finance"]]


def test_vector_words_keep_repeats(spark):
    words = lambda c: text.vector_words(text.pipe_words(c))
    assert values(spark, ["Gestión|x-1|de||x1"], words) == [["gestion", "x1", "x1"]]


def test_render_list(spark):
    assert values(spark, ["a b", None], lambda c: text.render_list(F.split(c, " "))) == [
        "['a','b']", "['']"]


def test_first_pipe_word(spark):
    assert values(spark, ["a|b", "c", None], text.first_pipe_word) == ["a", "c", None]


def test_digest_keeps_short_texts_and_shortens_long_ones(spark):
    short, long = values(spark, ["abc", "é" * 5000], text.digest)
    assert short == "abc" and long.startswith("#") and len(long) == 65


def test_clean_column_keeps_position_and_rejects_unknown_mode(spark):
    df = spark.createDataFrame([(1, "A!", 2)], "x int, name string, y int")
    assert clean_column(df, "name").columns == ["x", "name", "y"]
    with pytest.raises(ValueError):
        clean_column(df, "name", mode="other")


def test_taxonomy_words(spark):
    df = spark.createDataFrame([("1", "Degree in Finance"), ("2", "")], "id string, degree_name string")
    rows = {(r.id, r.degree_name, r.words) for r in taxonomy_words(df).collect()}
    assert rows == {("1", "degree finance", "degree"), ("1", "degree finance", "finance"), ("2", "", "")}


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_shared_words_and_cosine_in_both_ansi_modes(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame(
            [(["a", "a", "b"], ["a"], [1.0, 0.0], [2.0, 0.0]), (None, ["a"], None, [1.0, 1.0]),
             (["x"], ["y"], [0.0, 0.0], [1.0, 1.0])],
            "a array<string>, b array<string>, v array<double>, w array<double>")
        rows = df.select(similarity.shared_words(F.col("a"), F.col("b")).alias("n"),
                         similarity.cosine_similarity(F.col("v"), F.col("w")).alias("c")).collect()
        assert [(r.n, r.c) for r in rows] == [(1, 1.0), (None, 0.0), (0, 0.0)]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_edit_similarity_counts_characters(spark):
    df = spark.createDataFrame([("niño", "nino"), ("", "")], "a string, b string")
    rows = df.select(similarity.edit_similarity(F.col("a"), F.col("b")).alias("s")).collect()
    assert [r.s for r in rows] == [0.75, None]


def test_ranged_classes_are_the_negated_ones(spark):
    """Classes of ranges, as the negated ones are far slower; they leave the same."""
    every = "".join(chr(i) for i in [*range(0x500), *range(0x1e00, 0x3100), 0xd7ff, 0xe000, 0xfffd, 0x1f600, 0x10ffff])
    rows = spark.createDataFrame([(every,)], "t string")
    for ranged, negated in ((config.LETTERS_ONLY, r"[^a-z\s]"), (config.LETTERS_AND_DIGITS, r"[^a-z0-9\s]"), (fuzzy._MARKS, "[^a-z0-9 ]")):
        assert "^" not in ranged
        got = rows.select(F.regexp_replace("t", ranged, "").alias("a"), F.regexp_replace("t", negated, "").alias("b")).first()
        assert got["a"] == got["b"]
