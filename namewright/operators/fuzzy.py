"""Correction of words against a target list, by edit similarity and optionally by embeddings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from namewright.config import LETTERS, SOURCE_EDIT, SOURCE_EMBEDDING, STOPWORDS
from namewright.functions import text
from namewright.operators.attach import ROWS_PER_SPLIT, attach
from namewright.operators.cosine_match import cosine_matches
from namewright.operators.edit_match import edit_matches
from namewright.sources.staging import stage

CORRECTION_COLUMNS = ("name_corrected", "matched_words", "original_tokens_matched", "model_sources")


def as_targets(spark: SparkSession, targets: DataFrame | Sequence[str]) -> DataFrame:
    """Targets as (target, rank); a list ranks by position, a frame without rank by the word."""
    if not isinstance(targets, DataFrame):
        rows = list(enumerate(targets))
        targets = spark.createDataFrame(rows, "rank int, target string")
    elif "rank" not in targets.columns:
        targets = targets.withColumn("rank", F.col("target"))
    ranked = targets.where(F.col("target") != "").groupBy("target")
    return ranked.agg(F.min("rank").alias("rank"))


def text_tokens(
    df: DataFrame, column: str, stopwords: Sequence[str] = STOPWORDS, letters: text.Letters = LETTERS
) -> DataFrame:
    """The distinct match tokens of a column, as ``token``."""
    tokens = df.select(F.explode(text.match_tokens(F.col(column), letters)).alias("token"))
    return tokens.where(~F.col("token").isin(*stopwords)).distinct()


def correction_dictionary(
    tokens: DataFrame, targets: DataFrame, threshold: float, vectors: DataFrame | None = None
) -> DataFrame:
    """Best target per token: (token, target, source, similarity), unmatched tokens left out.

    ``tokens`` holds distinct tokens, ``targets`` (target, rank), ``vectors`` (word, vector).
    The highest similarity wins; ties prefer the embedding, then the lowest rank.
    """
    matches = edit_matches(tokens, targets, threshold).withColumn("source", F.lit(SOURCE_EDIT))
    if vectors is not None:
        known = vectors.select(F.col("word").alias("token"), "vector")
        near = cosine_matches(
            tokens.join(known, "token"),
            targets.join(known.withColumnRenamed("token", "target"), "target"),
            threshold,
        )
        matches = matches.unionByName(near.withColumn("source", F.lit(SOURCE_EMBEDDING)))
    order = F.struct(-F.col("similarity"), F.col("source"), F.col("rank"), F.col("target"))
    best = F.min_by(F.struct("target", "source", "similarity"), order)
    return matches.groupBy("token").agg(best.alias("best")).select("token", "best.*")


#: Letters whose upper or lower case is not one letter, or depends on those around it.
_UNEVEN_CASE = r"[ßİŉǰΐΣΰςσևẖ-ẚẞἀ-῿ﬀ-ﬗ]"


#: All but a-z, digits and blanks; in ranges, which Java matches far faster than the negated class.
_MARKS = r"[\x00-\x1f!-/:-`{-\x{10ffff}]"


def _folded(value: Column) -> Column:
    return F.lower(F.upper(value))


def _rebuilt(df: DataFrame, column: str) -> DataFrame:
    """Add ``name_corrected``: each match replaces its first whole-word occurrence in turn, on the running text.

    Plain texts are distinct words of letters and digits, none both replaced and inserted. Their words and changes are
    sorted together, each word takes the change before it, and the words go back to their places: n log n
    for the longest text. Other texts are cut once into words and what lies between, see ``_pieced``. What neither can
    express is replaced match by match. The steps are columns, so that none is evaluated again for every word.
    """
    name, words, changes, together = (F.col(c) for c in (column, "_words", "_changes", "_together"))
    plain = (
        ~F.rlike(name, F.lit(_MARKS))
        & ~F.array_contains(words, "")
        & (F.size(F.array_distinct(words)) == F.size(words))
        & F.forall(changes, lambda m: F.rlike(m["target"], F.lit("^[a-z0-9]+$")))
        & ~F.arrays_overlap(changes["token"], changes["target"])
    )
    own = F.transform(words, lambda w, i: F.struct(w.alias("word"), i.alias("place"), F.lit(None).cast("string").alias("target")))
    new = F.transform(changes, lambda m: F.struct(m["token"].alias("word"), F.lit(-1).alias("place"), m["target"].alias("target")))

    def chosen(entry: Column, i: Column) -> Column:
        before = F.when(i > 0, F.get(together, i - 1))
        hit = (before["place"] == -1) & (before["word"] == entry["word"])
        return F.struct(entry["place"].alias("place"), F.when(hit, before["target"]).otherwise(entry["word"]).alias("word"))

    placed = F.sort_array(F.filter(F.transform(together, chosen), lambda e: e["place"] >= 0))
    blank, edge = F.lit(r"(?isu)^(.*?)(?<!"), text.WORD_CHAR
    general = F.aggregate(
        F.col("_matches"),
        name,
        lambda running, m: F.regexp_replace(
            running,
            F.concat(blank, F.lit(edge + ")"), m["token"], F.lit(f"(?!{edge})")),
            F.concat(F.lit("$1"), F.regexp_replace(m["target"], r"([\\$])", r"\\$1")),
        ),
    )
    unchanged = name.isNull() | F.col("_matches").isNull() | (F.size("_matches") == 0)
    sorted_in = (
        df.withColumns({"_words": F.split(name, " "), "_changes": F.filter("_matches", lambda m: m["token"] != m["target"])})
        .withColumn("_plain", ~unchanged & plain)
        .withColumn("_together", F.when(F.col("_plain"), F.sort_array(F.concat(own, new))))
        .withColumn("_placed", F.when(F.col("_plain"), placed))
    )
    return (
        _pieced(sorted_in, column, ~unchanged & ~F.col("_plain"))
        .withColumn(
            "name_corrected",
            F.when(unchanged, name).when(F.col("_plain"), F.array_join(F.transform("_placed", lambda e: e["word"]), " "))
            .when(F.col("_apart"), F.col("_joined")).otherwise(general),
        )
        .drop("_words", "_changes", "_plain", "_together", "_placed", "_apart", "_steps", "_joined")
    )


def _pieced(df: DataFrame, column: str, wanted: Column) -> DataFrame:
    """Adds ``_apart``, whether a text is put together from its pieces, and ``_joined``, the text then.

    A token occurs as a whole word exactly where a run of word characters equals it but for case. A replaced run becomes its
    target, which is a run too, so places never move. A match takes the first place of its token: the first in the text, or that of an
    earlier match with this target if it lies before. Each place ends as the last match that took it left it. Tokens and runs are sorted
    together to find the first places, targets and pieces to put the text together: n log n in words and matches, whatever marks and
    repeats there are. Not so where a match could take what was inserted at a place that was itself taken so, or part of a
    longer target, or where letters have no simple case.
    """
    steps = F.transform("_matches", lambda m, i: F.struct(_folded(m["token"]).alias("key"), i.alias("step"), _folded(m["target"]).alias("made"), m["target"].alias("target")))
    later = F.array_intersect(F.transform("_steps", lambda s: s["key"]), F.transform("_steps", lambda s: s["made"]))
    longer = F.filter(F.transform("_steps", lambda s: s["made"]), lambda t: F.rlike(t, F.lit(f"[^{text.WORD_CHAR[1:]}")))
    inner = F.flatten(F.transform(longer, lambda t: F.split(t, f"[^{text.WORD_CHAR[1:]}+")))
    simple = (
        ~F.rlike(F.col(column), F.lit(_UNEVEN_CASE))
        & F.forall("_steps", lambda s: ~F.rlike(s["made"], F.lit(_UNEVEN_CASE)))
        & ~F.arrays_overlap(inner, F.transform("_steps", lambda s: s["key"]))
    )
    pieces = F.regexp_extract_all(F.col(column), F.lit(f"{text.WORD_CHAR}+|[^{text.WORD_CHAR[1:]}+"), F.lit(0))
    runs = F.transform("_pieces", lambda p, i: F.struct(_folded(p).alias("key"), i.alias("place"), F.lit(-1).alias("step")))
    marks = F.transform("_steps", lambda s: F.struct(s["key"].alias("key"), F.lit(-1).alias("place"), s["step"].alias("step")))
    met = F.col("_met")

    def first_place(entry: Column, i: Column) -> Column:
        after = F.get(met, i + 1)
        place = F.when((after["key"] == entry["key"]) & (after["place"] >= 0), after["place"])
        return F.struct(entry["step"].alias("step"), place.alias("place"))

    # In the order of steps, so that the entry of a step is found by its number.
    first = F.sort_array(F.filter(F.transform(met, first_place), lambda e: e["step"] >= 0))

    def taken(step: Column) -> Column:
        own = F.get(F.col("_first"), step["step"])["place"]
        earlier = F.filter("_steps", lambda s: (s["made"] == step["key"]) & (s["step"] < step["step"]))
        inserted = F.array_min(F.transform(earlier, lambda s: F.get(F.col("_first"), s["step"])["place"]))
        place = F.when(F.array_contains("_later", step["key"]), F.least(own, inserted)).otherwise(own)
        return F.struct(place.alias("place"), step["step"].alias("step"), step["target"].alias("text"))

    done = F.filter(F.transform("_steps", taken), lambda e: e["place"].isNotNull())
    given = F.transform("_pieces", lambda p, i: F.struct(i.alias("place"), F.lit(-1).alias("step"), p.alias("text")))
    placed = F.col("_placed_pieces")
    last = F.filter(placed, lambda e, i: ~F.coalesce(F.get(placed, i + 1)["place"] == e["place"], F.lit(False)))
    apart = F.col("_apart")
    return (
        df.withColumn("_steps", F.when(wanted, steps))
        .withColumn("_later", later)
        # A match that may take what another one inserted leaves it as it is.
        .withColumn("_apart", F.coalesce(simple & F.forall("_steps", lambda s: ~F.array_contains("_later", s["key"]) | (s["made"] == s["key"])), F.lit(False)))
        .withColumn("_pieces", F.when(apart, pieces))
        .withColumn("_met", F.when(apart, F.sort_array(F.concat(runs, marks))))
        .withColumn("_first", F.when(apart, first))
        .withColumn("_placed_pieces", F.when(apart, F.sort_array(F.concat(given, done))))
        .withColumn("_joined", F.when(apart, F.array_join(F.transform(last, lambda e: e["text"]), "")))
        .drop("_later", "_pieces", "_met", "_first", "_placed_pieces")
    )


def _matches(found: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Collect the matched tokens per key: longest token first, then first occurrence."""
    match = F.struct((-F.length("token")).alias("order"), "position", "token", "target", "source")
    listed = F.collect_list(F.when(F.col("target").isNotNull(), match))
    return found.groupBy(*keys).agg(F.array_sort(listed).alias("_matches"))


def _with_corrections(df: DataFrame, columns: Sequence[str], column: str, delimiter: str) -> DataFrame:
    """``columns`` and CORRECTION_COLUMNS, from the ``_matches`` of each row."""
    matches = F.col("_matches")

    def listed(field: str) -> Column:
        values = F.transform(matches, lambda m: m[field].cast("string"))
        return F.when(F.size(matches) > 0, F.concat_ws(delimiter, values))

    added = (listed("target"), listed("token"), listed("source"))
    return _rebuilt(df, column).select(
        *columns, "name_corrected", *(c.alias(n) for c, n in zip(added, CORRECTION_COLUMNS[1:], strict=True))
    )


def apply_dictionary(
    texts: DataFrame, column: str, dictionary: DataFrame, delimiter: str = ","
) -> DataFrame:
    """Correct a table of unique, short rows by a dictionary (token, target, source).

    Tokens are exploded, joined and grouped back by the table's own columns; a marker keeps
    rows without a match. No token begins with a blank as the marker does, and each row has a marker of its own, so markers spread
    where the dictionary is too large to broadcast. While it is small enough, an input partitioned
    by any of its columns is not shuffled.
    """
    keys = texts.columns
    words = F.coalesce(text.match_words(F.col(column)), text.word_list(()))
    marker = F.concat(F.lit(" "), F.xxhash64(*keys).cast("string"))
    marked = F.array_append(words, marker)
    tokens = texts.select(*keys, F.posexplode(marked).alias("position", "token"))
    found = tokens.join(dictionary.select("token", "target", "source"), "token", "left")
    kept = found.where(F.col("target").isNotNull() | F.col("token").startswith(" "))
    return _with_corrections(_matches(kept, keys), keys, column, delimiter)


def correct_words(
    df: DataFrame,
    column: str = "name",
    targets: DataFrame | Sequence[str] | None = None,
    stopwords: Sequence[str] | None = None,
    letters: text.Letters | None = None,
    threshold: float = 0.7,
    delimiter: str = ",",
    vectors: DataFrame | None = None,
    rows_per_split: int = ROWS_PER_SPLIT,
) -> DataFrame:
    """Correct every word of ``column`` that is close to a target.

    Adds ``name_corrected``, ``matched_words``, ``original_tokens_matched`` and ``model_sources``
    (1 = embedding, 3 = edit distance). A text without matches stays as it is with three nulls;
    a null text gives four nulls. Each distinct token is compared once.

    Texts stay where they are until the final join: only their tokens, the matched ones deduplicated per text, and
    their digests are shuffled, and no table with the texts is written. ``df`` is read three times, for its tokens, for the
    matches and for the result; stage it first if it is costly to compute.
    """
    if targets is None or stopwords is None or letters is None:
        raise ValueError("targets, stopwords and letters are required")
    ranked = as_targets(df.sparkSession, targets)
    tokens = text_tokens(df, column, stopwords, letters)
    dictionary = stage(correction_dictionary(tokens, ranked, threshold, vectors), "dictionary")
    keyed = df.withColumn("_key", text.digest(F.col(column)))
    words = text.match_words(F.col(column), stopwords, letters)
    # One pass gives the matched tokens of each text and, by a marker that no token equals, its number of rows.
    marked = keyed.where(F.col(column).isNotNull()).select(
        "_key", F.posexplode(F.array_append(F.coalesce(words, text.word_list(())), F.lit(" "))).alias("position", "token")
    )
    met = marked.join(dictionary.select("token", "target", "source"), "token", "left")
    met = met.where(F.col("target").isNotNull() | (F.col("token") == " "))
    found = met.groupBy("_key", "position", "token", "target", "source").agg(F.count("*").alias("n_rows"))
    found = stage(found, "matched-tokens")
    matches = _matches(found.where(F.col("target").isNotNull()), ["_key"])
    joined = attach(keyed, matches, found.where("target IS NULL").select("_key", "n_rows"), "_key", rows_per_split)
    return _with_corrections(joined, df.columns, column, delimiter)
