"""Quality rules by the divergence of histograms from language references, in DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from namewright.sources.staging import stage

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]+"
#: ASCII characters that are no letter, digit or space.
MARKS = r"[\x00-\x08\x0E-\x1F!-/:-@\[-`{-\x7F]+"

#: Common words of each language; fixed values.
COMMON_WORDS = {
    "en": ("the", "of", "and", "to", "in", "is", "that", "for", "it", "with", "was", "on", "be", "at", "by", "from"),
    "fr": ("de", "la", "le", "et", "les", "des", "en", "un", "une", "que", "dans", "pour", "est", "qui", "au", "sur"),
    "de": ("der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "für", "ist", "im", "dem"),
    "es": ("de", "la", "que", "el", "en", "y", "a", "los", "se", "del", "las", "un", "por", "con", "no", "una"),
}
N_COMMON = 16
CLASSES = ("lower", "upper", "digit", "space", "wide", "mark")


@dataclass(frozen=True)
class Rules:
    min_words: int = 50
    #: Base rule: at most this share, in percent, of the words lies in repeated windows.
    max_repeated: int = 50
    #: Histograms of fewer characters or words are not judged, nor do they count in a reference.
    guard_chars: int = 200
    guard_words: int = 150
    max_chars_distance: float = 0.28
    max_words_distance: float = 0.25
    #: Languages of fewer judged documents have no reference.
    guard_documents: int = 20


def quality_rules(
    documents: DataFrame,
    rules: Rules = Rules(),
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
) -> DataFrame:
    """Judges each text by simple counts and by its distance from its language; one row per input row.

    Columns: id, lang, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, chars_distance, words_distance, kept.
    Two histograms are made of a text: of character classes (CLASSES), and of the common words of its language, with all other words as one bin. The
    reference of a language is the mean of these histograms over all its documents long enough to be judged. The
    distance is Jensen-Shannon's, the root of the divergence in bits, from 0 to 1. A document is kept if it passes the base rules and no
    judged distance is above its limit; short texts, and languages of few documents, are not judged (null distance).

    Everything is computed within the row but the references, a mean per language that combines before the shuffle; texts are never
    shuffled. Repeated windows are found by sorting the text's window hashes, so long texts cost n log n.

    Null text is empty and null language a language of its own; languages without a list have no common words. Repeated rows are judged alike.
    """
    measured = stage(_measure(documents, id_column, text_column, lang_column), "text-measures")
    chars, common = F.col("_chars"), F.col("_common")
    enough_chars = F.col("_length") >= rules.guard_chars
    enough_words = (F.col("n_words") >= rules.guard_words) & F.col("_listed")

    def mean(bins: Column, n: int, enough: Column, name: str) -> Column:
        shares = [F.avg(F.when(enough, bins[i] / F.aggregate(bins, F.lit(0).cast("long"), lambda a, x: a + x))) for i in range(n)]
        return F.array(*shares).alias(name)

    references = stage(
        measured.groupBy("lang").agg(
            mean(chars, len(CLASSES), enough_chars, "_chars_reference"),
            mean(common, N_COMMON + 1, enough_words, "_words_reference"),
            F.count(F.when(enough_chars, 1)).alias("_n_chars"), F.count(F.when(enough_words, 1)).alias("_n_words"),
        ).withColumnRenamed("lang", "_lang"),
        "language-references",
    )
    few = rules.guard_documents
    judged = measured.join(references, F.col("lang").eqNullSafe(F.col("_lang")), "left").withColumns({
        "chars_distance": F.when(enough_chars & (F.col("_n_chars") >= few), jensen_shannon(chars, F.col("_chars_reference"))),
        "words_distance": F.when(enough_words & (F.col("_n_words") >= few), jensen_shannon(common, F.col("_words_reference"))),
    })
    base_failed = (F.col("n_words") < rules.min_words) | (100 * F.col("n_repeat_words") > rules.max_repeated * F.col("n_words"))
    kept = (
        ~F.col("base_failed") & (F.coalesce("chars_distance", F.lit(0.0)) <= rules.max_chars_distance)
        & (F.coalesce("words_distance", F.lit(0.0)) <= rules.max_words_distance)
    )
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.withColumn("base_failed", base_failed).select(
        F.col("_id").alias(id_column), "lang", *(F.col(c).cast("long").alias(c) for c in counts), "base_failed",
        "chars_distance", "words_distance", kept.alias("kept"),
    )


def _measure(documents: DataFrame, id_column: str, text_column: str, lang_column: str) -> DataFrame:
    text, words = F.col("_text"), F.col("_words")
    rows = documents.select(
        F.col(id_column).alias("_id"), F.col(lang_column).alias("lang"),
        F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("_text"),
    )
    rows = rows.withColumn("_words", F.array_remove(F.split(text, SPACE), ""))
    # The few words that are common in any language are counted one by one; all words are looked at once.
    known = F.filter("_words", lambda word: word.isin(*sorted({w for listed in COMMON_WORDS.values() for w in listed})))
    rows = rows.withColumns({"n_words": F.size("_words"), "_known": known})
    windows = F.when(F.col("n_words") >= 3, F.transform(
        F.sequence(F.lit(0), F.col("n_words") - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))
    ))
    rows = rows.withColumn("_windows", windows)
    # Texts without a repeated window, most of them, need no sort.
    again = F.size(F.array_distinct("_windows")) < F.size("_windows")
    placed = F.when(again, F.sort_array(F.transform("_windows", lambda w, i: F.struct(w.alias("window"), i.alias("place")))))
    rows = rows.withColumn("_placed", placed)
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.withColumn("_lines", lines).withColumn("_repeated", _repeated_places(F.col("_placed")))
    length = F.length("_text")

    def removed(pattern: str) -> Column:
        return length - F.length(F.regexp_replace("_text", pattern, ""))

    classes = {
        "_length": length, "_mark": removed(MARKS), "_upper": removed("[A-Z]+"), "_digit": removed("[0-9]+"),
        "_wide": removed(r"[^\x00-\x7F]+"), "word_chars": F.length(F.array_join("_words", "")),
        "n_symbols": removed(SYMBOLS), "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_repeat_words": _covered(F.col("_repeated")), "_common": _common_words(F.col("_known"), F.col("n_words")),
    }
    rows = rows.withColumns(classes)
    space = F.col("_length") - F.col("word_chars")
    lower = F.col("word_chars") - F.col("_mark") - F.col("_upper") - F.col("_digit") - F.col("_wide")
    bins = F.array(*(c.cast("long") for c in (lower, F.col("_upper"), F.col("_digit"), space, F.col("_wide"), F.col("_mark"))))
    return rows.select(
        "_id", "lang", "_length", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", bins.alias("_chars"), "_common",
        F.coalesce(F.col("lang").isin(*COMMON_WORDS), F.lit(False)).alias("_listed"),
    )


def _repeated_places(windows: Column) -> Column:
    """Sorted places of the windows that occur again; in the sorted list those equal a neighbour."""
    def place(window: Column, i: Column) -> Column:
        before = F.when(i > 0, F.get(windows, i - 1)["window"])
        after = F.get(windows, i + 1)["window"]
        again = F.coalesce(window["window"] == before, F.lit(False)) | F.coalesce(window["window"] == after, F.lit(False))
        return F.when(again, window["place"])

    return F.sort_array(F.array_compact(F.transform(windows, place)))


def _covered(places: Column) -> Column:
    """Number of words in windows of three that begin at these sorted places."""
    steps = F.transform(places, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(places, i + 1) - p, F.lit(3))))
    return F.coalesce(F.aggregate(steps, F.lit(0), lambda a, x: a + x), F.lit(0))


def _common_words(known: Column, n_words: Column) -> Column:
    """Counts of the language's common words, then of all other words."""
    def counts(lang: str) -> Column:
        return F.array(*(F.size(known) - F.size(F.array_remove(known, word)) for word in COMMON_WORDS[lang]))

    chosen = F.array(*[F.lit(0)] * N_COMMON)
    for lang in COMMON_WORDS:
        chosen = F.when(F.col("lang") == lang, counts(lang)).otherwise(chosen)
    rest = n_words - F.aggregate(chosen, F.lit(0), lambda a, x: a + x)
    return F.concat(chosen, F.array(rest)).cast("array<bigint>")


def jensen_shannon(counts: Column, reference: Column) -> Column:
    """Distance of a histogram of counts from one of shares; rounded to 6 decimals."""
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x)

    def part(p: Column, q: Column) -> Column:
        middle = (p + q) / 2
        return F.when(p > 0, p * F.log2(p / middle)).otherwise(0.0) + F.when(q > 0, q * F.log2(q / middle)).otherwise(0.0)

    parts = F.zip_with(counts, reference, lambda n, q: part(n / total, q))
    divergence = F.aggregate(parts, F.lit(0.0), lambda a, x: a + x) / 2
    return F.round(F.sqrt(F.greatest(divergence, F.lit(0.0))), 6)
