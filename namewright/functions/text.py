"""Text expressions: cleaning, tokenising, rendering. All are built-in column expressions."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from namewright.config import (
    LETTERS,
    LETTERS_AND_DIGITS,
    LETTERS_ONLY,
    SPACED_PUNCTUATION,
    STOPWORDS,
    TOKEN_LENGTHS,
)

Letters = Sequence[tuple[str, str]]

# Letters, digits and underscore in any script; spelled out because \w and \b are
# ASCII-only in some regex dialects.
WORD_CHAR = r"[\p{L}\p{N}_]"
TOKEN_RUN = r"[\p{L}\p{Nl}\p{No}_]+"
WHITESPACE_RUN = r"[\t-\r\x1c-\x20\x{85}\p{Z}]+"
# Whitespace runs other than a single blank, which would be replaced by itself.
SQUEEZED = r"\s{2,}|[\t-\r]"


def word_list(words: Sequence[str]) -> Column:
    """A constant ``array<string>``, typed also when empty."""
    return F.array(*map(F.lit, words)).cast("array<string>")


def fold_letters(col: Column, letters: Letters = LETTERS) -> Column:
    """Replace each special letter by its plain form, pair after pair."""
    sources = {old for old, _ in letters}
    single = all(len(old) == len(new) == 1 and new not in sources for old, new in letters)
    if single and len(sources) == len(letters):
        return F.translate(col, "".join(o for o, _ in letters), "".join(n for _, n in letters))
    for old, new in letters:
        col = F.replace(col, F.lit(old), F.lit(new))
    return col


def drop_stopwords(words: Column, stopwords: Sequence[str] = STOPWORDS) -> Column:
    """Words not in ``stopwords``; repeats go too, first occurrences keep their order."""
    return F.array_except(words, word_list(stopwords))


def clean_strip_first(
    col: Column,
    stopwords: Sequence[str] = STOPWORDS,
    letters: Letters = LETTERS,
    punctuation: str = LETTERS_ONLY,
) -> Column:
    """Lower, delete ``punctuation``, fold letters, squeeze spaces, drop stopwords and repeats.

    Deleting comes before folding, so a pattern of plain letters deletes accented ones.
    A null text gives an empty string.
    """
    kept = fold_letters(F.regexp_replace(F.lower(col), punctuation, ""), letters)
    words = F.split(F.trim(F.regexp_replace(kept, SQUEEZED, " ")), " ")
    return F.concat_ws(" ", drop_stopwords(words, stopwords))


def clean_fold_first(
    col: Column,
    stopwords: Sequence[str] = STOPWORDS,
    letters: Letters = LETTERS,
) -> Column:
    """Lower, fold letters, delete whole-word stopwords, squeeze spaces, punctuation to space."""
    text = fold_letters(F.lower(col), letters)
    if stopwords:
        longest_first = sorted(stopwords, key=len, reverse=True)
        words = "|".join(re.escape(word) for word in longest_first)
        text = F.regexp_replace(text, f"(?<!{WORD_CHAR})(?:{words})(?!{WORD_CHAR})", "")
    text = F.trim(F.regexp_replace(text, WHITESPACE_RUN, " "))
    return F.trim(F.regexp_replace(text, SPACED_PUNCTUATION, " "))


def match_tokens(col: Column, letters: Letters = LETTERS) -> Column:
    """Lower-cased, folded runs of letters, 2 to 15 long, not starting with an underscore."""
    shortest, longest = TOKEN_LENGTHS
    runs = F.regexp_extract_all(fold_letters(F.lower(col), letters), F.lit(TOKEN_RUN), F.lit(0))
    return F.filter(
        runs, lambda t: F.length(t).between(shortest, longest) & ~F.startswith(t, F.lit("_"))
    )


def match_words(
    col: Column, stopwords: Sequence[str] = STOPWORDS, letters: Letters = LETTERS
) -> Column:
    """Distinct match tokens without stopwords, in order of first occurrence."""
    return drop_stopwords(match_tokens(col, letters), stopwords)


def vector_words(
    words: Column, stopwords: Sequence[str] = STOPWORDS, letters: Letters = LETTERS
) -> Column:
    """Words reduced to plain letters and digits, without empties and stopwords; repeats stay."""
    plain = F.transform(
        words, lambda w: F.regexp_replace(fold_letters(F.lower(w), letters), "[^a-z0-9]", "")
    )
    return F.filter(plain, lambda w: (w != "") & ~F.array_contains(word_list(stopwords), w))


def digest(col: Column) -> Column:
    """A short key that tells texts apart: the text itself, or its SHA-256 where that is shorter."""
    return F.when(F.octet_length(col) > 64, F.concat(F.lit("#"), F.sha2(col, 256))).otherwise(col)


def pipe_words(col: Column) -> Column:
    """Split at literal pipes."""
    return F.split(col, r"\|")


def first_pipe_word(col: Column) -> Column:
    """The part before the first literal pipe."""
    return F.split_part(col, F.lit("|"), F.lit(1))


def overlap_words(col: Column) -> Column:
    """Lower-cased words of a text whose separators are pipes and single spaces."""
    return F.split(F.lower(F.regexp_replace(col, r"\|", " ")), " ")


def render_list(words: Column) -> Column:
    """``['a','b']``; a null array renders as ``['']``."""
    return F.concat(F.lit("['"), F.concat_ws("','", words), F.lit("']"))


__all__ = [
    "LETTERS_AND_DIGITS",
    "LETTERS_ONLY",
    "clean_fold_first",
    "clean_strip_first",
    "digest",
    "drop_stopwords",
    "first_pipe_word",
    "fold_letters",
    "match_tokens",
    "match_words",
    "overlap_words",
    "pipe_words",
    "render_list",
    "vector_words",
    "word_list",
]
