"""Fixed values and default settings."""

from __future__ import annotations

from dataclasses import dataclass

# Results depend on these word lists, letters, patterns and thresholds.
STOPWORDS = (
    "de", "la", "el", "y", "en", "con", "del", "los", "las", "para", "por", "a",
    "un", "una", "al", "o", "u", "e", "se", "su", "que", "como",
    "the", "of", "on", "in", "by", "with", "that", "and", "for",
)
LETTERS = (("á", "a"), ("é", "e"), ("í", "i"), ("ó", "o"), ("ú", "u"), ("ñ", "n"))
# All but a-z and white space, and all but digits too. Java matches a class of ranges some ten times as fast as the negated one.
LETTERS_ONLY = r"[\x00-\x08\x0e-\x1f!-`{-\x{10ffff}]"
LETTERS_AND_DIGITS = r"[\x00-\x08\x0e-\x1f!-/:-`{-\x{10ffff}]"
SPACED_PUNCTUATION = r"""[.,?!@#$%^&*()\-+={}\[\]:;'"]"""
TOKEN_LENGTHS = (2, 15)
SOURCE_EMBEDDING = 1
SOURCE_EDIT = 3
CSV_DELIMITERS = (",", ";", "\t", "|")


@dataclass(frozen=True)
class Thresholds:
    """Cut-offs of the end-to-end classification."""

    category: float = 0.75
    speciality: float = 0.8
    min_overlap: int = 2
