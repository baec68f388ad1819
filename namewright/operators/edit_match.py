"""Edit-similarity join of tokens and targets, by shared segments instead of all pairs.

If two words differ by at most k edits and one is cut into k + 1 segments, at least one segment
occurs unchanged in the other, near its own place (Li, Deng, Wang, Feng: Pass-Join, PVLDB 5(3),
2011). Segments turn the similarity join into an equi-join. A word of k letters or fewer has no k + 1 segments; but
words that differ by at most k edits share as many letters as the longer one has more than k, so at least one of the first letters of
both, the rarest first, is the same. A pair that shares several segments or letters is kept at the first of them only; the exact test follows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from namewright.config import TOKEN_LENGTHS

EPSILON = 1e-9


def _max_edits(threshold: float) -> Column:
    longer = F.greatest("target_length", "token_length")
    return F.floor(longer * (1 - threshold) + EPSILON).cast("int")


def _cut(segment: Column, length: Column, edits: Column) -> tuple[Column, Column]:
    """Start and size of a segment of the target."""
    before = F.floor((segment - 1) * length / (edits + 1)).cast("int")
    return before + 1, F.floor(segment * length / (edits + 1)).cast("int") - before


def _places(segment: Column, start: Column, size: Column, edits: Column, lengths: tuple[Column, Column]) -> tuple[Column, Column]:
    """First and last place in the token where a segment may be: it can only have moved by the edits left of it, and by those right of it."""
    token_length, target_length = lengths
    left, right, shift = segment - 1, edits + 1 - segment, token_length - target_length
    return F.greatest(start - left, start + shift - right, F.lit(1)), F.least(start + left, start + shift + right, token_length - size + 1)


def _banded_targets(targets: DataFrame, threshold: float, lengths: tuple[int, int]) -> DataFrame:
    """Targets with every length that a token may have."""
    length = F.col("target_length")
    shortest = F.greatest(F.ceil(length * threshold - EPSILON), F.lit(lengths[0])).cast("int")
    longest = F.least(F.floor(length / threshold + EPSILON), F.lit(lengths[1])).cast("int")
    banded = targets.select("target", "rank").withColumn("target_length", F.length("target")).where(shortest <= longest)
    return banded.withColumn("token_length", F.explode(F.sequence(shortest, longest))).withColumn("edits", _max_edits(threshold))


def _banded_tokens(tokens: DataFrame, threshold: float) -> DataFrame:
    """Tokens with every length that a target may have."""
    length = F.col("token_length")
    shortest = F.greatest(F.ceil(length * threshold - EPSILON), F.lit(1)).cast("int")
    longest = F.floor(length / threshold + EPSILON).cast("int")
    banded = tokens.select("token").withColumn("token_length", F.length("token"))
    return banded.withColumn("target_length", F.explode(F.sequence(shortest, longest))).withColumn("edits", _max_edits(threshold))


_CLASS = ("token_length", "target_length")


def _pairs_by_segment(tokens: DataFrame, targets: DataFrame) -> DataFrame:
    """(token, target, rank and lengths) of pairs that share a segment, once each."""
    length, edits, segment = F.col("target_length"), F.col("edits"), F.col("segment")
    lengths = (F.col("token_length"), length)
    cut = edits + 1 <= length
    numbered = F.explode(F.sequence(F.lit(1), edits + 1))
    start, size = _cut(segment, length, edits)
    pieces = targets.where(cut).withColumn("segment", numbered).withColumn("piece", F.substring("target", start, size))
    first, last = _places(segment, start, size, edits, lengths)
    found = F.transform(F.sequence(first, last), lambda place: F.substring(F.col("token"), place, size))
    placed = tokens.where(cut).withColumn("segment", numbered).where(first <= last)
    placed = placed.withColumn("piece", F.explode(F.array_distinct(found))).drop("edits")
    met = placed.join(pieces, [*_CLASS, "segment", "piece"])

    def shared(earlier: Column) -> Column:
        start, size = _cut(earlier, length, edits)
        first, last = _places(earlier, start, size, edits, lengths)
        piece = F.substring("target", start, size)
        near = F.substring("token", first, last - first + size)
        return (first <= last) & (F.call_function("instr", near, piece) > 0)

    before = F.when(segment > 1, F.exists(F.sequence(F.lit(1), segment - 1), shared)).otherwise(F.lit(False))
    return met.where(~before).select("token", "target", "rank", *_CLASS)


#: Latin letters from the rarest to the most frequent, about; any order gives the same pairs.
RAREST_FIRST = "qxzjkwvfybhgpmudclotnrsiae"


def _letters(word: Column) -> Column:
    """The letters of a word, each with the number of its kind so far, the rarest first."""
    letters = F.split(F.translate(word, RAREST_FIRST, "".join(sorted(RAREST_FIRST))), "")
    numbered = F.transform(letters, lambda x, i: F.concat(x, F.size(F.filter(F.slice(letters, 1, i + 1), lambda y: y == x)).cast("string")))
    return F.array_sort(numbered)


def _pairs_by_letter(tokens: DataFrame, targets: DataFrame) -> DataFrame:
    """(token, target, rank and lengths) of pairs that share enough letters, where the target has too few for segments, once each."""
    edits, short = F.col("edits"), F.col("edits") + 1 > F.col("target_length")
    common = F.greatest(F.greatest("target_length", "token_length") - edits, F.lit(1))

    def firsts(rows: DataFrame, word: str, length: str) -> DataFrame:
        rows = rows.where(short & (F.col(length) >= common))
        head = F.slice(_letters(F.col(word)), F.lit(1), F.col(length) - common + 1)
        return rows.withColumn(f"_{word}_letters", head).withColumn("letter", F.explode(f"_{word}_letters")).drop("edits")

    met = firsts(tokens, "token", "token_length").join(firsts(targets, "target", "target_length"), [*_CLASS, "letter"])
    first = F.array_min(F.array_intersect("_token_letters", "_target_letters"))
    return met.where(F.col("letter") == first).select("token", "target", "rank", *_CLASS)


def candidate_pairs(tokens: DataFrame, targets: DataFrame, threshold: float, lengths: tuple[int, int] = TOKEN_LENGTHS) -> DataFrame:
    """The pairs whose distance is computed, each once: (token, target, rank, token_length, target_length)."""
    banded_tokens, banded_targets = _banded_tokens(tokens, threshold), _banded_targets(targets, threshold, lengths)
    pairs = _pairs_by_segment(banded_tokens, banded_targets)
    # Above a half, fewer letters of the longer word may be edited than the shorter one has.
    if threshold > 0.5 + 1e-6:
        return pairs
    return pairs.union(_pairs_by_letter(banded_tokens, banded_targets))


def edit_matches(
    tokens: DataFrame,
    targets: DataFrame,
    threshold: float,
    lengths: tuple[int, int] = TOKEN_LENGTHS,
) -> DataFrame:
    """All (token, target, rank, similarity) with edit similarity of at least ``threshold``.

    ``tokens`` has distinct ``token``s whose length lies within ``lengths``; ``targets`` has distinct
    (target, rank). A pair comes once. The distance is computed no further than the edits that the threshold allows.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold must be above 0 and at most 1")
    pairs = candidate_pairs(tokens, targets, threshold, lengths)
    distance = F.call_function("levenshtein", F.col("token"), F.col("target"), _max_edits(threshold))
    longer = F.greatest("token_length", "target_length")
    near = pairs.withColumn("_distance", distance).where(F.col("_distance") >= 0)
    scored = near.select("token", "target", "rank", (1 - F.col("_distance") / longer).alias("similarity"))
    return scored.where(F.col("similarity") >= threshold)
