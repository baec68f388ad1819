"""Join of the occurrences of words with what a vocabulary says of them, evenly spread however frequent a word is."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from namewright.sources.staging import stage

#: A vocabulary up to this size is broadcast whole; so are, beyond it, the frequent words.
BROADCAST_BYTES = 64 << 20
#: Share of all occurrences from which on a word is frequent; there are at most 1 / share such words.
HOT_SHARE = 1 / 1000


def join_vectors(
    occurrences: DataFrame,
    vectors: DataFrame,
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_share: float = HOT_SHARE,
) -> DataFrame:
    """The rows of ``occurrences`` (``word`` and others) whose word has a row in ``vectors`` (``word``, ``vector``), with the vector.

    The vocabulary is measured. Up to ``broadcast_bytes`` it is broadcast. A larger one is split by the counts of the words, which combine before
    their shuffle: those with at least ``hot_share`` of all occurrences are broadcast and joined where the rows lie, the others are
    shuffled, and no word that is left can fill a partition. Vectors so wide that 1 / ``hot_share`` of them exceed ``broadcast_bytes``
    raise the share, so that what is broadcast stays within the bound.

    ``vectors`` has one row a word; with more each counts, and the bound holds for the words. Null words have no vector. The order of
    columns is that of ``occurrences``, then ``vector``.
    """
    known = vectors.select("word", "vector").where(F.col("word").isNotNull())
    row_bytes = F.octet_length("word") + 8 * F.greatest(F.size("vector"), F.lit(0)) + 32
    size = known.agg(F.coalesce(F.sum(row_bytes), F.lit(0)).alias("all"), F.coalesce(F.max(row_bytes), F.lit(0)).alias("widest")).first()
    names = [*occurrences.columns, "vector"]
    if size["all"] <= broadcast_bytes:
        return occurrences.join(F.broadcast(known), "word").select(*names)
    counts = stage(occurrences.groupBy("word").agg(F.count("*").alias("_n")), "word-counts")
    share = max(hot_share, size["widest"] / broadcast_bytes) if broadcast_bytes else 1.0
    total = counts.agg(F.sum("_n")).scalar()
    frequent = counts.where(F.col("_n") >= share * total).select("word")
    hot = stage(known.join(F.broadcast(frequent), "word", "left_semi"), "frequent-words")
    words = F.broadcast(hot.select("word").distinct())
    near = occurrences.join(F.broadcast(hot), "word").select(*names)
    # A hint for the plain join: a vocabulary beyond the bound is never broadcast.
    rest = occurrences.join(words, "word", "left_anti").join(known.hint("shuffle_merge"), "word").select(*names)
    return near.unionAll(rest)
