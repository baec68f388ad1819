"""Best taxonomy entry by number of shared words, through an inverted index."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from namewright.functions import text
from namewright.functions.similarity import at_least
from namewright.operators.attach import ROWS_PER_SPLIT, attach
from namewright.sources.staging import stage

MAX_POSTINGS = 1_000
#: Frequent words of a text or an entry up to which all their sets are looked up.
MAX_SUBSET = 8
#: Pairs of a text and an entry that one task counts shared words of, about.
PAIRS_PER_TASK = 1_000_000


def taxonomy_entries(taxonomy: DataFrame) -> DataFrame:
    """One entry per distinct word set, that of the lowest (id, degree_name).

    Columns: words, the struct ``entry`` of master_degree_id, degree_name, master_tokens and the
    taxonomy's other columns, and ``number``, which grows with (id, degree_name).
    """
    named = taxonomy.where(F.col("degree_name").isNotNull()).withColumn(
        "master_tokens", F.split(F.lower("degree_name"), " ")
    )
    others = [c for c in taxonomy.columns if c not in ("id", "degree_name")]
    entry = F.struct(
        F.col("id").alias("master_degree_id"), "degree_name", "master_tokens", *others
    )
    words = F.array_sort(F.array_distinct("master_tokens"))
    entries = named.groupBy(words.alias("words")).agg(
        F.min_by(entry, F.struct("id", "degree_name")).alias("entry")
    )
    ordered = entries.orderBy("entry.master_degree_id", "entry.degree_name")
    return ordered.withColumn("number", F.monotonically_increasing_id())


def word_kinds(entries: DataFrame, max_postings: int = MAX_POSTINGS) -> DataFrame:
    """(token, frequent) of the taxonomy's words; frequent ones are in more than ``max_postings`` entries."""
    counted = entries.select(F.explode("words").alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    return counted.select("token", (F.col("n") > max_postings).alias("frequent"))


def signed_entries(entries: DataFrame, kinds: DataFrame) -> DataFrame:
    """(number, signature, others): the frequent words of each entry, sorted, and its other words."""
    exploded = entries.select("number", F.explode("words").alias("token")).join(kinds, "token")
    return exploded.groupBy("number").agg(
        F.array_sort(F.collect_list(F.when(F.col("frequent"), F.col("token")))).alias("signature"),
        F.collect_list(F.when(~F.col("frequent"), F.col("token"))).alias("others"),
    )


def _subsets(words: Column) -> Column:
    """All sets of one or more of the sorted words, each joined by blanks."""
    masks = F.sequence(F.lit(1), F.pow(F.lit(2), F.size(words)).cast("int") - 1)

    def chosen(mask: Column) -> Column:
        picked = F.filter(words, lambda _, i: (F.floor(mask / F.pow(F.lit(2), i)).cast("int") % 2) == 1)
        return F.concat_ws(" ", picked)

    return F.transform(masks, chosen)


class OverlapIndex:
    """The staged tables that lead from the words of a text to its best entry.

    A rare word, in at most ``max_postings`` entries, lists them all. Frequent words would list a large part of the taxonomy;
    among entries that share no rare word with a text only the frequent ones count. Up to ``max_subset`` of them are looked up as sets:
    each set of an entry's frequent words lists the lowest entry that has it, so a text's largest set that is
    listed is its best overlap, found in at most ``2 ** max_subset`` look-ups however large the taxonomy is. Entries with more frequent words
    than that are listed per word, once for each combination of frequent words; they, and for texts with more frequent words
    all combinations, are compared one by one. The result is exact in every case.
    """

    def __init__(self, taxonomy: DataFrame, max_postings: int = MAX_POSTINGS, max_subset: int = MAX_SUBSET) -> None:
        self.max_subset = max_subset
        self.entries = stage(taxonomy_entries(taxonomy), "entries")
        self.kinds = stage(word_kinds(self.entries, max_postings), "word-kinds")
        #: Without frequent words, as in every small taxonomy, words alone are looked up and counted.
        self.has_frequent = not self.kinds.where("frequent").isEmpty()
        if not self.has_frequent:
            self.index = self.entries.select(F.explode("words").alias("value"), "number")
            return
        signed = stage(signed_entries(self.entries, self.kinds), "signed-entries")
        rare = signed.select(F.lit("rare").alias("kind"), F.explode("others").alias("value"), "signature", "number")
        lowest = signed.where(F.size("signature") > 0).groupBy("signature").agg(F.min("number").alias("number"))
        lowest = stage(lowest, "signatures")
        narrow = lowest.where(F.size("signature") <= max_subset)
        sets = narrow.select(F.explode(_subsets(F.col("signature"))).alias("value"), "number")
        sets = sets.groupBy("value").agg(F.min("number").alias("number"))
        sets = sets.select(F.lit("set").alias("kind"), "value", F.split("value", " ").alias("signature"), "number")
        kind = F.when(F.size("signature") > max_subset, "wide").otherwise("word").alias("kind")
        combinations = lowest.select(kind, F.explode("signature").alias("value"), "signature", "number")
        self.index = stage(rare.unionByName(sets).unionByName(combinations), "overlap-index")

    def candidates(self, keyed: DataFrame, keys: Sequence[str], tokens: Column, keep_all: bool = False) -> DataFrame:
        """(keys, number, score) of the entries that may be best; with ``keep_all`` a null row for every key."""
        words = F.array_distinct(tokens)
        if keep_all:
            # A marker of its own keeps each row; it begins with a blank, as no word does, and is no word of an entry.
            marker = F.concat(F.lit(" "), F.xxhash64(*keys).cast("string"))
            words = F.array_append(F.coalesce(words, text.word_list(())), marker)
        exploded = keyed.select(*keys, F.explode(words).alias("token"))
        met = exploded.join(self.kinds, "token", "left" if keep_all else "inner")
        if keep_all:
            met = met.where(F.col("frequent").isNotNull() | F.col("token").startswith(" "))
        listed = met.groupBy(*keys).agg(
            F.array_sort(F.collect_set(F.when(F.col("frequent"), F.col("token")))).alias("_common"),
            F.collect_set(F.when(~F.col("frequent"), F.col("token"))).alias("_rare"),
        )
        if not keep_all:
            # Written, to know how many entries it meets before they are counted; with all rows kept, keys stay partitioned as they are.
            listed = stage(listed, "listed-words")
        if not self.has_frequent:
            if not keep_all:
                listed = self._spread(listed, keys, listed.select(F.explode("_rare").alias("value")), ["value"])
            rare = listed.select(*keys, (F.explode_outer if keep_all else F.explode)("_rare").alias("value"))
            hits = rare.join(self.index.select("value", "number"), "value", "left" if keep_all else "inner")
            return hits.groupBy(*keys, "number").agg(F.count("number").cast("int").alias("score"))
        few = F.size("_common") <= self.max_subset
        # One row per look-up: a rare word, a set of frequent words, or a frequent word.
        none = F.array().cast("array<string>")

        def look_ups(kind: str, values: Column) -> Column:
            return F.transform(values, lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("value")))

        wanted = F.concat(
            look_ups("rare", F.col("_rare")), look_ups("set", F.when(few, _subsets(F.col("_common"))).otherwise(none)),
            look_ups("wide", F.col("_common")), look_ups("word", F.when(few, none).otherwise(F.col("_common"))),
        )
        if keep_all:
            wanted = F.concat(wanted, F.array(F.struct(F.lit("row").alias("kind"), F.lit(None).cast("string").alias("value"))))
        if not keep_all:
            listed = self._spread(listed, keys, listed.select(F.inline(wanted)), ["kind", "value"])
        probes = listed.select(*keys, "_common", F.explode(wanted).alias("_probe")).select(*keys, "_common", "_probe.kind", "_probe.value")
        hits = probes.join(self.index, ["kind", "value"], "left" if keep_all else "inner")
        pairs = hits.groupBy(*keys, "_common", "number", "signature").agg(F.count_if(F.col("kind") == "rare").cast("int").alias("_rare"))
        score = F.col("_rare") + F.size(F.array_intersect("_common", "signature"))
        return pairs.select(*keys, "number", score.alias("score"))

    def _spread(self, listed: DataFrame, keys: Sequence[str], probes: DataFrame, on: list[str]) -> DataFrame:
        """``listed`` in as many partitions as its look-ups need: few bytes of words meet many entries, which Spark can't foresee."""
        postings = self.index.groupBy(*on).agg(F.count("*").alias("_n"))
        pairs = probes.join(postings, on).agg(F.sum("_n").alias("n")).first()["n"] or 0
        return listed.repartition(math.ceil(pairs / PAIRS_PER_TASK), *keys) if pairs > PAIRS_PER_TASK else listed

    def best(
        self, keyed: DataFrame, keys: Sequence[str], tokens: Column, keep_all: bool = False
    ) -> DataFrame:
        """The ``keys`` with ``entry`` and ``match_score`` of the best entry; rows of equal keys count once.

        The most shared words win, then the lowest (id, degree_name). Rows that share no word with
        any entry are left out, or kept with nulls.
        """
        scored = self.candidates(keyed, keys, tokens, keep_all)
        order = F.when(F.col("number").isNotNull(), F.struct(-F.col("score"), "number"))
        best = scored.groupBy(*keys).agg(
            F.min_by(F.struct("number", F.col("score").alias("match_score")), order).alias("_best")
        )
        payload = self.entries.select("number", "entry")
        found = best.select(*keys, "_best.*").join(payload, "number", "left")
        return found.select(*keys, "entry", "match_score")

    def complete(self, df: DataFrame, tokens: Column) -> DataFrame:
        """Score 0 and the lowest entry for rows that have tokens and no best entry."""
        lowest = self.entries.agg(F.min_by("entry", "number").alias("entry")).scalar()
        entry = F.coalesce("entry", F.when(tokens.isNotNull(), lowest))
        return df.withColumn("entry", entry).withColumn(
            "match_score", F.when(F.col("entry").isNotNull(), F.coalesce("match_score", F.lit(0)))
        )


def best_per_id(df: DataFrame, order: list[Column]) -> DataFrame:
    """The first row per ``id`` in ``order``, then by its other columns; adds ``rank``.

    Null ids form one group. The rank filter prunes before the shuffle.
    """
    orderable = [f.name for f in df.schema.fields if "map" not in f.dataType.simpleString()]
    window = Window.partitionBy("id").orderBy(*order, *orderable)
    return df.withColumn("rank", F.row_number().over(window)).where(F.col("rank") == 1)


def classify_by_overlap(
    df: DataFrame,
    taxonomy: DataFrame,
    min_score: float,
    rows_per_split: int = ROWS_PER_SPLIT,
    max_postings: int = MAX_POSTINGS,
) -> DataFrame:
    """Best taxonomy entry per ``id`` by words shared with the pipe-separated ``matched_speciality``.

    Adds ``matched_speciality_cleaned``, ``education_tokens``, ``master_degree_id``,
    ``degree_name``, ``master_tokens``, ``match_score`` and ``rank``; ``degree_name`` is null
    below ``min_score``. One row per id remains.
    """
    speciality = F.col("matched_speciality")
    tokens = text.overlap_words(speciality)
    keyed = df.withColumn("_key", text.digest(speciality))
    counts = keyed.where(speciality.isNotNull()).groupBy("_key").agg(F.count("*").alias("n_rows"))
    # Words travel, not texts: those of the taxonomy, as sets that combine before the shuffle.
    index = OverlapIndex(taxonomy, max_postings)
    best = index.best(keyed, ["_key"], tokens)
    matched = attach(keyed, best, counts, "_key", rows_per_split)
    matched = index.complete(matched, tokens).select(
        *df.columns,
        F.lower(F.regexp_replace(speciality, r"\|", " ")).alias("matched_speciality_cleaned"),
        tokens.alias("education_tokens"),
        "entry.*",
        "match_score",
    )
    ranked = best_per_id(matched, [F.desc_nulls_last("match_score"), F.asc("master_degree_id")])
    return gate(ranked, min_score)


def gate(df: DataFrame, min_score: float) -> DataFrame:
    """Null ``degree_name`` where ``match_score`` is below ``min_score`` or null."""
    return df.withColumn("degree_name", at_least(F.col("match_score"), min_score, F.col("degree_name")))
