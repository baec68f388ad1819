"""Preference pairs: the common turns of two conversations once as prompt, the rest as masked completions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A rendered turn is its role between these, its text, and the end mark.
OPEN, CLOSE, END = "<|", "|>\n", "<|end|>\n"
TRAINED_ROLE = "assistant"

TURNS = "array<struct<turn: bigint, role: string, text: string>>"


def preference_format(
    chosen: DataFrame, rejected: DataFrame, pair_column: str = "pair_id", trained_role: str = TRAINED_ROLE
) -> DataFrame:
    """One row per pair from the turns of its chosen and its rejected conversation.

    Both inputs have (pair, turn, role, text). Columns: pair, n_common, prompt, chosen, rejected, chosen_mask, rejected_mask, usable. The
    longest prefix of turns that both sides share, equal in role and text, is rendered once as ``prompt``; what
    follows on each side is its completion. A mask is an array of (begin, end), the characters (code points) of the completion that are trained on: the
    texts and end marks of the turns of ``trained_role``. A pair is usable if both completions have something to train on.

    Both sides are shuffled once, by pair, and compared within the row. A pair's turns are one training example and so one row; no other
    group is formed. Should one pair hold a third of all turns, that is one very long example.

    Turns are ordered by turn, then role, then text, so repeated turn numbers have a fixed order; null turns come first. Null role and
    text are empty, and very long texts are rendered whole. Turns of a null pair belong to no pair and are left out. A pair with one side
    only has an empty prompt and is not usable. Equal sides leave two empty completions. Other columns are ignored.
    """
    sides = [_clean(side, pair_column).withColumn("_side", F.lit(number)) for number, side in enumerate((chosen, rejected))]
    turn = F.struct("turn", "role", "text")
    pairs = sides[0].unionByName(sides[1]).groupBy("_key").agg(*(
        F.sort_array(F.collect_list(F.when(F.col("_side") == number, turn))).alias(name)
        for number, name in enumerate(("chosen", "rejected"))
    ))
    return format_pairs(pairs.withColumnRenamed("_key", pair_column), pair_column, trained_role)


def format_pairs(pairs: DataFrame, pair_column: str = "pair_id", trained_role: str = TRAINED_ROLE) -> DataFrame:
    """The same from rows (pair, chosen, rejected) that hold the ordered turns of both sides as arrays of (turn, role, text)."""
    a, b = F.col("chosen"), F.col("rejected")
    shorter = F.least(F.size(a), F.size(b))
    same = F.transform(
        F.when(shorter > 0, F.sequence(F.lit(0), shorter - 1)).otherwise(F.array().cast("array<int>")),
        lambda i: (F.get(a, i)["role"] == F.get(b, i)["role"]) & (F.get(a, i)["text"] == F.get(b, i)["text"]),
    )
    differs = F.array_position("_same", False)
    n_common = F.when(differs > 0, differs - 1).otherwise(F.size("_same")).cast("int")
    turns = pairs.select(pair_column, a, b, same.alias("_same")).withColumn("n_common", n_common)

    def rest(name: str) -> Column:
        return F.slice(F.col(name), F.col("n_common") + 1, F.size(name)).alias(f"_{name}")

    turns = turns.select(pair_column, "n_common", F.slice(a, F.lit(1), F.col("n_common")).alias("_common"), rest("chosen"), rest("rejected"))
    made = turns.select(
        pair_column, "n_common", _render(F.col("_common")).alias("prompt"), _render(F.col("_chosen")).alias("chosen"),
        _render(F.col("_rejected")).alias("rejected"), _mask(F.col("_chosen"), trained_role).alias("chosen_mask"),
        _mask(F.col("_rejected"), trained_role).alias("rejected_mask"),
    )
    return made.withColumn("usable", (F.size("chosen_mask") > 0) & (F.size("rejected_mask") > 0))


def _clean(turns: DataFrame, key_column: str) -> DataFrame:
    return turns.where(F.col(key_column).isNotNull()).select(
        F.col(key_column).alias("_key"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def _head(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), turn["role"], F.lit(CLOSE))


def _render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), t["text"], F.lit(END))), "")


def _mask(turns: Column, trained_role: str) -> Column:
    """Spans of the trained turns; a running length gives each its place."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<begin: int, end: int>>").alias("spans"))

    def add(state: Column, turn: Column) -> Column:
        begin = state["at"] + F.length(_head(turn))
        end = begin + F.length(turn["text"]) + len(END)
        span = F.struct(begin.alias("begin"), end.alias("end"))
        spans = F.when(turn["role"] == trained_role, F.array_append(state["spans"], span)).otherwise(state["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    return F.aggregate(turns, start, add)["spans"]


def rival_replies(conversations: DataFrame, trained_role: str = TRAINED_ROLE) -> DataFrame:
    """Pairs (pair_id, chosen, rejected) from plain conversations (conv_id, turn, role, text), one per conversation.

    Chosen is the conversation up to its last reply, a turn of ``trained_role``. Rejected is the same with that reply exchanged for the
    last reply of the neighbour, the conversation whose id differs in the lowest bit; without a neighbour's reply the rejected side ends
    before it. A conversation without a reply is the same on both sides. Turns are shuffled once, by conversation; only replies travel to the neighbour.
    """
    clean = _clean(conversations, "conv_id")
    whole = clean.groupBy("_key").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("_turns"))
    last = F.array_max(F.transform("_turns", lambda t, i: F.when(t["role"] == trained_role, i)))
    whole = whole.withColumn("_last", last).withColumn("_reply", F.get("_turns", F.col("_last")))
    # The last reply of the order above; the maximum combines before the shuffle.
    replies = clean.where(F.col("role") == trained_role).groupBy("_key").agg(F.max(F.struct("turn", "text"))["text"].alias("_other"))
    other = replies.select(F.col("_key").cast("long").bitwiseXOR(F.lit(1).cast("long")).alias("_key"), "_other")
    exchanged = F.struct(F.col("_reply.turn").alias("turn"), F.col("_reply.role").alias("role"), F.col("_other").alias("text"))
    reply = F.when(F.col("_other").isNotNull(), F.array(exchanged)).otherwise(F.array().cast(TURNS))
    until = F.slice("_turns", F.lit(1), F.col("_last"))
    alone = F.col("_last").isNull()
    return whole.join(other, "_key", "left").select(
        F.col("_key").alias("pair_id"),
        F.when(alone, F.col("_turns")).otherwise(F.slice("_turns", F.lit(1), F.col("_last") + 1)).alias("chosen"),
        F.when(alone, F.col("_turns")).otherwise(F.concat(until, reply)).alias("rejected"),
    )
