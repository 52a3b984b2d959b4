"""Chat formatting: cumulative snapshots are collapsed before conversations are rendered.

A conversation that was logged after every turn appears as many rows, each a prefix of the
longest. Every turn gets a rolling hash of all turns up to it; a conversation whose
last hash is an earlier hash of a longer one is a snapshot of it. Of conversations
with the same turns the one with the smallest id stays. Anti-joins leave the maximal ones.

The rolling hash is two 64-bit exclusive-or sums of hashes of place, role and text, so it is a
running window sum; a chance meeting needs 2**64 prefixes.

Equal prefixes are reduced to one row before the shuffle and equal conversations before the
anti-join, so a first turn or a conversation that a third of the log repeats is no hot key. The
turns of one conversation meet in one task, as they must to become one rendered row. Turns without
an id are counted by role and text before any shuffle, so a log that lacks a third of its ids is no hot key.

Defined results: turns are ordered by turn number, then role, then text; a null turn number
comes first. A null role is rendered as ``unknown`` and a null text as empty, but they count as different
from these. Rows that repeat are turns of their own. A turn with a null conversation id is a conversation of
its own: nothing says which turns belong to it. Equal ones are copies, and like all others they give way to an
equal conversation with an id and to longer ones that begin with them. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskmart.sources.scratch import keep, temporary

OPEN, BETWEEN, CLOSE = "<|im_start|>", "\n", "<|im_end|>\n"


def _hash(seed: int, place: Column) -> Column:
    return F.xxhash64(F.lit(seed), place, F.col("role").isNull(), "role", F.col("text").isNull(), "text")


def prefix_hashes(turns: DataFrame, conversation: str, turn: str, role: str, text: str) -> DataFrame:
    """``id``, ``place`` from 1, rolling hashes ``h1`` and ``h2``, and whether the turn is the ``last``; turns with an id."""
    order = Window.partitionBy("id").orderBy("turn", "role", "text")
    named = turns.where(F.col(conversation).isNotNull()).select(
        F.col(conversation).alias("id"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text")
    )
    placed = named.withColumn("place", F.row_number().over(order))

    def rolling(seed: int) -> Column:
        return F.bit_xor(_hash(seed, F.col("place"))).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))

    return placed.select(
        "id", "place", rolling(1).alias("h1"), rolling(2).alias("h2"), F.lead("place").over(order).isNull().alias("last")
    )


def unnamed(turns: DataFrame, conversation: str, role: str, text: str) -> DataFrame:
    """``role``, ``text``, ``copies`` and hashes of the different turns without an id, each a conversation of one turn."""
    alone = turns.where(F.col(conversation).isNull()).select(F.col(role).alias("role"), F.col(text).alias("text"))
    counted = alone.groupBy("role", "text").agg(F.count("*").alias("copies"))
    return counted.withColumns({"h1": _hash(1, F.lit(1)), "h2": _hash(2, F.lit(1))})


def maximal(turns: DataFrame, conversation: str, turn: str, role: str, text: str) -> DataFrame:
    """``id``, ``turns``, ``copies`` and hashes of the conversations that are no snapshot of another."""
    same = ["place", "h1", "h2"]
    with temporary():
        hashed = keep(prefix_hashes(turns, conversation, turn, role, text), "turns")
        no_id = F.lit(None).cast(hashed.schema["id"].dataType).alias("id")
        alone = unnamed(turns, conversation, role, text).select(F.lit(1).alias("place"), "h1", "h2", no_id, "copies")
        ended = hashed.where("last").select(*same, "id", F.lit(1).cast("long").alias("copies"))
        ends = ended.unionByName(alone).groupBy(*same).agg(F.min("id").alias("id"), F.sum("copies").alias("copies"))
        earlier = hashed.where("NOT last").select(*same).distinct()
        whole = keep(ends.join(earlier, same, "left_anti"), "maximal", lasting=True)
    return whole.select("id", F.col("place").alias("turns"), "copies", "h1", "h2")


def render(turns: Column) -> Column:
    """The text of ordered turns (structs of ``role`` and ``text``)."""
    line = F.transform(
        turns,
        lambda t: F.concat(
            F.lit(OPEN), F.coalesce(t["role"], F.lit("unknown")), F.lit(BETWEEN), F.coalesce(t["text"], F.lit("")), F.lit(CLOSE)
        ),
    )
    return F.array_join(line, "")


def format_chats(
    turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row for each maximal conversation: its id, ``n_turns``, ``n_copies`` and ``rendered`` text."""
    turns = turns.select(conversation, turn, role, text)
    whole = maximal(turns, conversation, turn, role, text)
    kept = whole.where(F.col("id").isNotNull()).select(F.col("id").alias("kept_id"), F.col("turns").alias("n"), "copies")
    rows = turns.join(kept, turns[conversation] == kept["kept_id"])
    parts = F.struct(F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    chats = rows.groupBy("kept_id", "n", "copies").agg(F.sort_array(F.collect_list(parts)).alias("parts"))
    alone = whole.where(F.col("id").isNull()).drop("copies").join(
        unnamed(turns, conversation, role, text), ["h1", "h2"]
    )
    alone = alone.select(
        F.col("id").alias("kept_id"), F.col("turns").alias("n"), "copies", F.array(F.struct("role", "text")).alias("parts")
    )

    def rendered(chats: DataFrame) -> DataFrame:
        return chats.select(
            F.col("kept_id").alias(conversation),
            F.col("n").cast("long").alias("n_turns"),
            F.col("copies").alias("n_copies"),
            render(F.col("parts")).alias("rendered"),
        )

    return rendered(chats).unionByName(rendered(alone))
