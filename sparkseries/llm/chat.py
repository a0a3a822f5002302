"""Logged conversations: snapshots that a longer conversation contains collapse into it before rendering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkseries.llm.common import stored


def _turns(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    return turns.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).alias("conv"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """``(conv, n, a, b, last)``: for each turn a 128-bit hash of the conversation up to it.

    The hash of ``n`` turns is the exclusive or of ``n`` turn hashes, each with
    its place, so it rolls on from the hash of ``n - 1`` turns in a window
    frame that only grows.  Input columns are ``conv, turn, role, text``.
    """
    order = Window.partitionBy("conv").orderBy("turn", "role", "text")
    whole = F.struct("turn", "role", "text")
    once = turns.withColumn("again", F.lag(whole).over(order).eqNullSafe(whole)).where("NOT again")
    rows = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = once.withColumn("n", F.row_number().over(order)).withColumn("last", F.lead(F.lit(1)).over(order).isNull())
    return placed.select(
        "conv",
        "n",
        F.bit_xor(F.xxhash64("n", "role", "text")).over(rows).alias("a"),
        F.bit_xor(F.xxhash64("text", "role", "n")).over(rows).alias("b"),
        "last",
    )


def rendered(turns: Column, before: str, between: str, after: str) -> Column:
    """Text of a conversation from its sorted array of turns."""
    parts = F.transform(turns, lambda t: F.concat(F.lit(before), t["role"], F.lit(between), t["text"], F.lit(after)))
    return F.array_join(parts, "")


def maximal_conversations(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    before: str = "<|im_start|>",
    between: str = "\n",
    after: str = "<|im_end|>\n",
) -> DataFrame:
    """``(conv_col, n_turns, copies, rendered)`` of every conversation that is no part of a longer one.

    A conversation is its turns in order of ``turn_col``, then role and text.
    One whose whole sequence of (role, text) begins a longer conversation is a
    snapshot of it and is left out.  Of equal conversations the smallest id
    stays; ``copies`` says how many there were.  Turn numbers order turns and
    are not compared.  Null roles and texts count as empty, turns without a
    number come first, a repeated row counts once, and rows without a
    conversation id belong to none.  Other columns are not read, whatever their
    names.  An empty table gives an empty result.

    Scale: the comparison shuffles hashes only.  Equal conversations and equal
    prefixes are aggregated before their shuffle, so a conversation or a first
    turn that a third of the log shares is one row in the anti-join.  Texts are
    shuffled once, for conversations that stay.  A conversation itself is one
    output row and so passes through one task.
    """
    own = _turns(turns, conv_col, turn_col, role_col, text_col)
    hashes = stored(prefix_hashes(own), "turn-prefixes")
    whole = hashes.where("last").groupBy("n", "a", "b").agg(F.min("conv").alias("conv"), F.count("*").alias("copies"))
    begun = hashes.where("NOT last").select("n", "a", "b").distinct()
    maximal = whole.join(begun, ["n", "a", "b"], "left_anti").select("conv", F.col("n").cast("long").alias("n_turns"), "copies")
    texts = own.join(maximal, "conv").groupBy("conv", "n_turns", "copies").agg(
        F.sort_array(F.collect_set(F.struct("turn", "role", "text"))).alias("turns")
    )
    return texts.select(F.col("conv").alias(conv_col), "n_turns", "copies", rendered(F.col("turns"), before, between, after).alias("rendered"))
