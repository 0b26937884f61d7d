"""Chat formatting: logged conversations that are prefixes of longer ones collapse into them, the rest is rendered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .work import staged


def _turn_hash(salt: int) -> Column:
    """A hash of one turn at its position; nulls differ from empty texts."""
    return F.xxhash64(F.lit(salt), F.col("pos"), F.col("role").isNull(), F.coalesce("role", F.lit("")), F.col("text").isNull(), F.coalesce("text", F.lit("")))


def prefixes(turns: DataFrame) -> DataFrame:
    """Per turn: conv_id, pos (from 1), the 128-bit rolling hash (x, y) of all turns up to it, and whether it is the last."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = turns.withColumn("pos", F.row_number().over(order)).withColumn("last", F.lead("pos").over(order).isNull())
    return placed.withColumn("x", F.bit_xor(_turn_hash(1)).over(so_far)).withColumn("y", F.bit_xor(_turn_hash(2)).over(so_far)).select("conv_id", "pos", "x", "y", "last")


def maximal(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, n_turns, n_copies): the conversations that no longer one starts with, one of each set of equal ones.

    Turns are ordered by turn, then role and text, so ties have a defined order; positions, not turn numbers, are
    compared. Of equal conversations the smallest id stays. Turns with null conv_id form one conversation of that id.
    Prefix hashes are made distinct before they are shuffled to the anti-join, so a first turn that a third of all
    conversations share is one row a task. A conversation is ordered in one task, spilling where it is long.
    """
    own = turns.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text"))
    marks = staged(prefixes(own), "prefixes")
    whole = marks.where("last").groupBy("pos", "x", "y").agg(F.min(F.struct(F.col("conv_id").isNotNull().alias("named"), "conv_id")).alias("first"), F.count("*").alias("n_copies"))
    inner = marks.where("not last").select("pos", "x", "y").distinct()
    return whole.join(inner, ["pos", "x", "y"], "left_anti").select(F.col("first.conv_id").alias("conv_id"), F.col("pos").cast("long").alias("n_turns"), "n_copies")


def render(turns: DataFrame, kept: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The kept conversations with their text: each turn as ``<|im_start|>role``, its text, ``<|im_end|>``. Null roles and texts render empty."""
    own = turns.select(F.col(conv_col).cast("long").alias("c"), F.struct(F.col(turn_col).cast("long").alias("turn"), F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text")).alias("t"))
    said = own.join(kept.select(F.col("conv_id").alias("c"), F.lit(True).alias("here")).withColumnRenamed("c", "k"), F.col("c").eqNullSafe(F.col("k")), "left_semi")
    line = lambda t: F.concat(F.lit("<|im_start|>"), F.coalesce(t["role"], F.lit("")), F.lit("\n"), F.coalesce(t["text"], F.lit("")), F.lit("<|im_end|>\n"))
    texts = said.groupBy("c").agg(F.sort_array(F.collect_list("t")).alias("t")).select(F.col("c"), F.array_join(F.transform("t", line), "").alias("text"))
    return kept.join(texts, F.col("conv_id").eqNullSafe(F.col("c")), "left").select("conv_id", "n_turns", "n_copies", "text")


def chat(turns: DataFrame, **columns: str) -> DataFrame:
    """(conv_id, n_turns, n_copies, text): maximal conversations, rendered. An empty table gives an empty result."""
    kept = staged(maximal(turns, **columns), "maximal")
    return render(turns, kept, **columns)
