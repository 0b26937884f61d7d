"""Connected components of an edge table, without bringing it to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .work import discard, staged


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """One star step: each node hands its lower (small) or higher (large) neighbours the least node it knows."""
    if small:
        pairs = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    else:
        pairs = edges.select(F.explode(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v")))).alias("e")).select("e.*")
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    moved = pairs.join(least, "u")
    if small:
        own = least.where("u <> m").select(F.col("u").alias("a"), F.col("m").alias("b"))
        return moved.where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(own).distinct()
    return moved.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, label): for each node of an edge (a, b), the smallest node that it reaches.

    Alternating large-star and small-star steps; every round is a written table, so the plan stays short and a lost
    executor repeats one round at most. Self-loops, repeated and reversed edges are allowed; null ends are ignored;
    an empty table gives an empty result.
    """
    now = staged(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    print_of = lambda df: df.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
    before = print_of(now)
    for _ in range(most_rounds):
        if not before[0]:
            break
        nxt = staged(_star(_star(now, small=False), small=True), "edges")
        after = print_of(nxt)
        discard(now)
        now = nxt
        if tuple(after) == tuple(before):
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
