"""True links among the documents of candidate clusters, on full sets of shingles, without comparing all pairs of a cluster.

A cluster that fits into a block is compared within it. A larger one is dealt into blocks; documents that link there are
one piece from then on, and only one document of each piece goes on to the next round of blocks, so near copies in any
number shrink to a few pieces in a few rounds and each document is read once or twice. Pieces that stay apart may still
be linked by other documents of theirs. Two sets that are similar enough share an item among the rarest of each (the
prefix of a set similarity join), so only documents of different pieces that do are compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .work import arrow_map, by_groups, joined_by_count, small, staged

#: Documents, and items of their sets, in a block.
BLOCK, BLOCK_ITEMS = 1024, 2_000_000
EDGES, LABELS = "a long, b long", "node long, label long"


class Forest:
    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union, for sorted sets."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both * 100 >= percent * (len(a) + len(b) - both)


def exact_edges(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """A forest of the true links among the sets: 100 * intersection >= percent * union."""
    n, forest, edges = len(sets), Forest(len(sets)), []
    size = np.array([len(s) for s in sets])
    if n <= 24:
        for x in range(n):
            for y in range(x + 1, n):
                if forest.root(x) != forest.root(y) and similar(sets[x], sets[y], percent) and forest.join(x, y):
                    edges.append((x, y))
        return edges
    owner = np.repeat(np.arange(n), size)
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = count > 1
    place = np.cumsum(common) - 1
    keep = common[column]
    owner, column = owner[keep], place[column[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    both = np.zeros((n, n), np.float32)
    step = 4096
    for first in range(0, int(common.sum()), step):
        a, b = np.searchsorted(column, [first, first + step])
        rows, inside = np.unique(owner[a:b], return_inverse=True)
        block = np.zeros((len(rows), step), np.float32)
        block[inside, column[a:b] - first] = 1
        both[np.ix_(rows, rows)] += block @ block.T
    union = size[:, None] + size[None, :] - both
    for x, y in zip(*np.nonzero(np.triu(both * 100 >= percent * union, 1)), strict=True):
        if forest.join(int(x), int(y)):
            edges.append((int(x), int(y)))
    return edges


def _sets(column: pa.Array | pa.ChunkedArray) -> list[np.ndarray]:
    return [np.frombuffer(s.as_py(), np.uint64) for s in column]


def _blocks() -> F.Column:
    return F.greatest(F.lit(1), F.ceil(F.col("docs") / BLOCK), F.ceil(F.col("items") / BLOCK_ITEMS)).cast("int")


def with_blocks(members: DataFrame) -> DataFrame:
    """(doc_id, cluster, size) with ``blocks``: into how many its cluster is dealt."""
    per = members.groupBy("cluster").agg(F.count("*").alias("docs"), F.sum("size").alias("items"))
    return members.join(per.select("cluster", _blocks().alias("blocks")), "cluster").select("doc_id", "cluster", "size", "blocks")


def links(members: DataFrame, sets_of, percent: int) -> DataFrame:
    """(node, label) for documents that link to a smaller one: label is the smallest document reached.

    ``members`` is a staged (doc_id, cluster, size, blocks); ``sets_of`` gives (cluster, blocks, doc_id, size, shingles) for some
    of its rows, with sorted 64-bit items as bytes. Every group tells its own pieces by their smallest documents, and
    each round maps the pieces of the one before, so no graph is walked but that of links found by rare items.
    """

    def pieces(group: pa.Table) -> pa.Table | None:
        group = group.sort_by("doc_id")
        ids, forest = group["doc_id"].to_numpy(), Forest(group.num_rows)
        for x, y in exact_edges(_sets(group["shingles"]), percent):
            forest.join(x, y)
        label = ids[[forest.root(i) for i in range(len(ids))]]
        moved = label != ids
        return pa.table({"node": ids[moved], "label": label[moved]}) if moved.any() else None

    fits = by_groups(sets_of(members.where("blocks = 1")), ["cluster"], pieces, LABELS)
    large = members.where("blocks > 1")
    if large.isEmpty():
        return fits
    sets = staged(sets_of(large), "sets")
    now, labels, before, turn = large, large.select("doc_id", "cluster", F.col("doc_id").alias("label"), "size"), None, 0
    while True:
        block = F.pmod(F.xxhash64("doc_id", F.lit(turn)), F.col("blocks")).cast("int").alias("block")
        chosen = now.select("doc_id", "blocks", block)
        found = by_groups(sets.drop("blocks").join(small(chosen), "doc_id"), ["cluster", "block"], pieces, LABELS)
        labels = staged(_relabelled(labels, staged(found, "found")), "labels")
        heads = labels.where("doc_id = label").select("doc_id", "cluster", "size")
        open_ = heads.groupBy("cluster").count().where("count > 1").select("cluster")
        now = staged(with_blocks(heads.join(open_, "cluster", "left_semi")), "pieces")
        left, turn = now.count(), turn + 1
        if not left or left == before:
            break
        before = left
    if left:
        apart = staged(labels.join(now.select("cluster").distinct(), "cluster", "left_semi"), "apart")
        linked = _across(sets, apart, percent)
        ends = [apart.select(F.col("doc_id").alias(e), F.col("label").alias(f"label_{e}")) for e in "ab"]
        between = linked.join(ends[0], "a").join(ends[1], "b").select(F.col("label_a").alias("a"), F.col("label_b").alias("b"))
        labels = _relabelled(labels, staged(components(between), "across"))
    return fits.unionByName(labels.where("doc_id <> label").select(F.col("doc_id").alias("node"), "label"))


def _relabelled(labels: DataFrame, found: DataFrame) -> DataFrame:
    """(doc_id, cluster, label, size) with the labels that (node, label) maps replaced; ``found`` is staged."""
    new = small(found.select(F.col("node").alias("label"), F.col("label").alias("to")))
    return labels.join(new, "label", "left").select("doc_id", "cluster", F.coalesce("to", "label").alias("label"), "size")


def _across(sets: DataFrame, apart: DataFrame, percent: int) -> DataFrame:
    """Links between documents of different pieces (``label``) of a cluster, by shared items among the rarest of each.

    Items that one piece alone has are the rarest, then those in the fewest documents; any fixed order would do.
    """

    def items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            each = _sets(batch.column("shingles"))
            row = np.repeat(np.arange(len(each)), [len(s) for s in each])
            token = np.concatenate([*each, np.zeros(0, np.uint64)]).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(pa.array(row)) for c in ("cluster", "label", "doc_id", "size")), pa.array(token)], ["cluster", "label", "doc_id", "size", "token"])

    own = sets.select("doc_id", "shingles").join(small(apart), "doc_id").select("cluster", "label", "doc_id", "size", "shingles")
    tokens = staged(arrow_map(own, items, "cluster long, label long, doc_id long, size long, token long"), "tokens")
    counts = staged(tokens.groupBy("cluster", "token").agg(F.count("*").alias("times"), (F.min("label") != F.max("label")).alias("shared")), "counts")
    ordered = joined_by_count(tokens, counts, ["cluster", "token"], tokens.count()).groupBy("cluster", "label", "doc_id", "size").agg(F.sort_array(F.collect_list(F.struct("shared", "times", "token"))).alias("x"))
    prefix = F.slice("x", F.lit(1), (F.col("size") - F.ceil(F.col("size") * percent / 100) + 1).cast("int"))
    rare = staged(ordered.select("cluster", "label", "doc_id", "size", F.explode(prefix).alias("x")).where("x.shared").select("cluster", "label", "doc_id", "size", F.col("x.token").alias("token")), "rare")
    other = rare.select("cluster", "token", F.col("label").alias("label_b"), F.col("doc_id").alias("b"), F.col("size").alias("size_b"))
    fits = 100 * F.least("size", "size_b") >= percent * F.greatest("size", "size_b")
    pairs = rare.join(other, ["cluster", "token"]).where((F.col("label") < F.col("label_b")) & fits).select(F.col("doc_id").alias("a"), "b").distinct()
    both = pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x")), "a").join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y")), "b")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [similar(x, y, percent) for x, y in zip(_sets(batch.column("x")), _sets(batch.column("y")), strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return arrow_map(both.select("a", "b", "x", "y"), check, EDGES)
