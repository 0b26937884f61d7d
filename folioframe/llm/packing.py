"""Best-fit packing of documents into sequences of several permitted lengths: each bin opens with the length that costs least."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import VOCABULARY, counter, ranks
from .work import arrow_map, by_groups, staged

CAPACITIES = (512, 1024, 2048, 4096, 8192)
PIECES = "doc_id long, piece int, start long, length long"


def sequence_cost(capacity: int) -> float:
    """What a sequence of a length costs: its positions, and attention that grows with the square."""
    return capacity + capacity * capacity / 65536


class Remaining:
    """How many items of each length are still to be placed, with the lengths that are left at hand."""

    def __init__(self, lengths: np.ndarray):
        self.count = np.bincount(lengths).tolist() if len(lengths) else [0]
        self.mask = sum(1 << i for i, c in enumerate(self.count) if c and i)

    def take(self, n: int) -> None:
        self.count[n] -= 1
        if not self.count[n]:
            self.mask &= ~(1 << n)

    def fill(self, space: int) -> int:
        """How much of ``space`` the items that remain would fill, the longest that fits first."""
        left = space
        below = self.mask & ((1 << (left + 1)) - 1)
        while below:
            n = below.bit_length() - 1
            left -= n * min(self.count[n], left // n)
            below &= (1 << min(n, left + 1)) - 1
        return space - left


def opening(n: int, remaining: Remaining, capacities: tuple[int, ...], cost: Callable[[int], float]) -> int:
    """The capacity to open for an item: least cost a filled position, as the items that remain would fill it; the smaller of equals."""
    best = None
    for c in capacities:
        if c >= n:
            filled = n + remaining.fill(c - n)
            rate = cost(next(d for d in capacities if d >= filled)) / max(1, filled)
            if best is None or rate < best[0]:
                best = rate, c
    return best[1]


def best_fit(lengths: np.ndarray, floor: int | None, capacities: tuple[int, ...], cost: Callable[[int], float] = sequence_cost) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Bins and offsets of the items, longest first, and the bins' contents.

    An item goes where the least space is left, of equal spaces to the bin that got its space last; else a bin opens
    with the capacity that ``opening`` chooses, or, given a ``floor``, the smallest that is as large and holds it. Spaces are found in a bit set, so an item costs about the same however
    many bins are open.
    """
    remaining = Remaining(lengths)
    spaces: list[list[int]] = [[] for _ in range(capacities[-1] + 1)]
    mask, used = 0, []
    where, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        remaining.take(n)
        fits = mask >> n
        if fits:
            space = n + (fits & -fits).bit_length() - 1
            b = spaces[space].pop()
            if not spaces[space]:
                mask &= ~(1 << space)
        else:
            space = opening(n, remaining, capacities, cost) if floor is None else next(c for c in capacities if c >= n and c >= floor)
            b = len(used)
            used.append(0)
        where[i], offset[i] = b, used[b]
        used[b] += n
        left = space - n
        spaces[left].append(b)
        mask |= 1 << left
    return where, offset, used


def pack(lengths: np.ndarray, capacities: tuple[int, ...] = CAPACITIES, cost: Callable[[int], float] = sequence_cost) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each item its bin, its offset, and its bin's capacity: the smallest that holds the bin's contents in the end.

    Bins open by expected cost; runs with one least opening size for all bins are made as well, and where the
    expectation misleads, the cheapest of them stays.
    """
    sizes = np.array(capacities)
    best = None
    for floor in (None, *capacities):
        where, offset, used = best_fit(lengths, floor, capacities, cost)
        final = sizes[np.searchsorted(sizes, np.array(used, np.int64))]
        total = sum(cost(int(c)) * k for c, k in zip(*np.unique(final, return_counts=True), strict=True))
        if best is None or total < best[0]:
            best = total, where, offset, final
    _, where, offset, final = best
    return where, offset, final[where] if len(where) else where


def _pieces(batches: Iterator[pa.RecordBatch], longest: int, count: Callable[[str], int]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = np.array([count(t.as_py() or "") for t in batch.column("text")], np.int64)
        k = np.maximum(1, -(-n // longest))
        row = np.repeat(np.arange(len(n)), k)
        piece = np.arange(len(row)) - np.repeat(np.cumsum(k) - k, k)
        start = piece * longest
        yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(np.minimum(longest, n[row] - start))], ["doc_id", "piece", "start", "length"])


def packed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacities: tuple[int, ...] = CAPACITIES, separator: int = 1, shard_rows: int = 20_000, vocabulary: str = VOCABULARY) -> DataFrame:
    """Per piece of a document: doc_id, piece, start and length in tokens, bin_id, bin_offset, capacity.

    Tokens are those of the byte-pair ``vocabulary``, a file that the driver reads. Each piece takes its tokens and
    ``separator`` places. A document longer than the largest capacity is cut into full pieces and a rest; one with an
    empty or null text is a piece of length 0. Rows are dealt by hash into
    shards of about ``shard_rows``, each packed on its own, so the number of shards grows with the input and a shard
    wastes a few bins at most. Ids may be null or repeated; the packing of equal inputs is equal.
    """
    capacities = tuple(sorted(set(capacities)))
    longest = capacities[-1] - separator
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(ranks(vocabulary))
    pieces = staged(arrow_map(own, lambda it: _pieces(it, longest, counter(sent.value).total), PIECES), "pieces")
    shards = max(1, -(-pieces.count() // shard_rows))
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "length"), F.lit(shards)).cast("int"))

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending")])
        where, offset, capacity = pack(group["length"].to_numpy() + separator, capacities)
        bins = where + (int(group["shard"][0].as_py()) << 32)
        return group.drop_columns(["shard"]).append_column("bin_id", pa.array(bins)).append_column("bin_offset", pa.array(offset)).append_column("capacity", pa.array(capacity.astype(np.int32)))

    return by_groups(dealt, ["shard"], run, f"{PIECES}, bin_id long, bin_offset long, capacity int")
