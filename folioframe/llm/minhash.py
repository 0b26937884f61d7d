"""Near-duplicate documents by HyperMinHash.

A document's set of word shingles becomes ``REGISTERS`` compressed registers: the least hash of each bucket kept as a
leading-zero count and ten mantissa bits. Bands of registers give candidate groups; inside a group the registers'
agreement, corrected for chance collisions, decides which documents may be near; those are confirmed on full sets.

Sizes: band rows are 16 bytes, ``BANDS`` per distinct text, and only those of bands that two texts share are written.
Groups are walked breadth first, so a group of near copies costs about its size; links leave a group as a forest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordering import free_name
from .components import components
from .confirm import links, with_blocks
from .kernels import U64, mix, shingle_sets
from .work import arrow_map, by_groups, discard, small, staged

REGISTERS, ROWS = 240, 6
BANDS = REGISTERS // ROWS
MANTISSA = 10
#: Chance that two registers of different minima agree.
COLLISION = 0.36 / (1 << MANTISSA)
#: Documents of one band that are weighed by their registers; where more share a band, all of them are candidates.
BAND = 4096

_EDGES = np.array([-(-(i << 64) // REGISTERS) for i in range(REGISTERS)], dtype=np.uint64)
_order: np.ndarray | None = None


def _borrow() -> np.ndarray:
    """For each register the order in which it looks for a filled bucket."""
    global _order
    if _order is None:
        rng = np.random.default_rng(5)
        _order = np.array([rng.permutation(REGISTERS) for _ in range(REGISTERS)])
    return _order


def registers(shingles: np.ndarray) -> np.ndarray:
    """The compressed registers of a non-empty sorted set; empty buckets borrow from filled ones."""
    value = mix(shingles ^ U64(0xABCDEF12345))
    at = np.searchsorted(shingles, _EDGES)
    filled = np.append(at[1:], len(shingles)) > at
    least = np.empty(REGISTERS, U64)
    least[filled] = np.minimum.reduceat(value, at[filled])
    if not filled.all():
        order = _borrow()
        source = order[np.arange(REGISTERS), filled[order].argmax(1)]
        least[~filled] = least[source[~filled]]
    zeros = np.minimum(64 - np.frexp(least.astype(np.float64))[1], 63)
    mantissa = ((least << zeros.astype(U64)) >> U64(63 - MANTISSA)) & U64((1 << MANTISSA) - 1)
    return zeros.astype(np.uint16) << MANTISSA | mantissa.astype(np.uint16)


def corrected(agree: np.ndarray) -> np.ndarray:
    """Jaccard similarity from the share of agreeing registers, less what chance collisions add."""
    return np.maximum(0, (agree - COLLISION) / (1 - COLLISION))


def _sketch(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, keys, sizes, regs = batch.column(0), [], [], []
        for s in shingle_sets(batch.column(1), width):
            sizes.append(len(s))
            if len(s):
                both = np.bitwise_xor.reduce(mix(s)), np.bitwise_xor.reduce(mix(s + U64(0x1234567)))
                keys.append(np.array([*both, len(s)], U64).tobytes())
                regs.append(registers(s).tobytes())
            else:
                keys.append(None)
                regs.append(None)
        yield pa.RecordBatch.from_arrays([ids.cast(pa.int64()), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), pa.array(regs, pa.binary())], ["doc_id", "key", "n_shingles", "regs"])


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        regs = np.frombuffer(b"".join(batch.column("regs").to_pylist()), np.uint16).reshape(n, BANDS, ROWS)
        key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (n, BANDS)).copy()
        for j in range(ROWS):
            key = mix(key * U64(31) + regs[:, :, j].astype(U64) + U64(7))
        ids = np.repeat(batch.column("rep").to_numpy(zero_copy_only=False), BANDS)
        yield pa.RecordBatch.from_arrays([pa.array(key.reshape(-1).view(np.int64)), pa.array(ids)], ["band", "rep"])


def near_edges(regs: np.ndarray, sizes: np.ndarray, least: float, percent: int) -> list[tuple[int, int]]:
    """A forest over a group: rows in one tree are joined by steps of estimated similarity ``least`` or more and of sizes that allow ``percent``.

    Breadth first from each unvisited row, always against unvisited rows only.
    """
    n = len(regs)
    todo = np.ones(n, bool)
    edges = []
    for root in range(n):
        if not todo[root]:
            continue
        todo[root] = False
        front = [root]
        while front:
            x = front.pop()
            left = np.flatnonzero(todo)
            if not len(left):
                break
            fits = left[(100 * np.minimum(sizes[left], sizes[x]) >= percent * np.maximum(sizes[left], sizes[x]))]
            if not len(fits):
                continue
            near = fits[corrected((regs[fits] == regs[x]).mean(1)) >= least]
            todo[near] = False
            edges += [(x, int(y)) for y in near]
            front += near.tolist()
    return edges


def _sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [s.tobytes() for s in shingle_sets(batch.column("text"), width)]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("cluster", "blocks", "doc_id", "size")), pa.array(found, pa.binary())], ["cluster", "blocks", "doc_id", "size", "shingles"])


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80, width: int = 5, margin: float = 0.13) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest doc_id reachable over links), kept (doc_id = component_id).

    Documents link when their sets of ``width``-word shingles have 100 * intersection >= ``percent`` * union. ``margin``
    is what an estimate may fall short of that and still be confirmed on full sets; it is over five standard
    deviations. If registers agree independently, a pair of similarity s shares no band with a chance of
    (1 - s**ROWS)**BANDS: 6e-9 for 0.85, 5e-6 for 0.8.

    Null and empty texts, and texts without words, have no shingles and link with nothing. Rows that share a doc_id
    count as one document. A row with null doc_id is kept, with a null component. Other columns are ignored.
    """
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sketch = staged(arrow_map(own, lambda it: _sketch(it, width), "doc_id long, key binary, n_shingles long, regs binary"), "sketch")
    with_set = sketch.where("key is not null and doc_id is not null")
    classes = staged(with_set.groupBy("key").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")), "classes")
    # A class of equal sets goes on as its smallest document.
    reps = with_set.join(classes.select("key", F.col("rep").alias("doc_id")), ["key", "doc_id"]).dropDuplicates(["doc_id", "key"]).select(F.col("doc_id").alias("rep"), "n_shingles", "regs")
    reps = staged(reps, "reps")
    rows = arrow_map(reps.select("rep", "regs"), _bands, "band long, rep long")
    shared = staged(rows.groupBy("band").agg(F.count("*").alias("n"), F.min("rep").alias("first")).where("n > 1"), "bands")
    bands = staged(rows.join(small(shared), "band"), "members")
    # A band with very many documents is no evidence to weigh in one task: all of them are candidates.
    hot = bands.where((F.col("n") > BAND) & (F.col("rep") != F.col("first"))).select(F.col("first").alias("a"), F.col("rep").alias("b"))
    in_band = Window.partitionBy("band")
    few = bands.where(F.col("n") <= BAND).select("band", "rep", "n", F.bit_xor(F.xxhash64("rep")).over(in_band).alias("x"), F.bit_xor(F.xxhash64("rep", F.lit(1))).over(in_band).alias("y"))
    # The same documents often share many bands: one band of each such group is enough.
    alike = Window.partitionBy("n", "x", "y")
    groups = few.withColumn("one", F.min("band").over(alike)).where("band = one").select("band", "rep")
    members = groups.join(reps, "rep")
    least = percent / 100 - margin

    def walk(group: pa.Table) -> pa.Table | None:
        ids = group["rep"].to_numpy()
        regs = np.frombuffer(b"".join(group["regs"].to_pylist()), np.uint16).reshape(-1, REGISTERS)
        found = near_edges(regs, group["n_shingles"].to_numpy(), least, percent)
        return pa.table({"a": ids[[x for x, _ in found]], "b": ids[[y for _, y in found]]}) if found else None

    clusters = components(by_groups(members, ["band"], walk, "a long, b long").unionByName(hot))
    sized = clusters.select(F.col("node").alias("doc_id"), F.col("label").alias("cluster")).join(reps.select(F.col("rep").alias("doc_id"), F.col("n_shingles").alias("size")), "doc_id")
    inside = staged(with_blocks(sized), "inside")
    for done in (reps, shared, bands):
        discard(done)
    named = own.where("doc_id is not null")
    sets_of = lambda rows: arrow_map(named.join(small(rows), "doc_id").select("cluster", "blocks", "doc_id", "size", "text"), lambda it: _sets(it, width), "cluster long, blocks int, doc_id long, size long, shingles binary")
    labels = links(inside, sets_of, percent)
    copies = classes.where("copies > 1").select("key", "rep")
    out = sketch.select("doc_id", "key", "n_shingles").join(copies, "key", "left").withColumn("rep", F.when(F.col("doc_id").isNotNull(), F.coalesce("rep", "doc_id")))
    out = out.join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component_id", F.coalesce("label", "rep"))
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` less near-duplicates: of each component its smallest id stays, once; rows with null id stay.

    What goes is joined away: by a broadcast of the ids while their number is under a checked bound, so that texts
    aren't shuffled, else by a shuffle. Only rows whose id is repeated are ordered.
    """
    found = staged(near_duplicates(docs, id_col, **options), "verdicts")
    gone = staged(found.where("not kept").select(F.col("doc_id").alias(id_col)).distinct(), "gone")
    out = docs.join(small(gone), id_col, "left_anti")
    again = staged(found.where("kept and doc_id is not null").groupBy(F.col("doc_id").alias(id_col)).count().where("count > 1").select(id_col), "again")
    if not again.isEmpty():
        order = Window.partitionBy(id_col).orderBy(F.xxhash64(*docs.columns))
        place = free_name(docs.columns, "place")
        one = out.join(again, id_col, "left_semi").withColumn(place, F.row_number().over(order)).where(F.col(place) == 1).drop(place)
        out = out.join(again, id_col, "left_anti").unionByName(one)
    return out.select(*docs.columns)
