"""Compression of vectors to codes: one codebook a part, fitted by Lloyd's rounds with Hamerly's bounds.

All arithmetic is on integers, so results don't depend on how rows are dealt. With each vector a table keeps, for each
part, the entry it has, an upper bound of its distance from that entry and a lower bound of its distance from any other.
When entries move, the bounds move with them; a part whose upper bound stays strictly below its lower bound, or below half
the way from its entry to the nearest other one, keeps its entry unseen. Only then nothing ties; where a bound fails even
after the upper one was made exact, all entries are scanned and the lowest index of the nearest wins. Bounds are rounded
outward, so rounding never skips a scan.

A round reads one such table and writes the next in the shared folder; it sends one row per part and entry from a task,
and the driver sees the new codebooks alone: at most PARTS * ENTRIES rows, whatever the input has.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .work import arrow_map, discard, joined_by_count, staged

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Scaled components beyond this are cut to it: so squared distances of vectors of up to 256 components fit in 64 bits.
LARGEST = 1 << 26
#: Outward rounding of bounds: many times what a few operations on doubles can err by.
_UP, _DOWN = 1 + 1e-9, 1 - 1e-9
_STATE = "vec_id long, label long, q binary, code binary, upper binary, lower binary"


def _scaled(x: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(SCALE * x.astype(np.float64)), -LARGEST, LARGEST).astype(np.int64)


def _kept(batches: Iterator[pa.RecordBatch], dim: int | None) -> Iterator[pa.RecordBatch]:
    """Whole finite vectors of ``dim`` components (of any number, if None), scaled, as packed integers."""
    for batch in batches:
        column = batch.column(2)
        lists = column.cast(pa.large_list(pa.float64()))
        sizes = np.diff(lists.offsets.to_numpy())
        values = lists.values.to_numpy(zero_copy_only=False)  # null components become NaN
        base = lists.offsets.to_numpy()
        bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
        good = lists.is_valid().to_numpy(zero_copy_only=False) & (sizes > 0) & (sizes % PARTS == 0) & (bad[base[1:]] == bad[base[:-1]])
        if dim is not None:
            good &= sizes == dim
        at = np.flatnonzero(good)
        packed = [_scaled(values[base[i] : base[i + 1]]).astype("<i4").tobytes() for i in at]
        take = pa.array(at)
        yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array(packed, pa.binary())], ["vec_id", "label", "q"])


def _matrix(column: pa.Array, kind: str, width: int) -> np.ndarray:
    """Equally long packed rows as one table."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


def _packed(table: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in table], pa.binary())


def _distances(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Squared distances of rows from entries as exact integers: through doubles where they hold every sum exactly, else in 64 bits."""
    most = int(max(np.abs(x).max(initial=0), np.abs(book).max(initial=0)))
    if 4 * most * most * x.shape[1] < 1 << 53:
        a, b = x.astype(np.float64), book.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)).astype(np.int64)
    return np.stack([((x - c) ** 2).sum(1) for c in book], axis=1)


def _own(x: np.ndarray, book: np.ndarray, code: np.ndarray) -> np.ndarray:
    return ((x - book[code]) ** 2).sum(1)


def _full(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a full scan: the nearest entry of lowest index, an upper bound of its distance, a lower bound of the second nearest's."""
    d = _distances(x, book)
    code = d.argmin(1)
    rows = np.arange(len(x))
    nearest = d[rows, code].copy()
    d[rows, code] = np.iinfo(np.int64).max
    second = d.min(1).astype(np.float64)
    return code, np.sqrt(nearest.astype(np.float64)) * _UP, np.sqrt(second) * _DOWN


class Moves:
    """What one round's change of a codebook does to bounds."""

    def __init__(self, before: np.ndarray, after: np.ndarray) -> None:
        moved = np.sqrt(((after - before) ** 2).sum(1).astype(np.float64)) * _UP
        order = np.argsort(-moved, kind="stable")
        self.own = moved
        # The farthest move of any other entry.
        self.other = np.full(len(moved), moved[order[0]])
        self.other[order[0]] = moved[order[1]] if len(moved) > 1 else 0.0
        apart = _distances(after, after)
        np.fill_diagonal(apart, np.iinfo(np.int64).max)
        self.half = np.sqrt(apart.min(1).astype(np.float64)) / 2 * _DOWN


def assigned(x: np.ndarray, book: np.ndarray, moves: Moves, code: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """The entries and bounds of rows after a round's moves, and how many rows were scanned in full."""
    code = code.copy()
    upper = (upper + moves.own[code]) * _UP
    lower = np.maximum(lower - moves.other[code], 0) * _DOWN
    least = np.maximum(lower, moves.half[code])
    open_ = np.flatnonzero(upper >= least)
    upper[open_] = np.sqrt(_own(x[open_], book, code[open_]).astype(np.float64)) * _UP
    scan = open_[upper[open_] >= least[open_]]
    if len(scan):
        code[scan], upper[scan], lower[scan] = _full(x[scan], book)
    return code, upper, lower, len(scan)


def _parts(q: np.ndarray, width: int) -> list[np.ndarray]:
    return [q[:, p * width : (p + 1) * width] for p in range(PARTS)]


def _first(batches: Iterator[pa.RecordBatch], books: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    width = books[0].shape[1]
    for batch in batches:
        found = [_full(x, b) for x, b in zip(_parts(_matrix(batch.column("q"), "<i4", PARTS * width).astype(np.int64), width), books, strict=True)]
        code, upper, lower = (np.stack(c, axis=1) for c in zip(*found, strict=True))
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("vec_id", "label", "q")), _packed(code.astype(np.uint8)), _packed(upper), _packed(lower)], ["vec_id", "label", "q", "code", "upper", "lower"])


def _again(batches: Iterator[pa.RecordBatch], before: list[np.ndarray], books: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    width = books[0].shape[1]
    moves = [Moves(a, b) for a, b in zip(before, books, strict=True)]
    for batch in batches:
        parts = _parts(_matrix(batch.column("q"), "<i4", PARTS * width).astype(np.int64), width)
        held = [_matrix(batch.column(c), k, PARTS) for c, k in (("code", np.uint8), ("upper", np.float64), ("lower", np.float64))]
        found = [assigned(parts[p], books[p], moves[p], held[0][:, p].astype(np.int64), held[1][:, p], held[2][:, p])[:3] for p in range(PARTS)]
        code, upper, lower = (np.stack(c, axis=1) for c in zip(*found, strict=True))
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("vec_id", "label", "q")), _packed(code.astype(np.uint8)), _packed(upper), _packed(lower)], ["vec_id", "label", "q", "code", "upper", "lower"])


def _sums(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """A task's sum and count of each part's entries."""
    total, count = np.zeros((PARTS, ENTRIES, width), np.int64), np.zeros((PARTS, ENTRIES), np.int64)
    for batch in batches:
        code = _matrix(batch.column("code"), np.uint8, PARTS)
        for p, x in enumerate(_parts(_matrix(batch.column("q"), "<i4", PARTS * width).astype(np.int64), width)):
            np.add.at(total[p], code[:, p], x)
            count[p] += np.bincount(code[:, p], minlength=ENTRIES)
    part, entry = np.nonzero(count)
    columns = [part, entry, count[part, entry], *total[part, entry].T]
    yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c), pa.int64()) for c in columns], ["part", "entry", "n", *(f"s{i}" for i in range(width))])


def _moved(state: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """Each entry as the floor of its parts' mean; entries that no part has stay."""
    width = books[0].shape[1]
    names = [f"s{i}" for i in range(width)]
    each = arrow_map(state.select("q", "code"), lambda it: _sums(it, width), ", ".join(f"{c} long" for c in ("part", "entry", "n", *names)))
    out = [b.copy() for b in books]
    for r in each.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in names]).collect():  # at most PARTS * ENTRIES rows
        out[r.part][r.entry] = [r[c] // r.n for c in names]
    return out


def _coded(batches: Iterator[pa.RecordBatch], books: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    width = books[0].shape[1]
    for batch in batches:
        code = _matrix(batch.column("code"), np.uint8, PARTS)
        parts = _parts(_matrix(batch.column("q"), "<i4", PARTS * width).astype(np.int64), width)
        error = sum(_own(parts[p], books[p], code[:, p].astype(np.int64)) for p in range(PARTS))
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array([c.tobytes().hex() for c in code], pa.string()), pa.array(error, pa.int64())], ["vec_id", "label", "code", "error"])


def compressed(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", rounds: int = ROUNDS) -> DataFrame:
    """Per kept vector: vec_id, code (two hexadecimal digits a part), error (squared distance from what the code stands for),
    label_error (sum of errors over the vector's label, nulls together), codebooks_sha256 (of all final entries).

    Components become floor(1024 * x), and are cut to 2**26 in size. Vectors that are null or empty, hold null or
    non-finite components, can't be cut into four equal parts, or are not as long as the first kept one are dropped.
    Codebooks start as the parts of the first 256 kept vectors by id; equal ids go by their components, null ids come
    last. Each of ``rounds`` rounds gives each part its nearest entry (ties: the lowest index), then moves entries to the
    floor of their parts' mean. Repeated ids are rows of their own; other columns are ignored; without a kept vector the
    result is empty.
    """
    spark = vectors.sparkSession
    own = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    schema = "vec_id long, label long, q binary"
    seeds = arrow_map(own, lambda it: _kept(it, None), schema).orderBy(F.col("vec_id").asc_nulls_last(), "q").limit(ENTRIES)
    first = seeds.select("vec_id", "q").collect()  # at most ENTRIES rows
    if not first:
        return spark.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    dim = len(first[0].q) // 4
    if any(len(r.q) != 4 * dim for r in first):
        first = arrow_map(own, lambda it: _kept(it, dim), schema).orderBy(F.col("vec_id").asc_nulls_last(), "q").limit(ENTRIES).collect()
    width = dim // PARTS
    books = [b.copy() for b in _parts(np.frombuffer(b"".join(bytes(r.q) for r in first), "<i4").reshape(-1, dim).astype(np.int64), width)]
    kept = arrow_map(own, lambda it: _kept(it, dim), schema)
    state = None
    before = books
    for _ in range(rounds + 1):
        if state is None:
            fresh = staged(arrow_map(kept, lambda it, books=books: _first(it, books), _STATE), "vectors")
        else:
            fresh = staged(arrow_map(state, lambda it, before=before, books=books: _again(it, before, books), _STATE), "vectors")
            discard(state)
        state = fresh
        if _ == rounds:
            break
        before, books = books, _moved(state, books)
    digest = hashlib.sha256(",".join(str(v) for b in books for entry in b.tolist() for v in entry).encode()).hexdigest()
    coded = arrow_map(state, lambda it: _coded(it, books), "vec_id long, label long, code string, error long").select(
        "vec_id", F.coalesce("label", F.lit(0)).alias("label"), F.col("label").isNull().alias("unlabelled"), "code", "error")
    coded = staged(coded, "codes")
    discard(state)
    per = staged(coded.groupBy("label", "unlabelled").agg(F.sum("error").alias("label_error"), F.count("*").alias("times")), "labels")
    out = joined_by_count(coded, per, ["label", "unlabelled"], coded.count())
    return out.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
