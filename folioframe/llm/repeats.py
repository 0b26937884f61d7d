"""Byte-exact removal of long repeats across documents.

A byte goes when a 50-byte string over it also starts in a document with a smaller id. Nothing here is sampled: every
50-byte window has one minimiser (the least-hashed 8-byte gram in it), and windows that are equal have equal minimisers
and equal 29-byte cores on one side of it. So cores that only one document has need no further look; cores whose
surrounding windows are equal everywhere are decided by that; and the rest, at the edges of copies, goes into
run-compressed indexes, through which the edges' texts are streamed to find the least document of each window.

All shuffles move packed blobs, a row per slice and shard. Shards and buckets hold a fixed number of bytes, so their
number grows with the input and a task's memory does not.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kernels import U64, mix, span_hashes, text_slices
from .runindex import RunIndex
from .work import arrow_map, by_groups, staged

LENGTH, GRAM, CORE = 50, 8, 29
SHARD_BYTES, BUCKET_BYTES, GROUP_BYTES = 12 << 20, 6 << 20, 8 << 20
#: Edges of a shard's copies are compared in so many parts, by core.
PARTS = 8
#: Bytes of a hash that tells whether the surroundings of equal cores are equal: at 100 TB, some 1e12 groups of equal cores
#: would be wrong with a chance of 2e-5 in all.
NEAR = 7
#: Bits of a gram's place; the rest of a key is its hash, so the order of grams is the same in slices of all sizes.
_PLACE = 32
_SPREAD = LENGTH - GRAM + 1  # grams of a window
_BACK = CORE - GRAM  # bytes of a left core before its gram
LAST = (1 << 63) - 1  # the rank of a null id


def halves(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one minimiser, on one side of it: first window, last window, 64-bit hash of their core."""
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < LENGTH:
        return none, none, none.astype(U64)
    g = data.astype(U64)
    for step, shift in ((1, 8), (2, 16), (4, 32)):
        h = g.copy()
        h[:-step] |= g[step:] << U64(shift)
        g = h
    mask = U64((1 << _PLACE) - 1)
    least = (mix(g) & ~mask) | np.arange(n, dtype=np.uint64)
    width = 1
    while 2 * width <= _SPREAD:
        h = least.copy()
        np.minimum(least[:-width], least[width:], out=h[:-width])
        least, width = h, 2 * width
    rest = _SPREAD - width
    if rest:
        least = np.minimum(least[:-rest], least[rest:])
    sizes = np.diff(offsets)
    at = np.flatnonzero(np.arange(n) + LENGTH <= np.repeat(offsets[1:], sizes))
    if not len(at):
        return none, none, none.astype(U64)
    gram = (least[at] & mask).astype(np.int64)
    right = at >= gram - _BACK
    cut = np.flatnonzero(np.concatenate([[True], (gram[1:] != gram[:-1]) | (right[1:] != right[:-1]) | (at[1:] != at[:-1] + 1)]))
    last = np.append(cut[1:], len(at)) - 1
    core = np.where(right[cut], gram[cut], gram[cut] - _BACK)
    return at[cut], at[last], mix(span_hashes(data, core, core + CORE) + right[cut].astype(U64))


def _place(keys: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    return (keys >> U64(40)).astype(np.int64) % shards, (keys & U64(0xFFFFFFFF)).astype(np.uint32)


def _flag(ranks: np.ndarray, shard: np.ndarray | int, small: np.ndarray) -> np.ndarray:
    return mix(mix(ranks.astype(np.int64).view(U64) ^ U64(0xA5A5)) ^ (np.asarray(shard).astype(U64) << U64(32)) ^ small.astype(U64))


def _groups(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of rows of about ``most`` bytes across batches: ranks, bytes, offsets."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    size = 0

    def flush():
        ranks, data = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
        offsets = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(h[2]) for h in held]))])
        return ranks, data, offsets

    for batch in batches:
        ranks = batch.column("rank").to_numpy(zero_copy_only=False)
        for first, end, data, offsets in text_slices(batch.column("text")):
            held.append((ranks[first:end], data, offsets))
            size += len(data)
            if size >= most or sum(len(h[0]) for h in held) > 50_000:
                yield flush()
                held, size = [], 0
    if held:
        yield flush()


def _slices(data: np.ndarray, offsets: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    text = pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data)))
    return text_slices(text, most)


def _rows(part: np.ndarray, columns: list[np.ndarray], names: list[str], first: str) -> pa.RecordBatch | None:
    """One row per value of ``part``, with each column's entries of it as bytes."""
    if not len(part):
        return None
    # Two bytes are sorted by counting; rows of a text stay together, which compresses better.
    order = np.argsort(part.astype(np.uint16) if part.max() < 1 << 16 else part, kind="stable")
    values, starts = np.unique(part[order], return_index=True)
    ends = np.append(starts[1:], len(part))
    blobs = []
    for c in columns:
        s = c[order]
        blobs.append(pa.array([s[a:b].tobytes() for a, b in zip(starts, ends, strict=True)], pa.binary()))
    return pa.RecordBatch.from_arrays([pa.array(values.astype(np.int32)), *blobs], [first, *names])


def _short(ranks: np.ndarray) -> bytes:
    """Ranks in four bytes each where all of them fit."""
    fits = not len(ranks) or 0 <= ranks.min() and ranks.max() < 1 << 32
    return bytes([int(fits)]) + ranks.astype(np.uint32 if fits else np.int64).tobytes()


def _long(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint32 if data[0] else np.int64, offset=1).astype(np.int64)


def _own_ranks(owner: np.ndarray, ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Owners, in order, numbered among themselves, and their ranks."""
    new = np.append(True, owner[1:] != owner[:-1])
    return (np.cumsum(new) - 1).astype(np.uint16).tobytes(), _short(ranks[owner[new]])


def _cores(batches: Iterator[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    for ranks, data, offsets in _groups(batches, GROUP_BYTES):
        shard, small, near, owner = [], [], [], []
        for first, _, d, o in _slices(data, offsets):
            s, e, keys = halves(d, o)
            a, b = _place(keys, shards)
            shard.append(a)
            small.append(b)
            near.append(span_hashes(d, s, e + LENGTH).view(np.uint8).reshape(-1, 8)[:, :NEAR])
            owner.append((np.searchsorted(o, s, "right") - 1 + first).astype(np.uint16))
        if shard:
            out = _rows(np.concatenate(shard), [np.concatenate(small), np.concatenate(near), np.concatenate(owner)], ["cores", "near", "owner"], "shard")
            if out is not None:
                # Each row takes the ranks of its own cores along, so that what is shuffled does not grow with the shards.
                own = [_own_ranks(np.frombuffer(x.as_py(), np.uint16), ranks) for x in out.column("owner")]
                yield pa.RecordBatch.from_arrays([*(out.column(c) for c in ("shard", "cores", "near")), *(pa.array(c, pa.binary()) for c in zip(*own, strict=True))], ["shard", "cores", "near", "owner", "ranks"])


def _shared(group: pa.Table, buckets: int) -> pa.Table | None:
    """Which cores of a shard two documents have: flags of the halves to remove and of those to compare, by the owner's bucket."""
    shard = group["shard"][0].as_py()
    core = np.concatenate([np.frombuffer(x, np.uint32) for x in group["cores"].to_pylist()])
    packed = np.concatenate([np.frombuffer(x, np.uint8) for x in group["near"].to_pylist()]).reshape(-1, NEAR)
    near = np.zeros((len(packed), 8), np.uint8)
    near[:, :NEAR] = packed
    near = near.view(U64)[:, 0]
    rank = np.concatenate([_long(r)[np.frombuffer(x, np.uint16)] for x, r in zip(group["owner"].to_pylist(), group["ranks"].to_pylist(), strict=True)])
    order = np.argsort(core)
    core, near, rank = core[order], near[order], rank[order]
    starts = np.flatnonzero(np.append(True, core[1:] != core[:-1]))
    sizes = np.diff(np.append(starts, len(core)))
    low, high = np.minimum.reduceat(rank, starts), np.maximum.reduceat(rank, starts)
    same = np.minimum.reduceat(near, starts) == np.maximum.reduceat(near, starts)
    many = np.repeat(low < high, sizes)
    alike, least = np.repeat(same, sizes), np.repeat(low, sizes)
    parts = []
    for kind, chosen in ((0, many & alike & (rank > least)), (1, many & ~alike)):
        r, flags = rank[chosen], _flag(rank[chosen], shard, core[chosen])
        out = _rows(_bucket(r, buckets), [flags], ["data"], "bucket")
        if out is not None:
            parts.append(out.append_column("kind", pa.array(np.full(out.num_rows, kind, np.int32))))
    return pa.Table.from_batches(parts) if parts else None


def _bucket(ranks: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(ranks.astype(np.int64).view(U64)) % U64(buckets)).astype(np.int64)


TEXTS = "bucket int, kind int, data binary, ranks binary, sizes binary"


def _texts(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """The texts, packed by bucket and compressed."""
    press = zstandard.ZstdCompressor(level=1)
    for ranks, data, offsets in _groups(batches, GROUP_BYTES):
        where = _bucket(ranks, buckets)
        order = np.argsort(where, kind="stable")
        values, starts = np.unique(where[order], return_index=True)
        sizes, raw = np.diff(offsets), data.tobytes()
        rows = []
        for v, rows_of in zip(values, np.split(order, starts[1:]), strict=True):
            blob = b"".join(raw[offsets[i] : offsets[i + 1]] for i in rows_of)
            rows.append((int(v), 2, press.compress(blob), ranks[rows_of].astype(np.int64).tobytes(), sizes[rows_of].astype(np.int64).tobytes()))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()), strict=True)], ["bucket", "kind", "data", "ranks", "sizes"])


def _unpack(group: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """From packed rows: ranks, row ids (equal for equal rows), bytes, offsets."""
    for data, ranks, sizes in zip(group["data"], group["ranks"], group["sizes"], strict=True):
        ranks, sizes = np.frombuffer(ranks.as_py(), np.int64), np.frombuffer(sizes.as_py(), np.int64)
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        raw = zstandard.ZstdDecompressor().decompress(data.as_py(), max_output_size=max(1, int(offsets[-1])))
        bytes_ = np.frombuffer(raw, np.uint8)
        yield ranks, mix(span_hashes(bytes_, offsets[:-1], offsets[1:]) ^ mix(ranks.view(U64))), bytes_, offsets


def _regions(group: pa.Table, shards: int) -> pa.Table | None:
    """A bucket's halves that are to be removed, as window runs, and those to be compared, with their bytes."""
    kinds = group["kind"].to_numpy()
    flags = [np.unique(np.concatenate([np.frombuffer(x.as_py(), U64) for x in group["data"].filter(pa.array(kinds == k))] or [np.zeros(0, U64)])) for k in (0, 1)]
    bucket = group["bucket"][0].as_py()
    gone_runs: list[list[np.ndarray]] = []
    asked: list[list[np.ndarray]] = []

    def member(x: np.ndarray, among: np.ndarray) -> np.ndarray:
        if not len(among):
            return np.zeros(len(x), bool)
        i = np.minimum(np.searchsorted(among, x), len(among) - 1)
        return among[i] == x

    for ranks, uids, data, offsets in _unpack(group.filter(pa.array(kinds == 2))):
        for first, _, d, o in _slices(data, offsets):
            s, e, keys = halves(d, o)
            shard, small = _place(keys, shards)
            owner = np.searchsorted(o, s, "right") - 1
            rank = ranks[owner + first]
            flag = _flag(rank, shard, small)
            gone, ask = member(flag, flags[0]), member(flag, flags[1])
            base = s - o[owner]
            if gone.any():
                gone_runs.append([uids[owner + first][gone], base[gone], (base + e - s)[gone]])
            if ask.any():
                i = np.flatnonzero(ask)
                size = e[i] + LENGTH - s[i]
                asked.append([shard[i] * PARTS + (small[i] % PARTS).astype(np.int64), uids[owner[i] + first], base[i], size, rank[i], d[_spread(s[i], size)]])
    rows: list[tuple] = []
    if gone_runs:
        rows.append((bucket, 1, *(np.concatenate(c).tobytes() for c in zip(*gone_runs, strict=True)), b"", b""))
    if asked:
        part, uid, base, size, rank, data = (np.concatenate(c) for c in zip(*asked, strict=True))
        order = np.argsort(part, kind="stable")
        starts = np.cumsum(size) - size
        values, cuts = np.unique(part[order], return_index=True)
        for v, i in zip(values.tolist(), np.split(order, cuts[1:]), strict=True):
            rows.append((v, 0, uid[i].tobytes(), base[i].tobytes(), size[i].tobytes(), rank[i].tobytes(), data[_spread(starts[i], size[i])].tobytes()))
    if not rows:
        return None
    kinds_of = [pa.int32(), pa.int32(), *[pa.binary()] * 5]
    return pa.table([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds_of, strict=True)], ["part", "done", "uids", "starts", "ends", "ranks", "bytes"])


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places start, start + 1, … of each run, one run after the other."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


def _compared(group: pa.Table, buckets: int) -> pa.Table | None:
    """Windows of a part's edges that a document with a smaller rank also has, as runs by the owner's bucket.

    Equal regions are one text of the index, with the least rank of those that have it.
    """
    get = lambda name, kind: np.concatenate([np.frombuffer(x.as_py(), kind) for x in group[name]])
    uids, base, size, rank, data = get("uids", U64), get("starts", np.int64), get("ends", np.int64), get("ranks", np.int64), get("bytes", np.uint8)
    first = np.cumsum(size) - size
    chosen, text = _distinct(data, first, size)
    lowest = np.full(len(chosen), LAST)
    np.minimum.at(lowest, text, rank)
    count = size[chosen]
    texts = data[_spread(first[chosen], count)]
    of, offset, _, least = RunIndex(texts, count, LENGTH, lowest).stream(texts, count)
    order = np.lexsort((offset, of))
    windows = count - LENGTH + 1
    place = np.cumsum(windows) - windows
    least = least[order]
    per = windows[text]
    region = np.repeat(np.arange(len(size)), per)
    inside = np.arange(len(region)) - np.repeat(np.cumsum(per) - per, per)
    i = np.flatnonzero(rank[region] > least[place[text[region]] + inside])
    if not len(i):
        return None
    r = region[i]
    at = base[r] + inside[i]
    new = np.flatnonzero(np.append(True, (r[1:] != r[:-1]) | (at[1:] != at[:-1] + 1)))
    end = np.append(new[1:], len(i)) - 1
    out = _rows(_bucket(rank[r[new]], buckets), [uids[r[new]], at[new], at[end]], ["uids", "starts", "ends"], "bucket")
    return pa.Table.from_batches([out])


def _distinct(data: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One region of each set of equal ones, and for each region which that is: by hashes, if equal hashes prove to be equal bytes, else by bytes."""
    _, chosen, text = np.unique(mix(span_hashes(data, first, first + size) ^ size.astype(U64)), return_index=True, return_inverse=True)
    like = chosen[text]
    if (size[like] == size).all() and (data == data[_spread(first[like], size)]).all():
        return chosen, text
    _, chosen, text = np.unique(_exact_keys(data, first, size), return_index=True, return_inverse=True)
    return chosen, text


def _exact_keys(data: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Regions as fixed-width byte strings with their lengths, so that equality is of bytes, not of hashes."""
    width = int(size.max(initial=0))
    table = np.zeros((len(size), width + 2), np.uint8)
    owner = np.repeat(np.arange(len(size)), size)
    table[owner, np.arange(len(data)) - np.repeat(first, size)] = data
    table[:, width:] = size.astype(">u2")[:, None].view(np.uint8).reshape(-1, 2)
    return table.view(f"V{width + 2}")[:, 0]


def _finish(group: pa.Table) -> pa.Table | None:
    """Per row of a bucket what is removed and the digest of what stays."""
    kinds = group["kind"].to_numpy()
    runs = group.filter(pa.array(kinds == 0))
    empty = np.zeros(0, np.int64)
    uid = np.concatenate([np.frombuffer(x.as_py(), U64) for x in runs["data"]] or [empty.astype(U64)])
    start = np.concatenate([np.frombuffer(x.as_py(), np.int64) for x in runs["ranks"]] or [empty])
    end = np.concatenate([np.frombuffer(x.as_py(), np.int64) for x in runs["sizes"]] or [empty]) + LENGTH
    order = np.lexsort((start, uid))
    uid, start, end = uid[order], start[order], end[order]
    out: list[tuple] = []
    for ranks, uids, data, offsets in _unpack(group.filter(pa.array(kinds == 2))):
        raw = data.tobytes()
        a, b = np.searchsorted(uid, uids), np.searchsorted(uid, uids, "right")
        for i in range(len(ranks)):
            text = raw[offsets[i] : offsets[i + 1]]
            kept, past, spans, removed = [], 0, [], 0
            for s, e in zip(start[a[i] : b[i]].tolist(), end[a[i] : b[i]].tolist(), strict=True):
                if spans and s <= spans[-1][1]:
                    spans[-1][1] = max(e, spans[-1][1])
                else:
                    spans.append([s, e])
            for s, e in spans:
                kept.append(text[past:s])
                past = e
                removed += e - s
            kept.append(text[past:])
            out.append((None if ranks[i] == LAST else int(ranks[i]), len(text), removed, len(spans), hashlib.sha256(b"".join(kept)).hexdigest(), ",".join(f"{s}:{e}" for s, e in spans)))
    if not out:
        return None
    kinds = [pa.int64()] * 4 + [pa.string()] * 2
    return pa.table([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"])


def long_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256, removed ("start:end" byte spans).

    Texts are UTF-8 bytes; null is empty. A byte goes when a 50-byte string over it also starts in a document with a
    smaller id, as the input has it. Rows that share an id are no repeats of each other; null ids rank last, so such
    rows lose what any numbered document has and nothing to each other. An empty table gives an empty result.
    """
    own = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("rank"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    total = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards, buckets = max(1, -(-total // SHARD_BYTES)), max(1, -(-total // BUCKET_BYTES))
    cores = arrow_map(own, lambda it: _cores(it, shards), "shard int, cores binary, near binary, owner binary, ranks binary")
    flags = by_groups(cores, ["shard"], lambda g: _shared(g, buckets), "bucket int, data binary, kind int")
    texts = arrow_map(own, lambda it: _texts(it, buckets), TEXTS)
    packed = flags.selectExpr("bucket", "kind", "data", "cast(null as binary) as ranks", "cast(null as binary) as sizes").unionByName(texts)
    schema = "part int, done int, uids binary, starts binary, ends binary, ranks binary, bytes binary"
    regions = staged(by_groups(packed, ["bucket"], lambda g: _regions(g, shards), schema), "regions")
    more = by_groups(regions.where("done = 0"), ["part"], lambda g: _compared(g, buckets), "bucket int, uids binary, starts binary, ends binary")
    runs = regions.where("done = 1").select(F.col("part").alias("bucket"), "uids", "starts", "ends").unionByName(more)
    all_runs = runs.selectExpr("bucket", "0 as kind", "uids as data", "starts as ranks", "ends as sizes").unionByName(texts)
    return by_groups(all_runs, ["bucket"], _finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed string")
