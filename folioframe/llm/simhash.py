"""Near-duplicate documents by SimHash, with candidates from anchor points of a covering code.

Two fingerprints with at most four differing bits differ in at most two bits of their upper or of their lower half, and
then some word lies within one bit of both halves. The anchors of a half are the codewords of the perfect Hamming code of
length 31 (covering radius 1) beside one free bit, so the anchor that covers the word between is within two bits of both:
each fingerprint is copied to every anchor within the covering radius plus half of the half's threshold, 17 of 2**27 in
each half, and is compared with what it meets there. No pair is missed.

Equal fingerprints are one row from the start. Fingerprints at one anchor are walked breadth first, so links leave it
as a forest. Where more than ``HOT`` meet, they are dealt once more, by the anchors of both quarters of the other half
(the Hamming code of length 15 beside a free bit): of at most four differing bits one quarter has at most two.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .kernels import IS_WORD, LOWER, runs, text_slices
from .work import HOT_LEAST, HOT_SHARE, arrow_map, by_groups, discard, small, staged

SEED, WIDTH, BITS = 42, 4, 4
#: Fingerprints of one anchor that are compared there; where more meet, they are dealt again.
HOT = 4_096
#: For each byte a word with its bits in eight lanes of a byte, so that 255 of them add up without a carry.
_LANES = (((np.arange(256, dtype=np.uint64)[:, None] >> np.arange(8, dtype=np.uint64)) & np.uint64(1)) << (np.arange(8, dtype=np.uint64) * np.uint64(8))).sum(1, dtype=np.uint64)


def _shingle_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of each row's shingles, and bounds such that row i has hashes bounds[i]:bounds[i + 1]."""
    low = LOWER[data]
    starts, ends = runs(IS_WORD[low], offsets)
    words = np.searchsorted(starts, offsets)
    # One blank after each word, whatever stood there: a shingle is a slice.
    keep = np.append(IS_WORD[low], False)
    keep[ends] = True
    spaced = np.append(low, np.uint8(32))
    spaced[ends] = 32
    # A word that ends where the next row begins has no byte of its own for the blank.
    glued = np.zeros(len(spaced), bool)
    glued[ends] = True
    glued &= np.append(IS_WORD[low], False)
    if glued.any():
        spaced[:-1] = np.where(glued[:-1], low, spaced[:-1])
    text = spaced[keep].tobytes()
    place = np.cumsum(keep) - keep
    first = place[starts]
    last = first + (ends - starts)
    count = np.diff(words)
    per = np.where(count >= WIDTH, count - WIDTH + 1, np.minimum(count, 1))
    bounds = np.concatenate([[0], np.cumsum(per)])
    head = np.repeat(words[:-1], per) + (np.arange(bounds[-1]) - np.repeat(bounds[:-1], per))
    tail = head + np.repeat(np.minimum(count, WIDTH), per) - 1
    digest = xxhash.xxh64_intdigest
    found = np.fromiter((digest(text[a:b], SEED) for a, b in zip(first[head].tolist(), last[tail].tolist(), strict=True)), np.uint64, bounds[-1])
    return found, bounds


def _majority(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Per row the bits that are set in over half of its hashes."""
    sizes = np.diff(bounds)
    out = np.zeros(len(sizes), np.uint64)
    full = np.flatnonzero(sizes)
    if not len(full):
        return out
    blocks = -(-sizes[full] // 255)
    first = np.cumsum(blocks) - blocks
    at = np.repeat(bounds[full], blocks) + 255 * (np.arange(blocks.sum()) - np.repeat(first, blocks))
    octets = np.ascontiguousarray(hashes.astype("<u8")).view(np.uint8).reshape(-1, 8)
    for j in range(8):
        lanes = np.add.reduceat(_LANES[octets[:, j]], at).astype("<u8").view(np.uint8).reshape(-1, 8)
        counts = np.add.reduceat(lanes.astype(np.int64), first, axis=0)
        set_ = 2 * counts > sizes[full][:, None]
        out[full] |= (set_.astype(np.uint64) << (np.arange(8, dtype=np.uint64) + np.uint64(8 * j))).sum(1, dtype=np.uint64)
    return out


def fingerprints(column: pa.Array) -> np.ndarray:
    """Per text its fingerprint: bit by bit the majority of its shingles' hashes; 0 without words."""
    parts = [_majority(*_shingle_hashes(data, offsets)) for _, _, data, offsets in text_slices(column)]
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


class Anchors:
    """The anchors of ``bits``-bit words: Hamming codewords of length bits - 1 (a power of two less one) and a free bit on top."""

    def __init__(self, bits: int) -> None:
        n = bits - 1
        self.free = np.uint64(1 << n)
        place = np.arange(256)
        octet = [np.zeros(256, np.int64) for _ in range(-(-n // 8))]
        for b in range(n):
            octet[b // 8] ^= np.where(place >> (b % 8) & 1, b + 1, 0)
        self.octets = octet
        # From a word of each syndrome: the changes that lead to anchors within two bits; the last one flips the free bit.
        bit = lambda i: 1 << (i - 1)
        changes = [[0]] + [[bit(s)] + [bit(i) | bit(i ^ s) for i in range(1, n + 1) if i < i ^ s and i ^ s] for s in range(1, n + 1)]
        changes = [[*c, c[0] | 1 << n] for c in changes]
        self.counts = np.array([len(c) for c in changes])
        self.changes = np.zeros((n + 1, int(self.counts.max())), np.uint64)
        for s, c in enumerate(changes):
            self.changes[s, : len(c)] = c

    def near(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, anchor) of all anchors within two bits of each word."""
        syndrome = np.zeros(len(words), np.int64)
        for k, table in enumerate(self.octets):
            syndrome ^= table[((words & ~self.free) >> np.uint64(8 * k) & np.uint64(255)).astype(np.int64)]
        count = self.counts[syndrome]
        row = np.repeat(np.arange(len(words)), count)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        return row, words[row] ^ self.changes[syndrome[row], nth]


_HALF, _QUARTER = Anchors(32), Anchors(16)


def half_anchors(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, anchor): the anchors of both halves; bit 32 of an anchor tells the half."""
    rows, keys = [], []
    for half in (0, 1):
        row, anchor = _HALF.near(prints >> np.uint64(32 * half) & np.uint64(0xFFFFFFFF))
        rows.append(row)
        keys.append(anchor | np.uint64(half << 32))
    return np.concatenate(rows), np.concatenate(keys)


def quarter_anchors(prints: np.ndarray, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, anchor): the anchors of both quarters of the half that ``anchors`` leave open; bit 16 tells the quarter."""
    other = prints >> np.where(anchors >> np.uint64(32) & np.uint64(1), 0, 32).astype(np.uint64) & np.uint64(0xFFFFFFFF)
    rows, keys = [], []
    for quarter in (0, 1):
        row, anchor = _QUARTER.near(other >> np.uint64(16 * quarter) & np.uint64(0xFFFF))
        rows.append(row)
        keys.append(anchor | np.uint64(quarter << 16))
    return np.concatenate(rows), np.concatenate(keys)


def near_forest(prints: np.ndarray, most: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Links that join all prints which steps of at most ``most`` differing bits join: breadth first, against unvisited ones only."""
    left, a, b = np.unique(prints), [], []
    while len(left):
        front, left = [left[0]], left[1:]
        while front and len(left):
            x = front.pop()
            near = np.bitwise_count(left ^ x) <= most
            if near.any():
                found = left[near]
                left = left[~near]
                a.append(np.full(len(found), x))
                b.append(found)
                front += list(found)
    none = np.zeros(0, np.uint64)
    return np.concatenate(a or [none]), np.concatenate(b or [none])


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fingerprints(batch.column(1)).view(np.int64))], ["doc_id", "fp"])


def _dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
        row, anchor = half_anchors(prints)
        yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), pa.array(prints[row].view(np.int64))], ["anchor", "fp"])


def _dealt_again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints, anchors = (batch.column(c).to_numpy(zero_copy_only=False).view(np.uint64) for c in ("fp", "anchor"))
        row, sub = quarter_anchors(prints, anchors)
        yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (anchors[row], sub, prints[row])], ["anchor", "sub", "fp"])


def _compared(group: pa.Table) -> pa.Table | None:
    a, b = near_forest(group["fp"].to_numpy().view(np.uint64))
    return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)}) if len(a) else None


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> DataFrame:
    """Per row: doc_id, fingerprint (16 hexadecimal digits), component_id (smallest doc_id reachable over links).

    Words are lower-cased (A-Z) runs without blanks; a fingerprint bit is 1 if over half of the XXH64 values (seed 42) of
    the text's 4-word shingles, repeats included, have it. Fewer words are one shingle; null and empty texts, and texts
    without words, have the fingerprint 0, which links like any other. Fingerprints link at four or fewer differing bits.

    Each row is judged by its own text, also where ids repeat. Rows without an id take part; they get the smallest id that
    they reach, or null if there is none. An empty table gives an empty result; other columns are ignored.
    """
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sketch = staged(arrow_map(own, _sketch, "doc_id long, fp long"), "prints")
    classes = staged(sketch.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")), "classes")
    rows = arrow_map(classes.select("fp"), _dealt, "anchor long, fp long")
    shared = staged(rows.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1"), "anchors")
    met = rows.join(small(shared), "anchor")
    again = arrow_map(met.where(F.col("n") > hot).select("anchor", "fp"), _dealt_again, "anchor long, sub long, fp long")
    all_met = met.where(F.col("n") <= hot).select("anchor", F.lit(-1).cast("long").alias("sub"), "fp").unionByName(again)
    linked = components(by_groups(all_met, ["anchor", "sub"], _compared, "a long, b long"))
    linked = staged(linked.join(classes, linked.node == classes.fp).select("fp", "label", "rep"), "linked")
    least = linked.groupBy("label").agg(F.min("rep").alias("component_id"))
    of_linked = linked.join(least, "label").select("fp", F.col("component_id").alias("reached"))
    known = staged(classes.join(of_linked, "fp", "left").select("fp", F.coalesce("reached", "rep").alias("component_id"), "copies").where("copies > 1 or component_id is distinct from rep"), "known")
    total = sketch.count()
    is_hot = F.col("copies") > max(HOT_LEAST, total // HOT_SHARE)
    often = F.broadcast(known.where(is_hot).drop("copies"))
    found = sketch.join(often, "fp").unionByName(
        sketch.join(often.select("fp"), "fp", "left_anti").join(known.where(~is_hot).select("fp", F.col("component_id").alias("known"), F.lit(True).alias("is_known")), "fp", "left").select("fp", "doc_id", F.when(F.col("is_known"), F.col("known")).otherwise(F.col("doc_id")).alias("component_id"))
    )
    discard(shared)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
