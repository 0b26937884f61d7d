"""Benchmark decontamination: one Aho-Corasick automaton over normalised test questions and answers, each text scanned once.

The automaton's letters are words. Of an item of 13 words or more it holds the blocks of seven words at every seventh
word: each window of 13 words holds exactly one of them whole, so a block that is found is compared with six words on
either side, and windows need no nodes of their own. A benchmark costs about 20 bytes a word this way, and blocks of
``block_bytes`` of its text, each with a scan of its own, bound what is broadcast.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import free_name
from .automaton import Automaton, Vocabulary
from .kernels import runs, span_hashes, text_slices
from .work import arrow_map

WIDTH = 13
#: Lower-cases A-Z and turns every byte outside words into a space.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 0x80 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
_NORMAL = np.frombuffer(_TABLE, np.uint8)
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_TABLE).split()


def _hashed(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For runs of texts: first row, end row, hashes of their words, and bounds such that row i has bounds[i]:bounds[i + 1]."""
    for first, end, data, offsets in text_slices(column):
        low = _NORMAL[data]
        starts, ends = runs(low != 32, offsets)
        yield first, end, span_hashes(low, starts, ends), np.searchsorted(starts, offsets)


class Machine:
    """What one block of items is searched with: words are told apart by 64-bit hashes."""

    def __init__(self, items: list[tuple[str | None, str | None]], width: int = WIDTH):
        found = list(_hashed(pa.array([t for _, t in items], pa.large_string())))
        hashes = np.concatenate([h for _, _, h, _ in found] or [np.zeros(0, np.uint64)])
        sizes = np.concatenate([np.diff(b) for _, _, _, b in found] or [np.zeros(0, np.int64)])
        self.ids, self.width, self.block = [i for i, _ in items], width, (width + 1) // 2
        self.vocabulary = Vocabulary(hashes)
        # Items one after the other, a -1 after each, with room to compare on both sides.
        item = np.repeat(np.arange(len(sizes)), sizes)
        at = np.arange(len(hashes)) + item + width
        self.numbers = np.full(len(hashes) + len(sizes) + 2 * width, -1, np.int64)
        self.numbers[at] = self.vocabulary(hashes)
        self.item = np.full(len(self.numbers), -1, np.int32)
        self.item[at] = item
        starts = np.cumsum(sizes + 1) - sizes - 1 + width
        short = np.flatnonzero((sizes > 0) & (sizes < width))
        long = np.flatnonzero(sizes >= width)
        blocks = sizes[long] // self.block
        inside = np.arange(int(blocks.sum())) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        begin = np.concatenate([starts[short], np.repeat(starts[long], blocks) + inside * self.block])
        self.whole = len(short)  # patterns before this are items, those after it are blocks
        self.automaton = Automaton(self.numbers, begin, np.concatenate([sizes[short], np.full(len(inside), self.block)]))

    def find(self, hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which words of some texts are hit, and (text, item) pairs as rows."""
        n, w, k = len(hashes), self.width, self.block
        text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        at = np.arange(n) + text + w
        numbers = np.zeros(n + len(bounds) - 1 + 2 * w, np.int64)  # a 0 after each text
        numbers[at] = self.vocabulary(hashes)
        cover = np.zeros(len(numbers) + 1, np.int64)
        owner = np.zeros(len(numbers), np.int64)
        owner[at] = text
        pairs = [np.zeros((0, 2), np.int64)]
        for place, pattern in self.automaton.scan(numbers):
            start = self.automaton.starts[pattern]
            left, right = np.zeros(len(place), np.int64), self.automaton.sizes[pattern]
            block = pattern >= self.whole
            if block.any():
                p, s = place[block], start[block]
                for sign, first in ((-1, -1), (1, k)):
                    run, more = np.zeros(len(p), np.int64), np.ones(len(p), bool)
                    for j in range(w - k):
                        more &= numbers[p + first + sign * j] == self.numbers[s + first + sign * j]
                        run += more
                    if sign < 0:
                        left[block] = run
                    else:
                        right[block] += run
            good = ~block | (left + right >= w)
            place, start, left, right = place[good], start[good], left[good], right[good]
            np.add.at(cover, place - left, 1)
            np.add.at(cover, place + right, -1)
            pairs.append(np.unique(np.column_stack([owner[place], self.item[start]]), axis=0))
        return np.cumsum(cover)[at] > 0, np.unique(np.concatenate(pairs), axis=0)


def blocks(benchmark: DataFrame, id_col: str, text_col: str, most_bytes: int) -> Iterator[list[tuple[str | None, str]]]:
    """The benchmark in blocks of at most ``most_bytes`` of text, one longer item aside; each is broadcast and scanned for on its own."""
    held, size = [], 0
    for item, text in benchmark.select(F.col(id_col).cast("string"), F.col(text_col)).where(f"`{text_col}` is not null").orderBy(F.col(id_col).cast("string"), text_col).toLocalIterator():
        if held and size + len(text) > most_bytes:
            yield held
            held, size = [], 0
        held.append((item, text))
        size += len(text)
    if held:
        yield held


def hits(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", width: int = WIDTH, block_bytes: int = 32_000_000) -> tuple[DataFrame, str, str]:
    """All columns of ``docs`` and two more, with the names of these: 32-bit numbers of the words hit, and ids that occur."""
    hit_col = free_name(docs.columns, "hit_words")
    item_ids = free_name([*docs.columns, hit_col], "hit_items")
    out = docs.withColumn(hit_col, F.lit(b"")).withColumn(item_ids, F.array().cast("array<string>"))
    names, schema = out.columns, out.schema
    for block in blocks(benchmark, item_col, item_text, block_bytes):
        sent = docs.sparkSession.sparkContext.broadcast(Machine(block, width))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            machine = sent.value
            for batch in batches:
                old, had = batch.column(batch.num_columns - 2).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()
                for first, _, hashes, bounds in _hashed(batch.column(names.index(text_col))):
                    hit, pairs = machine.find(hashes, bounds)
                    at = np.flatnonzero(hit)
                    row = np.searchsorted(bounds, at, "right") - 1
                    for i in np.unique(row):
                        own = (at[row == i] - bounds[i]).astype(np.int32)
                        old[first + i] = np.union1d(np.frombuffer(old[first + i], np.int32), own).astype(np.int32).tobytes()
                        found = {machine.ids[k] for k in pairs[pairs[:, 0] == i, 1]} - {None}
                        had[first + i] = sorted({*had[first + i], *found})
                yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(old, pa.binary()), pa.array(had, pa.list_(pa.string()))], names)

        out = arrow_map(out, run, schema)
    return out, hit_col, item_ids


def _totals(column: pa.Array) -> np.ndarray:
    return np.concatenate([np.diff(b) for _, _, _, b in _hashed(column)] or [np.zeros(0, np.int64)])


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", ratio: int = 20, **options) -> DataFrame:
    """The rows of ``docs`` that ``contamination`` does not call contaminated, with all their columns."""
    schema, n = docs.schema, docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = np.array([len(h) // 4 for h in batch.column(batch.num_columns - 2).to_pylist()], np.int64)
            fine = (hit == 0) | (ratio * hit < _totals(batch.column(n)))
            yield batch.select(list(range(batch.num_columns - 2))).filter(pa.array(fine, pa.bool_()))

    return arrow_map(hits(docs, benchmark, text_col=text_col, **options)[0], run, schema)


def spans(text: str, hit: np.ndarray) -> list[tuple[int, int]]:
    """Code-point offsets in the original text of the runs of words hit."""
    if not len(hit):
        return []
    at = [m.span() for m in _WORD.finditer(text)]
    cut = np.flatnonzero(np.diff(hit) > 1) + 1
    return [(at[r[0]][0], at[r[-1]][1]) for r in np.split(hit, cut)]


def _judge(batches: Iterator[pa.RecordBatch], ratio: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        total = _totals(batch.column("text"))
        hit, digest, where = [], [], []
        all_items = batch.column(3).to_pylist()
        for text, h, items in zip(batch.column("text"), batch.column(2).to_pylist(), all_items, strict=True):
            h = np.frombuffer(h, np.int32)
            hit.append(len(h))
            digest.append(hashlib.sha256(",".join(items).encode()).hexdigest())
            where.append(",".join(f"{a}:{b}" for a, b in spans(text.as_py(), h)) if len(h) else "")
        hit = np.array(hit, np.int64)
        dirty = (hit > 0) & (ratio * hit >= total)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(total, pa.int64()), pa.array(hit), pa.array(list(map(len, all_items)), pa.int64()), pa.array(digest, pa.string()), pa.array(dirty, pa.bool_()), pa.array(where, pa.string())], ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "hit_spans"])


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", ratio: int = 20, **options) -> DataFrame:
    """Per row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated (n_hit > 0 and ratio * n_hit >= n_words), hit_spans.

    A window is 13 consecutive words of an item, or a shorter item whole; words inside an occurrence are hit. hit_spans
    are code-point offsets in the original text, "start:end" joined by commas. Null texts and items have no words;
    items without words have no window; null and repeated ids stay rows; an empty benchmark hits nothing. Words of items
    without id are hit as well; n_items and items_sha256 leave such items out. Words are equal when their 64-bit hashes are.
    """
    schema = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, hit_spans string"
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return arrow_map(hits(own, benchmark, **options)[0], lambda it: _judge(it, ratio), schema)
