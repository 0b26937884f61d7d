"""Token counts that follow edits: a segment tree over each document's pre-tokens, re-encoded only where an edit reaches.

The byte-pair vocabulary is a parameter and is never copied; a pre-token's count does not depend on its neighbours, so
after an edit only pre-tokens whose matching looked at changed characters are matched and encoded again.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import free_name
from .work import arrow_map

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The published pre-token pattern of the vocabulary (a fixed value).
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: A pre-token that ends at b was decided by characters before b + LOOK.
LOOK = 2
LEAF = 64
MEASURES = ["doc_id", "n_before", "n_tokens", "n_chars", "n_pieces", "n_encoded"]
EDITS = "array<struct<start:int,end:int,text:string>>"
_split = regex.compile(PATTERN)
_counters: dict[int, "Counter"] = {}


class Counter:
    """Counts the tokens of pre-tokens, with a bounded memory of those seen."""

    def __init__(self, ranks: bytes, most: int = 400_000):
        self.encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}, special_tokens={})
        self.seen: dict[str, int] = {}
        self.most = most

    def __call__(self, piece: str) -> int:
        n = self.seen.get(piece)
        if n is None:
            if len(self.seen) >= self.most:
                self.seen.clear()
            n = len(self.encoding.encode_ordinary(piece))
            if len(piece) <= 64:
                self.seen[piece] = n
        return n

    def total(self, text: str) -> int:
        """The tokens of a whole text, without a memory of its pre-tokens."""
        return len(self.encoding.encode_ordinary(text))


def counter(ranks: bytes) -> Counter:
    key = hash(ranks)
    if key not in _counters:
        _counters[key] = Counter(ranks)
    return _counters[key]


def leaves(text: str, count: Counter) -> tuple[list[int], list[int]]:
    """Characters and tokens of each pre-token."""
    pieces = _split.findall(text)
    seen = count.seen
    return list(map(len, pieces)), [n if (n := seen.get(p)) is not None else count(p) for p in pieces]


class Tree:
    """Sums of characters and tokens over blocks of up to 2 * LEAF pre-tokens; blocks are the leaves of a binary tree."""

    def __init__(self, text: str, chars: list[int], tokens: list[int]):
        self.text = text
        self.plant([(chars[i : i + LEAF], tokens[i : i + LEAF]) for i in range(0, len(chars), LEAF)] or [([], [])])
        self.encoded = 0

    def plant(self, blocks: list[tuple[list[int], list[int]]]) -> None:
        self.blocks = blocks
        self.size = 1 << (len(blocks) - 1).bit_length()
        self.sums = [(0, 0)] * (2 * self.size)
        for i, (c, t) in enumerate(blocks):
            self.sums[self.size + i] = sum(c), sum(t)
        for i in range(self.size - 1, 0, -1):
            (a, b), (c, d) = self.sums[2 * i], self.sums[2 * i + 1]
            self.sums[i] = a + c, b + d

    @property
    def total(self) -> int:
        return self.sums[1][1]

    def touch(self, block: int) -> None:
        i = self.size + block
        self.sums[i] = sum(self.blocks[block][0]), sum(self.blocks[block][1])
        while i := i >> 1:
            (a, b), (c, d) = self.sums[2 * i], self.sums[2 * i + 1]
            self.sums[i] = a + c, b + d

    def block_at(self, at: int) -> tuple[int, int]:
        """The block with character ``at``, or the last one with text, and where it starts."""
        i, start = 1, 0
        at = min(at, self.sums[1][0] - 1)
        while i < self.size:
            left = self.sums[2 * i][0]
            if at - start < left or not self.sums[2 * i + 1][0]:
                i = 2 * i
            else:
                start += left
                i = 2 * i + 1
        return min(i - self.size, len(self.blocks) - 1), start

    def edit(self, start: int, end: int, new: str, count: Counter) -> None:
        """Replace text[start:end]; offsets beyond the text mean its end."""
        start = max(0, min(start, len(self.text)))
        end = max(start, min(end, len(self.text)))
        block, at = self.block_at(max(0, start - LOOK))
        chars = self.blocks[block][0]
        first = 0
        while first < len(chars) and at + chars[first] <= start - LOOK:
            at += chars[first]
            first += 1
        self.text = text = self.text[:start] + new + self.text[end:]
        shift, fixed = len(new) - (end - start), start + len(new)
        last, index, old = block, first, at  # the next old pre-token and where it starts
        made_chars, made_tokens, here = [], [], at
        for m in _split.finditer(text, at):
            while True:  # old boundaries before this one
                while index == len(self.blocks[last][0]) and last + 1 < len(self.blocks):
                    last, index = last + 1, 0
                if index == len(self.blocks[last][0]) or old + shift >= here and old >= end:
                    break
                old += self.blocks[last][0][index]
                index += 1
            if here >= fixed and old >= end and old + shift == here and index < len(self.blocks[last][0]):
                break
            made_chars.append(m.end() - m.start())
            made_tokens.append(count(m[0]))
            here = m.end()
        else:
            last, index = len(self.blocks) - 1, len(self.blocks[-1][0])
        self.encoded += len(made_chars)
        head, tail = self.blocks[block], self.blocks[last]
        c, t = head[0][:first] + made_chars + tail[0][index:], head[1][:first] + made_tokens + tail[1][index:]
        if len(c) <= 2 * LEAF:
            self.blocks[block] = c, t
            for i in range(block + 1, last + 1):
                self.blocks[i] = [], []
            for i in range(block, last + 1):
                self.touch(i)
        else:
            cut = [(c[i : i + LEAF], t[i : i + LEAF]) for i in range(0, len(c), LEAF)]
            self.plant([b for b in self.blocks[:block] if b[0]] + cut + [b for b in self.blocks[last + 1 :] if b[0]])


def packed(chars: list[int], tokens: list[int]) -> bytes:
    both = np.array([chars, tokens], np.uint32)
    small = bool(not both.size or both.max() < 256)
    return bytes([int(small)]) + both.astype(np.uint8 if small else np.uint32).tobytes()


def unpacked(data: bytes) -> tuple[list[int], list[int]]:
    return tuple(np.frombuffer(data, np.uint8 if data[0] else np.uint32, offset=1).reshape(2, -1).tolist())


def ranks(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None, vocabulary: str = VOCABULARY) -> DataFrame:
    """Per row: doc_id, text, n_tokens, tree (the leaves: characters and tokens of each pre-token), and the columns of ``keep``,
    with underscores before a name that one of these four has.

    The vocabulary (under 2 MB, whatever the input) is read on the driver and broadcast. Null texts count as empty.
    """
    sent = docs.sparkSession.sparkContext.broadcast(ranks(vocabulary))
    names = ["doc_id", "text", "n_tokens", "tree"]
    for k in keep or []:
        names.append(free_name(names, k))
    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *[F.col(k).alias(n) for k, n in zip(keep or [], names[4:], strict=True)])
    fields = [f.simpleString().replace(":", " ", 1) for f in chosen.schema.fields[2:]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(sent.value)
        for batch in batches:
            totals, trees = [], []
            for x in batch.column("text"):
                chars, tokens = leaves(x.as_py() or "", count)
                totals.append(sum(tokens))
                trees.append(packed(chars, tokens))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(totals, pa.int64()), pa.array(trees, pa.binary()), *batch.columns[2:]], names)

    return arrow_map(chosen, run, ", ".join(["doc_id long", "text string", "n_tokens long", "tree binary", *fields]))


def _edited(tree: Tree, edits: list[dict] | None, count: Counter) -> Tree:
    for e in edits or []:
        tree.edit(e["start"] or 0, e["end"] or 0, e["text"] or "", count)
    return tree


def _measures(t: Tree) -> tuple[int, int, int, int]:
    return t.total, len(t.text), sum(len(c) for c, _ in t.blocks), t.encoded


def counted(docs: DataFrame, edits_col: str = "edits", id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """What ``recount`` gives for the index of ``docs``, in one pass: trees are built, edited and left behind in the worker."""
    sent = docs.sparkSession.sparkContext.broadcast(ranks(vocabulary))
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.col(edits_col).cast(EDITS).alias("edits"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(sent.value)
        for batch in batches:
            rows = []
            for text, edits in zip(batch.column("text"), batch.column("edits"), strict=True):
                tree = Tree(text.as_py() or "", *leaves(text.as_py() or "", count))
                rows.append((tree.total, *_measures(_edited(tree, edits.as_py(), count))))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns)], MEASURES)

    return arrow_map(own, run, ", ".join(f"{n} long" for n in MEASURES))


def recount(indexed: DataFrame, edits_col: str = "edits", vocabulary: str = VOCABULARY, keep_tree: bool = False) -> DataFrame:
    """Per row of an index with a column of edits: doc_id, n_before, n_tokens, n_chars, n_pieces, n_encoded, and on demand text and tree.

    Edits apply in order, each to the text that the ones before it left: text[start:end] becomes the edit's text, where
    null is empty and offsets are code points. A null or empty list changes nothing. n_encoded counts the pre-tokens
    encoded again; everything else keeps its sums.
    """
    sent = indexed.sparkSession.sparkContext.broadcast(ranks(vocabulary))
    own = indexed.select("doc_id", "text", "n_tokens", "tree", F.col(edits_col).cast(EDITS).alias("edits"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(sent.value)
        for batch in batches:
            rows: list[tuple] = []
            for text, tree, edits in zip(batch.column("text"), batch.column("tree"), batch.column("edits"), strict=True):
                t = _edited(Tree(text.as_py() or "", *unpacked(tree.as_py())), edits.as_py(), count)
                rows.append(_measures(t) + ((t.text, packed(sum((c for c, _ in t.blocks), []), sum((n for _, n in t.blocks), []))) if keep_tree else ()))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * (6 if keep_tree else 4)
            kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()] * keep_tree
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_tokens"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names)

    names = MEASURES + ["text", "tree"] * keep_tree
    return arrow_map(own, run, ", ".join(f"{n} long" for n in MEASURES) + ", text string, tree binary" * keep_tree)


def sample_edits(text: Column, key: Column) -> Column:
    """A fixed script of three edits for a document: an insertion, a deletion and a replacement at places its id decides."""
    size = F.coalesce(F.length(text), F.lit(0))
    at = lambda k: F.pmod(F.xxhash64(F.coalesce(key, F.lit(-1)), F.lit(k)), size + 1).cast("int")
    one = lambda k, gone, new: F.struct(at(k).alias("start"), (at(k) + gone).alias("end"), F.lit(new).alias("text"))
    return F.array(one(1, 0, " it's new, 42"), one(2, 9, ""), one(3, 5, "re\n  written "))
