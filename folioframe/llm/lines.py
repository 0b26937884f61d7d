"""Substring dedup by lines, sentences or paragraphs: the first occurrence of a unit in the corpus stays, later ones go."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kernels import IS_WORD, LOWER, U64, mix, powers, runs, span_hashes, text_slices
from .work import arrow_map, joined_by_count, staged

_LEADS = (np.arange(256) & 0xC0) != 0x80
_STOP = np.zeros(256, bool)
_STOP[list(b".!?")] = True
LEVELS = ("sentence", "line", "paragraph")
UNITS = "array<struct<no:int,start:int,end:int,n_words:int,a:long,b:long>>"
_UNIT = pa.struct([("no", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("n_words", pa.int32()), ("a", pa.int64()), ("b", pa.int64())])
LAST = (1 << 63) - 1  # the rank of a null id


def _spans(data: np.ndarray, offsets: np.ndarray, level: str) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the non-empty lines, or of what lies between blank lines."""
    a, b = runs(data != 10, offsets)
    if level != "paragraph" or not len(a):
        return a, b
    worded = np.zeros(len(data) + 1, np.int64)
    np.cumsum(IS_WORD[data], out=worded[1:])
    full = worded[b] > worded[a]
    a, b = a[full], b[full]
    row = np.searchsorted(offsets, a, "right")
    joined = np.zeros(len(a), bool)
    joined[1:] = (a[1:] - b[:-1] == 1) & (row[1:] == row[:-1])
    return a[~joined], b[np.append(~joined[1:], True)] if len(a) else b


def _first_of_runs(x: np.ndarray) -> np.ndarray:
    new = np.ones(len(x), bool)
    new[1:] = x[1:] != x[:-1]
    return new


def _cut(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, a: np.ndarray, b: np.ndarray, sentence_words: int | None) -> tuple[np.ndarray, ...]:
    """Units of the spans a:b that have words: their first and end words, first and end bytes.

    With ``sentence_words`` a span is cut after each sentence of so many words; shorter ones go with the next, and those
    at a span's end with the unit before them.
    """
    n = len(starts)
    span = np.searchsorted(a, starts, "right") - 1
    stop = np.ones(n, bool)
    stop[:-1] = span[1:] != span[:-1]
    if sentence_words:
        stop |= _STOP[data[ends - 1]]
    last = np.flatnonzero(stop)
    first = np.append(0, last[:-1] + 1)[: len(last)]
    of = span[last]
    whole = (last - first + 1 >= sentence_words) if sentence_words else np.zeros(len(last), bool)
    before = np.cumsum(whole) - whole
    heads = np.flatnonzero(_first_of_runs(of))
    sizes = np.diff(np.append(heads, len(of)))
    of_span = np.add.reduceat(whole, heads, dtype=np.int64) if len(heads) else heads
    number = np.minimum(before - np.repeat(before[heads], sizes), np.repeat(np.maximum(of_span - 1, 0), sizes))
    new = _first_of_runs(of)
    new[1:] |= number[1:] != number[:-1]
    p, of = first[new], of[new]
    q = np.append(p[1:], n)[: len(p)]
    head, tail = _first_of_runs(of), np.ones(len(of), bool)
    tail[:-1] = head[1:]
    byte = np.where(head, a[of], starts[p])
    return p, q, byte, np.where(tail, b[of], np.append(byte[1:], 0)[: len(p)])


def units(column: pa.Array, level: str = "sentence", sentence_words: int = 8) -> pa.Array:
    """For each text its units with at least a word: number, code-point span, words, 128-bit digest.

    A unit is compared by its words, with A-Z lower-cased, so spacing does not count. The two halves of a digest come
    from two hashes of each word. Blanks after a sentence belong to it.
    """
    parts, counts = [], [0]
    for first, end, data, offsets in text_slices(column):
        low = LOWER[data]
        starts, ends = runs(IS_WORD[data], offsets)
        up, down = powers(len(starts) + 1)
        sums = np.zeros((2, len(starts) + 1), U64)
        for i, view in enumerate((low, 255 - low)):
            np.cumsum(span_hashes(view, starts, ends) * up[: len(starts)], out=sums[i, 1:])
        p, q, a, b = _cut(data, starts, ends, *_spans(data, offsets, level), sentence_words if level == "sentence" else None)
        row = np.searchsorted(offsets, a, "right") - 1
        row_first = np.searchsorted(row, np.arange(end - first + 1))
        points = np.zeros(len(data) + 1, np.int64)
        np.cumsum(_LEADS[data], out=points[1:])
        base = points[offsets[row]]
        digest = [mix((s[q] - s[p]) * down[p] + U64(i) + (q - p).astype(U64)).view(np.int64) for i, s in enumerate(sums)]
        no = np.arange(len(a)) - row_first[row]
        parts.append([no.astype(np.int32), (points[a] - base).astype(np.int32), (points[b] - base).astype(np.int32), (q - p).astype(np.int32), *digest])
        counts += (counts[-1] + row_first[1:]).tolist()
    fields = [pa.array(np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.int64), _UNIT.field(i).type) for i in range(6)]
    return pa.ListArray.from_arrays(pa.array(counts, pa.int32()), pa.StructArray.from_arrays(fields, fields=list(_UNIT)))


def repeated_units(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", level: str = "sentence", sentence_words: int = 8) -> DataFrame:
    """Per row: doc_id, n_units, n_removed, chars_removed, removed ("start:end" code-point spans of the text, in order).

    Units are paragraphs (``level``), lines, or lines cut after each sentence of ``sentence_words`` words or more, so
    that a passage which begins and ends inside a line is found by the sentences in it; a shorter sentence goes with the
    next one of its line, a line without a longer one is one unit. Every word is in a unit, and every unit counts,
    however short. Of equal units the one in the smallest doc_id, and there the first, stays; all others go, within a
    document too. Null texts have no units; null ids rank last. Rows that share an id rank by a hash of their texts, and
    rows with one id and one text are one document, judged alike. Other columns are ignored.

    Digests are counted with partial sums, so a line in a third of all texts is a row a task. Occurrences of repeated
    digests are joined back to the first: those of hot digests to a broadcast table of at most 100,000 rows, the rest
    by a shuffle in which no digest has more rows than the hot bound.
    """
    if level not in LEVELS:
        raise ValueError(f"level must be one of {LEVELS}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), units(batch.column(2), level, sentence_words)], ["rank", "row", "units"])

    own = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("rank"), F.xxhash64(text_col).alias("row"), F.col(text_col).alias("text"))
    found = staged(arrow_map(own, run, f"rank long, row long, units {UNITS}"), "units")
    each = found.select("rank", "row", F.explode("units").alias("u")).select("rank", "row", "u.no", "u.start", "u.end", "u.a", "u.b")
    place = F.struct("rank", "row", "no")
    again = staged(each.groupBy("a", "b").agg(F.min(place).alias("first"), F.count("*").alias("times")).where("times > 1"), "repeats")
    total = found.agg(F.sum(F.size("units"))).first()[0] or 0
    gone = joined_by_count(each, again, ["a", "b"], total).where(place != F.col("first"))
    spans = gone.groupBy("rank", "row").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("spans"))
    told = F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>"))
    return (
        found.select("rank", "row", F.size("units").cast("long").alias("n_units"))
        .join(spans, ["rank", "row"], "left")
        .select(
            F.nullif("rank", F.lit(LAST)).alias("doc_id"),
            "n_units",
            F.size(told).cast("long").alias("n_removed"),
            F.aggregate(told, F.lit(0).cast("long"), lambda s, x: s + (x["end"] - x["start"])).alias("chars_removed"),
            F.array_join(F.transform(told, lambda x: F.concat_ws(":", x["start"], x["end"])), ",").alias("removed"),
        )
    )


def without(text: str, removed: str) -> str:
    """A text less its removed spans; the break of a line that goes whole goes with it."""
    merged: list[list[int]] = []
    for span in filter(None, removed.split(",")):
        a, b = map(int, span.split(":"))
        if merged and merged[-1][1] == a:
            merged[-1][1] = b
        else:
            merged.append([a, b])
    out, past = [], 0
    for a, b in merged:
        out.append(text[past:a])
        past = b + (text[b : b + 1] == "\n" and (a == 0 or text[a - 1] == "\n"))
    return "".join([*out, text[past:]])
