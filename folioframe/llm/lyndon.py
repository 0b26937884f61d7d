"""Periodic runs of words in each document, by the runs theorem.

Every maximal repetition has a Lyndon root that is the longest Lyndon word at its place under the order of words or under
the opposite order (Bannai et al., 2017). The longest Lyndon word at i ends before the next place whose suffix is smaller,
so it comes from next-smaller values of the inverse suffix array. A root of length p at i is extended to the right by the
longest common prefix of the suffixes at i and i + p, and to the left by that of the reversed text: least entries of the
LCP array between two ranks, from a sparse table.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kernels import text_slices, window_hashes, words_of
from .work import arrow_map

#: A run has at least so many words, and at least so many times its period.
LEAST, TIMES = 24, 3
#: In a run of so many words, at least so many equal those one period later; so a text without two equal windows of this
#: width has no run: of length L >= max(24, 3q), L - q words match, which is least for q = 8.
REPEAT = 16


def suffix_order(ids: np.ndarray, with_lcp: bool = True) -> tuple[np.ndarray, np.ndarray | None]:
    """Ranks of all suffixes (the inverse suffix array), an end before any word; and the LCP array, entry r for ranks r - 1 and r.

    By prefix doubling: after each round, ranks order suffixes by twice as many words. Equal ranks of a round mean equal
    words, so common prefixes add up from the widest round to the first.
    """
    n = len(ids)
    rank = np.unique(ids, return_inverse=True)[1].astype(np.int64)
    levels = [rank]
    width = 1
    while n and rank.max() < n - 1:
        key = rank * (n + 1)
        key[: n - width] += rank[width:] + 1
        order = np.argsort(key, kind="stable")
        new = np.ones(n, np.int64)
        new[0] = 0
        new[1:] = key[order][1:] != key[order][:-1]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new)
        levels.append(rank)
        width *= 2
    if not with_lcp:
        return rank, None
    place = np.empty(n, np.int64)
    place[rank] = np.arange(n)
    a, b = place[:-1].copy(), place[1:].copy()
    for t in range(len(levels) - 1, -1, -1):
        inside = (a < n) & (b < n)
        equal = inside & (levels[t][np.minimum(a, n - 1)] == levels[t][np.minimum(b, n - 1)])
        a[equal] += 1 << t
        b[equal] += 1 << t
    lcp = np.zeros(n, np.int64)
    lcp[1:] = a - place[:-1]
    return rank, lcp


class CommonPrefix:
    """Longest common prefixes of any two suffixes: range minima of the LCP array from a sparse table."""

    def __init__(self, ids: np.ndarray) -> None:
        self.rank, lcp = suffix_order(ids)
        self.table = [lcp.astype(np.int32)]
        width = 1
        while 2 * width <= len(lcp):
            before = self.table[-1]
            self.table.append(np.minimum(before[:-width], before[width:]))
            width *= 2

    def of(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """For pairs of different places."""
        x, y = self.rank[i], self.rank[j]
        low, high = np.minimum(x, y) + 1, np.maximum(x, y) + 1
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        out = np.zeros(len(x), np.int64)
        for t in np.unique(level):
            at = level == t
            row = self.table[t]
            out[at] = np.minimum(row[low[at]], row[high[at] - (1 << int(t))])
        return out


def next_smaller(rank: np.ndarray) -> np.ndarray:
    """For each place the next one with a smaller rank, or the end."""
    n = len(rank)
    out = [n] * n
    values = rank.tolist()
    open_: list[int] = []
    for i, v in enumerate(values):
        while open_ and values[open_[-1]] > v:
            out[open_.pop()] = i
        open_.append(i)
    return np.array(out, np.int64)


def periodic_runs(ids: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of each maximal stretch with its smallest period, of ``least`` entries and ``times`` periods or more, by start and period."""
    n = len(ids)
    if n < least:
        return []
    ahead = CommonPrefix(ids)
    back = CommonPrefix(ids[::-1])
    found: set[tuple[int, int, int]] = set()
    for rank in (ahead.rank, suffix_order(-ids, with_lcp=False)[0]):
        end = next_smaller(rank)
        # A root that is followed by its own first word; a run of three periods has one.
        i = np.flatnonzero(end < n)
        i = i[ids[i] == ids[end[i]]]
        if not len(i):
            continue
        j = end[i]
        left = np.zeros(len(i), np.int64)
        inner = i > 0
        left[inner] = back.of(n - i[inner], n - j[inner])
        start, stop, period = i - left, j + ahead.of(i, j), j - i
        good = (stop - start >= least) & (stop - start >= times * period)
        found.update(zip(start[good].tolist(), (stop - start)[good].tolist(), period[good].tolist(), strict=True))
    return sorted(found, key=lambda r: (r[0], r[2]))


def planted(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """Where and with which period a document of n words repeats its own words, by the rule of the query; None where it doesn't."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def _sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


_NAMES = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", "runs"]
_SCHEMA = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string, runs string"
_TYPES = [pa.int64()] * 6 + [pa.string()] * 3


def _row(doc_id: int | None, found: list[tuple[int, int, int]], collapsed: bytes) -> tuple:
    told = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])) if found else None
    return doc_id, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, _sha(told.encode()), _sha(collapsed), told


def collapsed(words: list[bytes], found: list[tuple[int, int, int]]) -> bytes:
    """The words joined by blanks, without those that a run repeats after its first period."""
    if found:
        drop = np.zeros(len(words) + 1, np.int64)
        for s, n, q in found:
            drop[s + q] += 1
            drop[s + n] -= 1
        words = [w for w, d in zip(words, np.cumsum(drop[:-1]).tolist(), strict=True) if not d]
    return b" ".join(words)


def _measured(batches: Iterator[pa.RecordBatch], repeat_rule: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, out = batch.column(0).to_pylist(), []
        for first, end, data, offsets in text_slices(batch.column(1)):
            starts, ends, hashes, bounds = words_of(data, offsets, lower=False)
            raw = data.tobytes()
            for k in range(end - first):
                lo, hi = int(bounds[k]), int(bounds[k + 1])
                at = np.arange(lo, hi)
                if repeat_rule and (rule := planted(ids[first + k], hi - lo)):
                    a, p = rule
                    at[a:] = lo + a + np.arange(hi - lo - a) % p
                words = [raw[s:e] for s, e in zip(starts[at].tolist(), ends[at].tolist(), strict=True)]
                windows = window_hashes(hashes[at], REPEAT)
                found: list[tuple[int, int, int]] = []
                if hi - lo >= LEAST and len(np.unique(windows)) < len(windows):
                    number: dict[bytes, int] = {}
                    found = periodic_runs(np.array([number.setdefault(w, len(number)) for w in words], np.int64))
                out.append(_row(ids[first + k], found, collapsed(words, found)))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _TYPES, strict=True)] if out else [pa.array([], t) for t in _TYPES], _NAMES)


def runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repeat_rule: bool = False) -> DataFrame:
    """Per row: doc_id, n_runs, the run of greatest exponent (start, length, period, exponent_milli), runs_sha256, collapsed_sha256,
    and runs ("start,length,period" lines).

    Words are runs without blanks, in any case, numbered from 0. A run is a maximal stretch of 24 words or more and of
    three periods or more, with its smallest period. Of equal exponents the first start, then the smallest period, counts;
    without a run these columns are null. The collapsed text has no words that a run holds after its first period.
    ``repeat_rule`` first replaces words in a tenth of the documents, chosen by id, by repeats of earlier ones.

    Rows are judged one by one: null and empty texts have no words and no runs, null and repeated ids stay rows, and
    rows without an id fall under no repeat rule. An empty table gives an empty result; other columns are ignored.
    A text costs some 500 bytes of memory a word while its runs are sought.
    """
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return arrow_map(own, lambda it: _measured(it, repeat_rule), _SCHEMA)
