"""Vectorised text kernels shared by the training-data operators.

Everything here works on Arrow string buffers with numpy, so a batch of texts
costs a handful of array passes rather than a Python step per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_BASE = U64(0x9E3779B97F4A7C15 | 1)
_BASE_INV = U64(pow(int(_BASE), -1, 1 << 64))
_STEP = U64(0xD6E8FEB86659FD93)
#: One random odd weight per byte value, from a fixed seed.
_WEIGHT = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) | U64(1)

#: Bytes that end a word for the ``[^\x20\x09-\x0D]+`` word rule.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
IS_WORD = ~IS_SPACE
#: ASCII lower-casing, byte by byte.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, U64), np.ones(1, U64))


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i up to n."""
    global _powers
    if len(_powers[0]) <= n:
        size = max(n + 1, 1 << 21)
        up, down = np.full(size, _BASE), np.full(size, _BASE_INV)
        up[0] = down[0] = 1
        _powers = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _powers


def text_slices(column: pa.Array, most: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a string column into runs of rows of about ``most`` bytes: (first row, end row, bytes, offsets).

    Nulls have no bytes. One text is never cut, so a run is longer only when a single text is.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        end = min(max(end, first + 1), n)
        a, b = offsets[first], offsets[end]
        yield first, end, data[a:b], offsets[first : end + 1] - a
        first = end


def runs(member: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True that don't cross a document's border."""
    n = len(member)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    border = np.zeros(n + 1, bool)
    border[offsets] = True
    starts = member.copy()
    starts[1:] &= ~member[:-1] | border[1:n]
    ends = member.copy()
    ends[:-1] &= ~member[1:] | border[1:n]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each data[start:end], equal for equal bytes."""
    up, down = powers(len(data) + 1)
    prefix = np.zeros(len(data) + 1, U64)
    np.cumsum(_WEIGHT[data] * up[: len(data)], out=prefix[1:])
    return mix((prefix[ends] - prefix[starts]) * down[starts])


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """A hash of each ``width`` consecutive entries."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, U64)
    out = words[:n].copy()
    for j in range(1, width):
        out *= _STEP
        out += words[j : j + n]
    return mix(out)


def words_of(data: np.ndarray, offsets: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word starts, ends, hashes, and bounds such that row i has words bounds[i]:bounds[i + 1]."""
    if lower:
        data = LOWER[data]
    starts, ends = runs(IS_WORD[data], offsets)
    return starts, ends, span_hashes(data, starts, ends), np.searchsorted(starts, offsets)


def shingle_sets(column: pa.Array, width: int = 5) -> Iterator[np.ndarray]:
    """For each row the sorted distinct hashes of its word shingles.

    A text with fewer words than ``width`` has its whole sequence as one shingle; one without words has none.
    """
    for first, end, data, offsets in text_slices(column):
        _, _, words, bounds = words_of(data, offsets, lower=True)
        windows = window_hashes(words, width)
        for i in range(end - first):
            a, b = bounds[i], bounds[i + 1]
            if b - a >= width:
                yield np.unique(windows[a : b - width + 1])
            elif b > a:
                yield mix(window_hashes(words[a:b], int(b - a)) + U64(b - a))
            else:
                yield np.zeros(0, U64)
