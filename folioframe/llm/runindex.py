"""A run-compressed index of many short texts: Burrows-Wheeler transform in runs, positions sampled at run ends.

Texts stand one after the other, each with an end mark that sorts before all bytes; marks are ordered as their texts are,
and no match goes past one. Any texts are streamed through it backwards for matching statistics: where the byte before a
row is not the one asked for, the search goes on at the nearest run of that byte above or below, whichever shares more
with the match so far. What two places share is told by comparing bytes at the positions sampled at run ends, after
Boucher, Gagie et al. (PHONI, 2021). The order of suffixes is dropped once the runs are made. All steps are numpy passes
over all texts at once.
"""

from __future__ import annotations

import numpy as np

_FIRST = 7  # symbols of nine bits in a key


class RunIndex:
    """``data`` holds the texts' bytes end to end, ``sizes`` their lengths, ``value`` a number of each; strings of
    ``depth`` bytes are looked for."""

    def __init__(self, data: np.ndarray, sizes: np.ndarray, depth: int, value: np.ndarray):
        if depth < _FIRST:
            raise ValueError(f"depth must be {_FIRST} or more")
        sizes = sizes.astype(np.int64)
        m, longest = len(sizes), int(sizes.max(initial=0)) + 1
        self.owner = np.repeat(np.arange(m, dtype=np.int32), sizes + 1)
        self.starts = np.cumsum(sizes + 1) - sizes - 1
        n = len(self.owner)
        symbols = np.zeros(n, np.int64)
        inside = np.ones(n, bool)
        inside[self.starts + sizes] = False
        symbols[inside] = data.astype(np.int64) + 1
        left = (self.starts + sizes)[self.owner] - np.arange(n)  # bytes up to the end mark

        def ahead(x: np.ndarray, k: int, none: int) -> np.ndarray:
            out = np.full(n, none, np.int64)
            out[: n - k] = x[k:]
            out[left < k] = none
            return out

        key = np.zeros(n, np.int64)
        for k in range(_FIRST):
            key = key << 9 | ahead(symbols, k, 0)
        rank = self._ranked(key)
        half, width = None, _FIRST
        while True:
            if half is None and 2 * width >= depth:
                half = ahead(rank, depth - width, -1), rank
            if width >= longest:
                break
            rank = self._ranked(rank * (n + 1) + ahead(rank, width, -1) + 1)
            width *= 2
        order = np.argsort(rank * n + np.arange(n))  # equal texts stay in their order
        self.depth, self.left = depth, left.astype(np.int32)
        before = np.zeros(n, np.int64)
        before[1:] = symbols[:-1]
        before[self.starts] = 0
        last = before[order]
        self.heads = np.flatnonzero(np.append(True, last[1:] != last[:-1])) if n else np.zeros(0, np.int64)
        lengths = np.diff(np.append(self.heads, n))
        self.letters = last[self.heads]
        by_letter = np.argsort(self.letters, kind="stable")
        self.target = np.zeros(len(self.heads), np.int64)
        self.target[by_letter] = np.cumsum(lengths[by_letter]) - lengths[by_letter]
        self.tails = self.heads + lengths - 1
        self.at_head, self.at_tail = order[self.heads], order[self.tails]  # sampled positions
        self.by_letter = self.letters[by_letter] * (len(self.heads) + 1) + by_letter
        # Suffixes that share their first ``depth`` bytes are an interval of rows, and only its least value is kept.
        fits = left[order] >= depth
        one, two = (half[1][order], half[0][order]) if half else (order, order)  # no half: no text is that long
        new = np.append(True, (one[1:] != one[:-1]) | (two[1:] != two[:-1]) | ~fits[1:] | ~fits[:-1]) if n else np.zeros(0, bool)
        self.intervals = np.flatnonzero(new)
        self.least = np.minimum.reduceat(value[self.owner[order]], self.intervals) if n else value[:0]
        # Eight bytes from each place on, for comparing; marks are zeros, and comparing ends before them.
        g = np.zeros(n + 8, np.uint64)
        g[:n] = np.maximum(symbols - 1, 0)
        for step in (1, 2, 4):
            g[:-step] |= g[step:] << np.uint64(8 * step)
        self.eight = np.append(g[:n], np.zeros(depth + 8, np.uint64))

    @staticmethod
    def _ranked(key: np.ndarray) -> np.ndarray:
        order = np.argsort(key)
        rank = np.empty(len(key), np.int64)
        rank[order] = np.cumsum(np.append(False, key[order][1:] != key[order][:-1])) if len(key) else []
        return rank

    def shared(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many bytes the indexed texts have in common from places a and b on, ``depth`` at most."""
        most = np.minimum(np.minimum(self.left[a], self.left[b]), self.depth).astype(np.int64)
        out = most.copy()
        todo = np.arange(len(a))
        for offset in range(0, self.depth, 8):
            differ = self.eight[a[todo] + offset] ^ self.eight[b[todo] + offset]
            off = differ != 0
            low = differ[off] & (~differ[off] + np.uint64(1))
            at = (np.frexp(low.astype(np.float64))[1] - 1) // 8
            out[todo[off]] = np.minimum(most[todo[off]], offset + at)
            todo = todo[~off]
            todo = todo[most[todo] > offset + 8]
            if not len(todo):
                break
        return out

    def stream(self, data: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(text, offset, place, least) of each string of ``depth`` bytes of some texts that an indexed text has too: a place
        where it is, and the least value of the texts that have it.

        Texts are matched from their ends, a byte a step in lockstep.
        """
        sizes = sizes.astype(np.int64)
        ends = np.cumsum(sizes)
        none = np.zeros(0, np.int64)
        if not len(self.heads) or not len(sizes):
            return none, none, none, self.least[:0]
        text = np.arange(len(sizes))
        run = np.full(len(sizes), len(self.heads) - 1)
        row, place, matched = self.tails[run], self.at_tail[run], np.zeros(len(sizes), np.int64)
        found = []
        runs = len(self.heads)
        for step in range(1, int(sizes.max(initial=0)) + 1):
            alive = sizes[text] >= step
            text, row, place, matched = text[alive], row[alive], place[alive], matched[alive]
            letter = data[ends[text] - step].astype(np.int64) + 1
            run = np.searchsorted(self.heads, row, "right") - 1
            off = np.flatnonzero(self.letters[run] != letter)
            if len(off):
                c, r = letter[off], run[off]
                i = np.searchsorted(self.by_letter, c * (runs + 1) + r)
                down, up = np.minimum(i, runs - 1), np.maximum(i - 1, 0)
                has_down, has_up = self.by_letter[down] // (runs + 1) == c, self.by_letter[up] // (runs + 1) == c
                down, up = self.by_letter[down] % (runs + 1), self.by_letter[up] % (runs + 1)
                below = np.where(has_down, self.shared(place[off], self.at_head[down]), -1)
                above = np.where(has_up, self.shared(place[off], self.at_tail[up]), -1)
                higher = above > below
                run[off] = np.where(higher, up, down)
                row[off] = np.where(higher, self.tails[up], self.heads[down])
                place[off] = np.where(higher, self.at_tail[up], self.at_head[down])
                best = np.maximum(above, below)
                matched[off] = np.minimum(matched[off], best)
                lost = off[best < 0]  # a byte that no indexed text has
                run[lost], row[lost], place[lost], matched[lost] = runs - 1, self.tails[-1], self.at_tail[-1], -1
            row = np.where(matched >= 0, self.target[run] + row - self.heads[run], row)
            place = np.where(matched >= 0, place - 1, place)
            matched = np.minimum(matched + 1, self.depth)
            full = matched == self.depth
            if full.any():
                at = np.searchsorted(self.intervals, row[full], "right") - 1
                found.append((text[full], sizes[text[full]] - step, place[full], self.least[at]))
        return tuple(np.concatenate(c) for c in zip(*found, strict=True)) if found else (none, none, none, self.least[:0])
