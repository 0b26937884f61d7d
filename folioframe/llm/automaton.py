"""An Aho-Corasick automaton over word numbers, in numpy arrays: about 20 bytes a node, many texts scanned in lockstep."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: A long run of known words is scanned in pieces of so many.
PIECE = 256
_NONE = np.zeros(0, np.int64)


class Automaton:
    """Patterns are ``numbers[start : start + size]``, with numbers of 1 or more."""

    def __init__(self, numbers: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
        self.starts, self.sizes = starts.astype(np.int64), sizes.astype(np.int64)
        self.longest, self.shortest = int(sizes.max(initial=0)), int(sizes.min()) if len(sizes) else 0
        node = np.zeros(len(starts), np.int64)
        edges, levels, made = [], [], 0
        for depth in range(self.longest):
            on = np.flatnonzero(self.sizes > depth)
            keys, place = np.unique(node[on] << 32 | numbers[self.starts[on] + depth], return_inverse=True)
            node[on] = made + 1 + place
            levels.append((made + 1, made + 1 + len(keys)))
            made += len(keys)
            edges.append(keys)
        # A level's parents are the level before, so the keys of all levels are sorted, and a child is its key's place.
        self.edges = np.concatenate([*edges, _NONE])
        self.first = np.zeros(int(numbers.max(initial=0)) + 1, np.int32)
        if edges:
            self.first[edges[0]] = 1 + np.arange(len(edges[0]))
        self.fail = np.zeros(made + 1, np.int32)
        for a, b in levels[1:]:
            keys = self.edges[a - 1 : b - 1]
            self.fail[a:b] = self.advance(self.fail[keys >> 32].astype(np.int64), keys & 0xFFFFFFFF)
        self.by_node = np.argsort(node, kind="stable")
        self.bounds = np.searchsorted(node[self.by_node], np.arange(made + 2))
        ends = np.diff(self.bounds) > 0
        self.link = np.zeros(made + 1, np.int32)
        for a, b in levels:
            up = self.fail[a:b]
            self.link[a:b] = np.where(ends[up], up, self.link[up])
        self.ends = ends

    def advance(self, state: np.ndarray, number: np.ndarray) -> np.ndarray:
        """The states after one more number each; 0 is the root, and number 0 leads there."""
        out = np.zeros(len(state), np.int64)
        todo = np.flatnonzero((number > 0) & (number < len(self.first)))
        s, x = state[todo], number[todo]
        while len(todo):
            root = s == 0
            out[todo[root]] = self.first[x[root]]
            todo, s, x = todo[~root], s[~root], x[~root]
            if not len(todo):
                break
            key = s << 32 | x
            at = np.minimum(np.searchsorted(self.edges, key), len(self.edges) - 1)
            found = self.edges[at] == key
            out[todo[found]] = at[found] + 1
            todo, s, x = todo[~found], self.fail[s[~found]].astype(np.int64), x[~found]
        return out

    def scan(self, numbers: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(place, pattern) of every occurrence, some more than once, in arrays of about ``most``; 0 is no number of a pattern."""
        if not self.longest:
            return
        known = np.concatenate([[False], numbers > 0, [False]])
        a, b = np.flatnonzero(known[1:] & ~known[:-1]), np.flatnonzero(known[:-1] & ~known[1:])
        long = b - a >= self.shortest
        a, b = a[long], b[long]
        pieces = -(-(b - a) // PIECE)
        run = np.repeat(np.arange(len(a)), pieces)
        at = a[run] + PIECE * (np.arange(len(run)) - np.repeat(np.cumsum(pieces) - pieces, pieces))
        end = np.minimum(at + PIECE, b[run])
        at = np.maximum(at - self.longest + 1, a[run])
        order = np.argsort(at - end, kind="stable")
        at, end = at[order], end[order]
        sizes = end - at
        state = np.zeros(len(at), np.int64)
        places, nodes, held = [], [], 0
        for step in range(int(sizes.max(initial=0))):
            alive = int(np.searchsorted(-sizes, -step))
            state = self.advance(state[:alive], numbers[at[:alive] + step])
            node, place = state, at[:alive] + step
            while True:
                on = np.flatnonzero(node)
                if not len(on):
                    break
                node, place = node[on], place[on]
                here = self.ends[node]
                if here.any():
                    places.append(place[here])
                    nodes.append(node[here])
                    held += int((self.bounds[node[here] + 1] - self.bounds[node[here]]).sum())
                node = self.link[node].astype(np.int64)
            if held >= most:
                yield from self._occurrences(places, nodes, most)
                places, nodes, held = [], [], 0
        yield from self._occurrences(places, nodes, most)

    def _occurrences(self, places: list[np.ndarray], nodes: list[np.ndarray], most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if not places:
            return
        place, node = np.concatenate(places), np.concatenate(nodes)
        first, count = self.bounds[node], self.bounds[node + 1] - self.bounds[node]
        before = np.cumsum(count) - count
        total = int(count.sum())
        for low in range(0, total, most):
            each = np.arange(low, min(low + most, total))
            of = np.searchsorted(before, each, "right") - 1
            pattern = self.by_node[first[of] + each - before[of]]
            yield place[of] - self.sizes[pattern] + 1, pattern


class Vocabulary:
    """Numbers from 1 on for the words of some texts, by 64-bit hashes; 0 for all other words."""

    def __init__(self, hashes: np.ndarray):
        self.known = np.unique(hashes)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.known):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)
        return np.where(self.known[at] == hashes, at + 1, 0)
