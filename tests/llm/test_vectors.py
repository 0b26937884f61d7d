"""Vector codes against plain Lloyd rounds in Python integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from folioframe.llm import vectors


def brute(rows, rounds=4):
    ok = lambda v: v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and len(v) % 4 == 0
    kept = [(i, [max(-(1 << 26), min(1 << 26, math.floor(1024 * x))) for x in v], l) for i, v, l in rows if ok(v)]
    last = lambda r: (r[0] is None, r[0] or 0, np.array(r[1], "<i4").tobytes())
    kept.sort(key=last)
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    width = len(kept[0][1]) // 4
    cut = lambda q: [tuple(q[p * width : (p + 1) * width]) for p in range(4)]
    books = [[cut(q)[p] for _, q, _ in kept[:256]] for p in range(4)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    give = lambda: [[min(range(len(books[p])), key=lambda e: (far(cut(q)[p], books[p][e]), e)) for p in range(4)] for _, q, _ in kept]
    for _ in range(rounds):
        codes = give()
        for p in range(4):
            for e in range(len(books[p])):
                own = [cut(q)[p] for (_, q, _), c in zip(kept, codes, strict=True) if c[p] == e]
                if own:
                    books[p][e] = tuple(sum(x) // len(own) for x in zip(*own, strict=True))
    codes = give()
    errors = [sum(far(cut(q)[p], books[p][c[p]]) for p in range(4)) for (_, q, _), c in zip(kept, codes, strict=True)]
    total = {}
    for (_, _, l), e in zip(kept, errors, strict=True):
        total[l] = total.get(l, 0) + e
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    return sorted(((i, "".join(f"{x:02x}" for x in c), e, total[l], digest) for (i, _, l), c, e in zip(kept, codes, errors, strict=True)), key=repr)


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, label int, code string, error int")


def check(spark, rows):
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], l) for i, v, l in rows]
    got = vectors.compressed(table(spark, rows))
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


def some(n, dim, seed, spread=1.0):
    rnd = random.Random(seed)
    centers = [[rnd.gauss(0, spread) for _ in range(dim)] for _ in range(12)]
    return [(rnd.randrange(5 * n), [x + rnd.gauss(0, 0.2) for x in rnd.choice(centers)], rnd.choice([None, 0, 1, 2])) for _ in range(n)]


def test_many_vectors(spark):
    check(spark, some(700, 8, 1))


def test_ties_copies_and_odd_rows(spark):
    rnd = random.Random(2)
    grid = [(rnd.randrange(400), [rnd.choice([-0.5, 0.0, 0.25]) for _ in range(4)], rnd.choice([None, 7])) for _ in range(500)]
    odd = [(1, None, 1), (2, [], 1), (3, [1.0, None, 0.0, 0.0], 1), (4, [math.nan] * 4, 2), (5, [math.inf, 0, 0, 0], 2), (None, [0.5] * 4, 3), (None, [0.5] * 4, None), (6, [1.0] * 8, 1), (7, [1.0] * 3, 1), (8, [1e30, -1e30, 3e4, 0], 9)]
    check(spark, grid + odd)


def test_fewer_vectors_than_entries(spark):
    check(spark, some(9, 12, 3))
    check(spark, some(1, 4, 4))


def test_large_components_leave_doubles(spark):
    check(spark, some(300, 4, 5, spread=60_000.0))


def test_nothing_kept(spark):
    assert vectors.compressed(table(spark, [])).count() == 0
    assert vectors.compressed(table(spark, [(1, None, 1), (2, [math.nan], 1)])).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_bounds_never_change_a_result(seed):
    """Rows that bounds let pass unseen have the entry of a full scan; and most rows pass."""
    rnd = np.random.default_rng(seed)
    x = rnd.integers(-60, 60, (4000, 3)) * rnd.choice([1, 100])
    book = x[:40].copy()
    code, upper, lower = vectors._full(x, book)
    scanned = []
    for _ in range(8):
        after = np.array([x[code == e].sum(0) // max(1, (code == e).sum()) if (code == e).any() else book[e] for e in range(len(book))])
        code, upper, lower, n = vectors.assigned(x, after, vectors.Moves(book, after), code, upper, lower)
        book = after
        scanned.append(n)
        d = vectors._distances(x, book)
        assert (code == d.argmin(1)).all()
        own = np.sqrt(d[np.arange(len(x)), code].astype(float))
        d[np.arange(len(x)), code] = np.iinfo(np.int64).max
        assert (upper >= own).all() and (lower <= np.sqrt(d.min(1).astype(float))).all()
    assert scanned[-1] < len(x) / 2
