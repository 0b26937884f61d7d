"""Periodic runs against brute force over all starts and periods."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from test_llm import ODD, WORD, docs_of

from folioframe.llm import lyndon


def brute(w, least=24, times=3):
    n, found = len(w), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            found.setdefault((i, j + q), q)  # the smallest period comes first
            i = j
    return sorted((s, e - s, q) for (s, e), q in found.items() if e - s >= max(least, times * q))


@given(st.lists(st.integers(0, 2), max_size=60), st.integers(2, 8))
@settings(max_examples=300, deadline=None)
def test_runs_of_small_alphabets(w, least):
    assert lyndon.periodic_runs(np.array(w, np.int64), least, 2) == [r for r in brute(w, 2, 2) if r[1] >= least]


@given(st.lists(st.integers(0, 3), min_size=1, max_size=9), st.integers(2, 12), st.lists(st.integers(0, 3), max_size=30), st.lists(st.integers(0, 3), max_size=30))
@settings(max_examples=200, deadline=None)
def test_planted_runs(root, times, before, after):
    w = before + root * times + after
    assert lyndon.periodic_runs(np.array(w, np.int64)) == brute(w)


@given(st.lists(st.integers(0, 4), max_size=50))
@settings(max_examples=100, deadline=None)
def test_suffix_order(w):
    rank, lcp = lyndon.suffix_order(np.array(w, np.int64))
    order = sorted(range(len(w)), key=lambda i: w[i:])
    assert [int(rank[i]) for i in order] == list(range(len(w)))
    for r in range(1, len(w)):
        a, b = w[order[r - 1] :], w[order[r] :]
        assert lcp[r] == next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))


def expected(doc_id, text, rule):
    w = WORD.findall(text or "")
    n, h = len(w), zlib.crc32(str(doc_id).encode())
    if rule and doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = brute(w)
    gone = {i for s, size, q in found for i in range(s + q, s + size)}
    best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])) if found else (None,) * 3
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    told = "".join(f"{s},{size},{q}\n" for s, size, q in found)
    return (doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None, sha(told), sha(" ".join(x for i, x in enumerate(w) if i not in gone)), told)


@pytest.mark.parametrize("rule", [False, True])
def test_documents(spark, rule):
    rnd = random.Random(8)
    texts = list(ODD)
    for _ in range(120):
        words = [rnd.choice(["a", "b", "é", "word", "Word"]) for _ in range(rnd.randrange(0, 120))]
        root = [rnd.choice("abcdefgh") for _ in range(rnd.randrange(1, 9))]
        texts.append(rnd.choice([" ", "\n", "\t "]).join(words + root * rnd.randrange(0, 30) + words[:5] + root[:2] * rnd.choice([0, 20])))
    ids = [None if k % 19 == 3 else k // 2 * 3 for k in range(len(texts))]
    got = lyndon.runs(docs_of(spark, texts, ids), repeat_rule=rule).collect()
    assert sorted(map(tuple, got), key=repr) == sorted((expected(i, t, rule) for i, t in zip(ids, texts, strict=True)), key=repr)
    assert any(r.n_runs > 1 for r in got) and any(not r.n_runs for r in got)


def test_long_text(spark):
    """Over 20,000 words: a run of period 7, and one word over and over."""
    rnd = random.Random(9)
    filler = [f"w{rnd.randrange(10**6)}" for _ in range(9000)]
    text = " ".join([*filler[:4000], *["p q r s t u v"] * 1000, *filler[4000:], *["x"] * 8000])
    row = lyndon.runs(docs_of(spark, [text])).first()
    assert (row.n_runs, row.start, row.length, row.period, row.exponent_milli) == (2, 16000, 8000, 1, 8_000_000)
    assert row.runs == "4000,7000,7\n16000,8000,1\n"


def test_empty(spark):
    assert lyndon.runs(docs_of(spark, [])).count() == 0
