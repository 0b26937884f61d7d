"""SimHash near-dedup against brute force over all pairs."""

import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from test_llm import LOWER, ODD, WORD, docs_of

from folioframe.llm import simhash


def brute_print(text):
    w = WORD.findall((text or "").translate(LOWER))
    shingles = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] if len(w) >= 4 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(rows):
    prints = [brute_print(t) for _, t in rows]
    known = sorted(set(prints))
    label = {p: p for p in known}

    def root(p):
        while label[p] != p:
            p = label[p]
        return p

    for i, a in enumerate(known):
        for b in known[:i]:
            if (a ^ b).bit_count() <= 4:
                label[root(a)] = root(b)
    least = {}
    for (i, _), p in zip(rows, prints, strict=True):
        if i is not None:
            least[root(p)] = min(i, least.get(root(p), i))
    return sorted(((i, f"{p:016x}", least.get(root(p))) for (i, _), p in zip(rows, prints, strict=True)), key=repr)


def texts(n):
    """Long texts with a word or two changed step by step: chains of near prints; and unrelated ones."""
    rnd = random.Random(11)
    vocabulary = ["".join(rnd.choice("abcdeéß") for _ in range(rnd.randrange(1, 7))) for _ in range(500)]
    out = []
    for k in range(n):
        if k % 12:
            words = out[-1].split(" ")
            words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
        else:
            words = [rnd.choice(vocabulary) for _ in range(rnd.choice([6, 40, 400]))]
        out.append(" ".join(words))
    return [*out, *ODD, *out[:5], "word " * 20_000, "A B\tC \n D", "a b c d"]


@pytest.mark.parametrize("hot", [simhash.HOT, 1])
def test_near_duplicates(spark, hot):
    found = texts(240)
    ids = [None if k % 17 == 0 else (k * 7) % 211 for k in range(len(found))]
    got = simhash.near_duplicates(docs_of(spark, found, ids), hot=hot)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(list(zip(ids, found, strict=True)))


def test_empty(spark):
    assert simhash.near_duplicates(docs_of(spark, [])).count() == 0


def test_fingerprints_of_long_and_glued_texts():
    rnd = random.Random(2)
    column = ["x y", "z", None, "", " lead", "trail ", *[" ".join(rnd.choice("abcde") * rnd.randrange(1, 4) for _ in range(n)) for n in (3, 4, 5, 254, 258, 259, 600, 21_000)]]
    assert simhash.fingerprints(pa.array(column, pa.string())).tolist() == [brute_print(t) for t in column]


def test_no_link_is_missed():
    """Any two prints of four or fewer differing bits share an anchor of a half, and there one of a quarter."""
    rnd = np.random.default_rng(3)
    a = rnd.integers(0, 1 << 63, 3000, dtype=np.uint64) * np.uint64(2) + rnd.integers(0, 2, 3000, dtype=np.uint64)
    b = a.copy()
    for k in range(4):
        b ^= np.uint64(1) << rnd.integers(0, 64, 3000, dtype=np.uint64)
    sets = []
    for x in (a, b):
        row, anchor = simhash.half_anchors(x)
        assert np.bincount(row).max() <= 34
        second, sub = simhash.quarter_anchors(x[row], anchor)
        sets.append((set(zip(row.tolist(), anchor.tolist(), strict=True)), set(zip(row[second].tolist(), anchor[second].tolist(), sub.tolist(), strict=True))))
    for place in (0, 1):
        assert {x[0] for x in sets[0][place] & sets[1][place]} == set(range(3000))


@pytest.mark.parametrize("bits", [16, 32])
def test_anchors_are_within_two_bits(bits):
    rnd = np.random.default_rng(4)
    words = rnd.integers(0, 1 << bits, 200, dtype=np.uint64)
    words[:3] = 0, 1, (1 << bits) - 1
    row, anchor = simhash.Anchors(bits).near(words)
    assert np.bitwise_count(words[row] ^ anchor).max() <= 2
    codeword = simhash.Anchors(bits)
    syndrome = np.zeros(len(anchor), np.int64)
    for k, table in enumerate(codeword.octets):
        syndrome ^= table[((anchor & ~codeword.free) >> np.uint64(8 * k) & np.uint64(255)).astype(np.int64)]
    assert not syndrome.any()


def test_forest_joins_what_steps_join():
    rnd = np.random.default_rng(5)
    center = rnd.integers(0, 1 << 63, 3, dtype=np.uint64)
    prints = center[rnd.integers(0, 3, 400)]
    for _ in range(5):
        prints = prints ^ (np.uint64(1) << rnd.integers(0, 64, 400, dtype=np.uint64))
    a, b = simhash.near_forest(prints)
    assert len(a) == len(np.unique(b)) and (np.bitwise_count(a ^ b) <= 4).all()
    joined = {int(p): {int(p)} for p in prints}
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        both = joined[x] | joined[y]
        for p in both:
            joined[p] = both
    for i in joined:
        for j in joined:
            if (i ^ j).bit_count() <= 4:
                assert j in joined[i]
