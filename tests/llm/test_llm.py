"""The training-data operators against brute force on small fixtures: nulls, empties, ties, repeats, extra columns."""

import hashlib
import math
import os
import random
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from folioframe.llm import chat, confirm, decontaminate, hostrules, kernels, lines, minhash, packing, pii, quality, queries, repeats, tokens, work
from folioframe.llm.components import components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Texts that every operator must take.
ODD = [None, "", " ", "\n\n", "one", "One\ttwo three four", "a b c d e", "A B C D E", "é 𝒳 漢 字 ü ß", "x" * 5000, "line one of the text\n" * 40, " nbsp between nine ten  words\x0bhere and more words"]


def docs_of(spark, texts, ids=None):
    """Documents with columns whose names clash with what operators add."""
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, "en", f"s{k % 3}", len(t or ""), True, 1, "x") for k, (i, t) in enumerate(zip(ids, texts, strict=True))]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept boolean, score int, key string")


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


@pytest.fixture(scope="module")
def corpus():
    rnd = random.Random(4)
    vocabulary = ["".join(rnd.choice("abcdeé") for _ in range(rnd.randrange(1, 6))) for _ in range(300)]
    say = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    passage = say(60)
    texts = []
    for _ in range(60):
        t = say(rnd.choice([3, 5, 30, 120, 400]))
        texts.append(t + rnd.choice(["", "\n" + passage, "\n" + say(8)]))
    for i in range(40):
        words = texts[i % 20].split(" ")
        for _ in range(rnd.choice([0, 1, 1, 3])):
            words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
        texts.append(" ".join(words))
    texts += texts[:6] + ODD
    rnd.shuffle(texts)
    return texts


# --- kernels -----------------------------------------------------------------------------------------------------------


@given(st.lists(st.one_of(st.none(), st.text("aB \n\té𝒳", max_size=40)), max_size=12))
@settings(max_examples=100, deadline=None)
def test_measure(texts):
    got = hostrules.measure(pa.array(texts, pa.string()))
    for i, t in enumerate(texts):
        w = WORD.findall(t or "")
        full = [x for x in (t or "").split("\n") if WORD.search(x)]
        windows = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
        covered = {k + j for k, x in enumerate(windows) if windows.count(x) > 1 for j in range(5)}
        assert [int(got[k][i]) for k in hostrules.COUNTERS] == [len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(full) - len(set(full)), len(covered)]


def shingles(t):
    w = WORD.findall((t or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def test_shingle_sets(corpus):
    got = list(kernels.shingle_sets(pa.array(corpus, pa.string())))
    want = [shingles(t) for t in corpus]
    assert [len(g) for g in got] == [len(w) for w in want]
    same = {}
    for g, w in zip(got, want, strict=True):
        assert same.setdefault(g.tobytes(), w) == w


# --- 2: near-duplicates ------------------------------------------------------------------------------------------------


def brute_near(ids, texts, percent=85):
    sets, up = [shingles(t) for t in texts], {i: i for i in ids}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = root(ids[i]), root(ids[j])
                up[max(a, b)] = min(a, b)
    return {i: (len(s), root(i), root(i) == i) for i, s in zip(ids, sets, strict=True)}


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates(spark, corpus, percent):
    got = by_id(minhash.near_duplicates(docs_of(spark, corpus), percent=percent))
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()} == brute_near(list(range(len(corpus))), corpus, percent)


def test_near_duplicates_of_a_chain(spark, monkeypatch):
    """Each text is near the next, the ends are not near each other; blocks are made small so that clusters are split."""
    monkeypatch.setattr(confirm, "BLOCK", 8)
    base = [f"w{i}" for i in range(200)]
    texts = [" ".join(base[:i] + [f"x{k}" for k in range(i)] + base[i:]) for i in range(0, 60, 1)]
    got = by_id(minhash.near_duplicates(docs_of(spark, texts), percent=85))
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()} == brute_near(list(range(60)), texts)


@pytest.mark.parametrize(("block", "items", "band"), [(4, 2_000_000, 4096), (16, 1_500, 4096), (8, 2_000_000, 3)])
def test_near_duplicates_in_small_blocks(spark, corpus, monkeypatch, block, items, band):
    """Clusters are dealt over many blocks, and pieces that no representatives link are linked by rare shingles."""
    monkeypatch.setattr(confirm, "BLOCK", block)
    monkeypatch.setattr(confirm, "BLOCK_ITEMS", items)
    monkeypatch.setattr(minhash, "BAND", band)
    across = []
    plain = confirm._across
    monkeypatch.setattr(confirm, "_across", lambda *a: across.append(a) or plain(*a))
    rnd = random.Random(9)
    base = [f"w{i}" for i in range(120)]
    edit = lambda w, n: [f"e{rnd.randrange(10**6)}" if i in set(rnd.sample(range(len(w)), n)) else x for i, x in enumerate(w)]
    bases = [base]
    for n in (3, 4, 5, 4):  # groups about as near to each other as the threshold asks
        bases.append(edit(bases[-1], n))
    texts = [*corpus[:40], *[" ".join(edit(b, rnd.choice([0, 0, 1, 1, 2]))) for b in bases for _ in range(25)]]
    got = by_id(minhash.near_duplicates(docs_of(spark, texts), percent=85))
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()} == brute_near(list(range(len(texts))), texts)
    assert across


def test_near_copies_cost_their_number(spark, monkeypatch):
    """Rows that go into comparing groups grow with a cluster of near copies, not with its square."""
    monkeypatch.setattr(confirm, "BLOCK", 64)
    rows = []
    plain = confirm.by_groups
    monkeypatch.setattr(confirm, "by_groups", lambda df, *a, **k: rows.append(df.count()) or plain(df, *a, **k))
    rnd = random.Random(3)
    base = [f"w{i}" for i in range(150)]
    texts = [" ".join(x if i != k else f"e{n}" for i, x in enumerate(base)) for n, k in enumerate(rnd.randrange(150) for _ in range(2_000))]
    got = by_id(minhash.near_duplicates(docs_of(spark, texts), percent=85))
    assert {r.component_id for r in got.values()} == {0}
    assert sum(rows) < 1.2 * len(texts)


def test_keep_one_takes_clashing_names(spark):
    t = "the same ten words are in all of these texts"
    df = docs_of(spark, [t, t, t], [5, 5, 6]).withColumn("place", F.lit(1)).withColumn("__n", F.lit(1)).withColumn("n", F.lit(2))
    assert [r.doc_id for r in minhash.keep_one(df).collect()] == [5]


def test_a_pair_at_the_threshold_shares_a_band():
    rnd = np.random.default_rng(8)
    missed, n = 0, 2_000
    for _ in range(n):
        pool = rnd.integers(0, 1 << 63, 185, dtype=np.uint64)  # 170 of 200 in common
        a, b = np.unique(pool[:185]), np.unique(np.append(pool[:170], rnd.integers(0, 1 << 63, 15, dtype=np.uint64)))
        same = (minhash.registers(a) == minhash.registers(b)).reshape(minhash.BANDS, minhash.ROWS)
        missed += not same.all(1).any() or float(minhash.corrected(same.mean())) < 0.85 - 0.13
    assert not missed


def test_near_duplicates_null_and_repeated_ids(spark):
    t = "the same ten words are in all of these texts"
    df = docs_of(spark, [t, t, t, "other words that stand alone in here"], [None, 5, 5, None])
    got = sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in minhash.near_duplicates(df).collect())
    assert got == [(-1, -1, True), (-1, -1, True), (5, 5, True), (5, 5, True)]
    assert minhash.near_duplicates(df.limit(0)).count() == 0
    one = minhash.keep_one(df)
    assert one.columns == df.columns and sorted(r.doc_id or -1 for r in one.collect()) == [-1, -1, 5]


def test_registers_estimate():
    rnd = np.random.default_rng(1)
    pool = np.unique(rnd.integers(0, 1 << 63, 4000, dtype=np.uint64))
    for shared in (0, 1000, 2500):
        a, b = np.unique(pool[:2500]), np.unique(pool[2500 - shared : 5000 - shared])
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs(float(minhash.corrected((minhash.registers(a) == minhash.registers(b)).mean())) - true) < 0.12


def test_exact_edges_agree_in_both_forms():
    rnd = np.random.default_rng(2)
    base = np.unique(rnd.integers(0, 1 << 62, 80, dtype=np.uint64))
    sets = [np.unique(np.append(base[rnd.random(len(base)) > 0.06], rnd.integers(0, 1 << 62, 3, dtype=np.uint64))) for _ in range(60)]
    def roots(edges):
        f = confirm.Forest(60)
        for x, y in edges:
            f.join(x, y)
        return [f.root(i) for i in range(60)]
    pairs = [(x, y) for x in range(60) for y in range(x) if 100 * len(np.intersect1d(sets[x], sets[y])) >= 85 * len(np.union1d(sets[x], sets[y]))]
    assert roots(confirm.exact_edges(sets, 85)) == roots(pairs)
    assert len(pairs) > 20


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rnd = random.Random(seed)
    edges = [(rnd.randrange(60), rnd.randrange(60)) for _ in range(40)] + [(i, i + 1) for i in range(100, 130)] + [(7, 7), (3, None)]
    up = {x: x for e in edges for x in e if x is not None}
    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    linked = set()
    for a, b in edges:
        if b is not None and a != b:
            linked |= {a, b}
            x, y = root(a), root(b)
            up[max(x, y)] = min(x, y)
    df = spark.createDataFrame(edges, "a long, b long")
    assert {r.node: r.label for r in components(df).collect()} == {x: root(x) for x in linked}
    assert components(df.limit(0)).count() == 0


# --- 1: token counts ---------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def count():
    return tokens.Counter(tokens.ranks(tokens.VOCABULARY))


PIECES = ["a", "b'", "'s", "'ll", " ", "  ", "\n", "1", "é", "!", "'l", "x", "re", "'re", ".", "漢", " ", "𝒳", "word"]


@given(st.lists(st.sampled_from(PIECES), max_size=200), st.lists(st.tuples(st.integers(0, 300), st.integers(0, 80), st.lists(st.sampled_from(PIECES), max_size=150)), max_size=5))
@settings(max_examples=150, deadline=None)
def test_edits_equal_recounting(count, start, edits):
    text = "".join(start)
    tree = tokens.Tree(text, *tokens.leaves(text, count))
    for at, gone, new in edits:
        s, e, new = min(at, len(text)), min(at + gone, len(text)), "".join(new)
        text = text[:s] + new + text[e:]
        tree.edit(at, at + gone, new, count)
        chars, n = tokens.leaves(text, count)
        assert tree.text == text and tree.total == len(count.encoding.encode_ordinary(text)) and tree.sums[1][0] == len(text)
        assert (sum((c for c, _ in tree.blocks), []), sum((t for _, t in tree.blocks), [])) == (chars, n)


def test_edits_reach_little(count):
    text = "plain words stand here " * 2000
    tree = tokens.Tree(text, *tokens.leaves(text, count))
    tree.edit(20_000, 20_005, "changed", count)
    assert tree.encoded < 10


def test_token_counts(spark, corpus, count):
    df = docs_of(spark, corpus).withColumn("edits", tokens.sample_edits(F.col("text"), F.col("doc_id")))
    rows = {r.doc_id: r for r in df.collect()}
    got = by_id(tokens.recount(tokens.index(df, keep=["edits"]), keep_tree=True))
    for i, r in got.items():
        t = rows[i].text or ""
        assert r.n_before == len(count.encoding.encode_ordinary(t))
        for e in rows[i].edits:
            t = t[: e.start] + e.text + t[e.end :]
        assert r.text == t and r.n_tokens == len(count.encoding.encode_ordinary(t)) and r.n_chars == len(t)
    plain = tokens.index(docs_of(spark, [None, "a b"])).withColumn("edits", F.lit(None))
    assert [(r.n_before, r.n_tokens) for r in tokens.recount(plain).orderBy("doc_id").collect()] == [(0, 0), (2, 2)]
    assert tokens.recount(tokens.index(df.limit(0), keep=["edits"])).count() == 0
    one_pass = by_id(tokens.counted(df))
    assert {i: tuple(r) for i, r in one_pass.items()} == {i: tuple(r)[:6] for i, r in got.items()}
    clashing = tokens.index(df.withColumn("tree", F.lit("x")), keep=["edits", "tree", "text"])
    assert clashing.columns == ["doc_id", "text", "n_tokens", "tree", "edits", "_tree", "_text"] and clashing.first()["_tree"] == "x"
    assert tokens.counted(df.limit(0)).count() == 0


# --- 3: packing --------------------------------------------------------------------------------------------------------


@given(st.lists(st.integers(1, 64), max_size=60))
@settings(max_examples=100, deadline=None)
def test_pack(lengths):
    sizes, caps = np.array(lengths, np.int64), (16, 32, 64)
    where, offset, capacity = packing.pack(sizes, caps)
    bins = {}
    for b, o, n, c in zip(where, offset, sizes, capacity, strict=True):
        bins.setdefault(int(b), []).append((int(o), int(n), int(c)))
    for items in bins.values():
        at = 0
        for o, n, _ in sorted(items):
            assert o == at
            at += n
        assert {c for _, _, c in items} == {min(c for c in caps if c >= at)}
    total = sum(packing.sequence_cost(i[0][2]) for i in bins.values())
    for floor in caps:  # no single opening size does better
        _, _, used = packing.best_fit(sizes, floor, caps)
        assert total <= sum(packing.sequence_cost(min(c for c in caps if c >= u)) for u in used) + 1e-9


@given(st.lists(st.integers(0, 40), max_size=30))
@settings(max_examples=80, deadline=None)
def test_best_fit_is_that_of_a_quadratic_search(lengths):
    caps, cost = (8, 16, 40), packing.sequence_cost
    where, offset, used = packing.best_fit(np.array(lengths, np.int64), None, caps)
    bins, todo, touched = [], sorted(range(len(lengths)), key=lambda i: -lengths[i]), 0

    def rate(c, n, rest):
        left = c - n
        for m in rest:  # longest first
            left -= m if m <= left else 0
        return cost(min(d for d in caps if d >= c - left)) / max(1, c - left)

    while todo:
        i = todo.pop(0)
        n, touched = lengths[i], touched + 1
        fits = [b for b in bins if b["space"] >= n]
        if fits:
            b = min(fits, key=lambda b: (b["space"], -b["touched"]))
        else:
            rest = [lengths[k] for k in todo]
            c = min((c for c in caps if c >= n), key=lambda c: (rate(c, n, rest), c))
            b = {"space": c, "used": 0, "no": len(bins)}
            bins.append(b)
        assert (where[i], offset[i]) == (b["no"], b["used"])
        b["space"], b["used"], b["touched"] = b["space"] - n, b["used"] + n, touched
    assert used == [b["used"] for b in bins]


def test_packed(spark, corpus, count):
    df = docs_of(spark, [*corpus, "w " * 70, "v " * 63], [*range(len(corpus)), None, 0])
    got = packing.packed(df, capacities=(16, 32, 64), shard_rows=40).collect()
    words = {}
    for r in got:
        words[r.doc_id] = words.get(r.doc_id, 0) + r.length
    want = {}
    for r in df.collect():
        want[r.doc_id] = want.get(r.doc_id, 0) + count.total(r.text or "")
    assert words == want
    bins = {}
    for r in got:
        bins.setdefault((r.bin_id, r.capacity), []).append((r.bin_offset, r.length + 1))
    assert len({b for b, _ in bins}) == len(bins)
    for (_, capacity), items in bins.items():
        ends = [0]
        for o, n in sorted(items):
            assert o == ends[-1]
            ends.append(o + n)
        assert ends[-1] <= capacity and (capacity == 16 or ends[-1] > capacity // 2)
    assert packing.packed(df.limit(0)).count() == 0


# --- 4: host rules -----------------------------------------------------------------------------------------------------


def test_host_rules(spark):
    good, bad = "twelve different words make this text long enough to pass all rules", "too short"
    texts = [good] * 40 + [bad] * 2 + [good] * 2 + [bad] * 30 + [None, good]
    hosts = ["fine"] * 42 + ["poor"] * 32 + [None, None]
    df = docs_of(spark, texts).drop("source").join(spark.createDataFrame(list(enumerate(hosts)), "doc_id long, source string"), "doc_id")
    got = by_id(hostrules.host_rules(df))
    salted = by_id(hostrules.host_rules(df, broadcast_hosts=-1))
    for i, (t, h) in enumerate(zip(texts, hosts, strict=True)):
        assert got[i].base_failed == (t != good) and got[i].host_failed == (h == "poor") and got[i].kept == (t == good and h != "poor")
        assert salted[i] == got[i]
    assert hostrules.host_rules(df.limit(0)).count() == 0
    assert df.select(hostrules.host_of(F.lit("HTTP://u@News.Example.org:80/x")).alias("h")).first().h == "news.example.org"


def test_beta_prior():
    a, b = hostrules.beta_prior(1000, 100, 100 * 0.1, 10)  # no spread between hosts
    assert a / (a + b) == pytest.approx(0.1) and a + b == 1000
    a, b = hostrules.beta_prior(200, 100, 100.0, 2)  # one host fails all, one none
    assert a + b < 3


# --- 5: classifier -----------------------------------------------------------------------------------------------------


def test_risk_and_its_gradient():
    """The parts of the risk against a plain sum over rows, and their gradients against small differences."""
    rnd = np.random.default_rng(4)
    p, u, w, prior = rnd.normal(size=(7, 4)), rnd.normal(size=(9, 4)), rnd.normal(size=4), 0.4
    plain = lambda w: (
        prior * sum(math.log(1 + math.exp(-float(x @ w))) for x in p) / len(p),
        sum(math.log(1 + math.exp(float(x @ w))) for x in u) / len(u) - prior * sum(math.log(1 + math.exp(float(x @ w))) for x in p) / len(p),
    )
    got = quality.risk_parts(w, p, u, prior)
    for k in (0, 1):
        assert abs(got[k] - plain(w)[k]) < 1e-9
        numeric = [(plain(w + e)[k] - plain(w - e)[k]) / 2e-6 for e in np.eye(4) * 1e-6]
        assert np.allclose(got[2 + k], numeric, atol=1e-6)


@pytest.mark.parametrize("prior", [0.3, 0.9])
def test_fit_minimises_the_non_negative_risk(prior):
    """No other weights on a grid around them, and none of many at random, have a clearly smaller risk. With a prior far too
    large the bracket would fall far below 0, and is held near it."""
    rnd = np.random.default_rng(5)
    positive = rnd.normal(1.0, 1.0, size=(300, 1))
    unlabelled = np.vstack([rnd.normal(1.0, 1.0, size=(150, 1)), rnd.normal(-1.0, 1.0, size=(350, 1))])
    (w, centre, scale), bias = quality.fit(positive, unlabelled, prior)
    squash = lambda x: np.column_stack([np.clip((x - centre) / scale, -6, 6), np.ones(len(x))])
    p, u = squash(positive), squash(unlabelled)

    def risk(v):
        up, bracket, _, _ = quality.risk_parts(np.array(v), p, u, prior)
        return up + max(0.0, bracket)

    if prior > 0.5:
        assert quality.risk_parts(np.array([w[0], bias]), p, u, prior)[1] > -0.05
        return
    own = risk([w[0], bias])
    grid = [(w[0] + a, bias + b) for a in np.linspace(-3, 3, 25) for b in np.linspace(-3, 3, 25)]
    assert own <= min(map(risk, [*grid, *rnd.normal(0, 3, size=(500, 2))])) + 0.02


def test_classifier(spark):
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice("aeiourstln") for _ in range(rnd.randrange(2, 8)))
    texts, truth = [], []
    for i in range(900):
        w = [word() for _ in range(rnd.randrange(30, 90))]
        junk = i % 6 == 0
        texts.append(" ".join(x + "###" for x in w) if junk and i % 12 else " ".join(w).upper() if junk else " ".join(w) + ".")
        truth.append(0 if junk else 1)
    texts += ODD
    df = docs_of(spark, texts)
    labels = spark.createDataFrame([(i, y, 0) for i, y in enumerate(truth) if i % 2 == 0] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    got = by_id(quality.classify(df, labels))
    assert len(got) == len(texts) and all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())
    held = [(got[i].predicted, y) for i, y in enumerate(truth) if got[i].held_out]
    assert sum(p == y for p, y in held) / len(held) > 0.95
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert {i: r.score for i, r in by_id(quality.classify(df, flipped)).items()} == {i: r.score for i, r in got.items()}
    kept = quality.keep(df, labels)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.predicted}
    none = by_id(quality.classify(df.limit(5), labels.limit(0)))
    assert {r.score for r in none.values()} == {0.5}
    assert quality.classify(df.limit(0), labels).count() == 0


# --- 6: personal data --------------------------------------------------------------------------------------------------

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute_pii(t):
    out = []
    for kind, p in PATTERNS.items():
        for m in re.finditer(p, t):
            d = re.sub("[^0-9]", "", m[0])
            fine = {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else True, "card": 12 <= len(d) <= 19 and pii.luhn(d), "phone": 9 <= len(d) <= 15}[kind]
            if fine:
                out.append((m.start(), m.end(), kind))
    return sorted(out, key=lambda s: (s[0], list(PATTERNS).index(s[2])))


@given(st.text("0123456789.@ +-()ab:%é", max_size=60))
@settings(max_examples=400, deadline=None)
def test_base_spans(t):
    assert [s for s in pii.find(t) if s[2] in pii.BASE] == brute_pii(t)


def test_added_spans():
    t = "See https://a.example/x?y=1. IBAN: DE89 3704 0044 0532 0130 00, Account no: 12-345678; fe80::1 and std::cout, IBAN DE00 0000"
    found = [(k, t[a:b]) for a, b, k in pii.find(t) if k not in pii.BASE]
    assert found == [("url", "https://a.example/x?y=1"), ("iban", "DE89 3704 0044 0532 0130 00"), ("account", "12-345678"), ("ipv6", "fe80::1")]


@pytest.mark.parametrize("cue", [*pii.CUES, "Account", "ACCT", "Tax ID", "TAX ID", "Passport No.", "Konto Nr", "Account number", "SSN no."])
def test_account_cues(cue):
    t = f"é İ so {cue}: 12-3456789, 12-3456789"
    assert [(t[a:b], k) for a, b, k in pii.find(t) if k not in pii.BASE] == [("12-3456789", "account")]


@pytest.mark.parametrize("shape", ['{} = "{}"', "{}: '{}'", "{}={}", '"{}": "{}",', "{} := {}", "X_{}={} and"])
def test_secrets(shape):
    key = "24be64a7c1d2e3f4a5b6c7d8e9f0a1b2c3d4e5f6"
    for cue in (*pii.KEYS, "Token", "API_KEY", "Secret"):
        t = f"öö {shape.format(cue, key)}"
        assert [(t[a:b], k) for a, b, k in pii.find(t) if k not in pii.BASE] == [(key, "secret")]
        t = shape.format(cue, "of-the-words-that-have-no-digit")
        assert not pii.find(t)
    for cue in (*pii.PASSWORDS, "Password"):
        t = shape.format(cue, "hunter.2!x")
        assert [(t[a:b], k) for a, b, k in pii.find(t)] == [("hunter.2!x", "secret")]
    assert pii.find("Authorization: Bearer " + key) == [(22, 62, "secret")]
    assert not [s for t in ("the token of 1999 was", "passwords: none", "a secret: no", "token ring = big") for s in pii.find(t)]


def test_personal_data(spark):
    t = "𝒳 mail a.b@c.example, card 4111 1111 1111 1111, call +1 (555) 010-9999 at 10.0.0.255 not 10.0.0.256"
    df = docs_of(spark, [t, *ODD])
    got = by_id(pii.personal_data(df))
    assert (got[0].n_email, got[0].n_ip, got[0].n_card, got[0].n_phone) == (1, 1, 1, 1)
    assert got[0].base_sha256 == hashlib.sha256(pii.joined(brute_pii(t)).encode()).hexdigest()
    assert got[1].spans == "" and got[1].base_sha256 == hashlib.sha256(b"").hexdigest()
    masked = pii.mask(df)
    assert masked.schema == df.schema
    assert by_id(masked)[0].text == "𝒳 mail [EMAIL], card [CARD], call [PHONE] at [IP] not 10.0.0.256"
    assert [by_id(masked)[i + 1].text for i in range(len(ODD))] == ODD
    assert pii.personal_data(df.limit(0)).count() == 0


# --- 7: long repeats ---------------------------------------------------------------------------------------------------


def brute_repeats(ids, texts):
    starts = {}
    for i, t in zip(ids, texts, strict=True):
        b = (t or "").encode()
        for k in range(len(b) - 49):
            w = b[k : k + 50]
            starts[w] = min(starts.get(w, math.inf), i)
    out = []
    for i, t in zip(ids, texts, strict=True):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - 49):
            if starts[b[k : k + 50]] < i:
                gone[k : k + 50] = b"\1" * 50
        runs = len(re.findall(b"\1+", bytes(gone)))
        out.append((i, len(b), sum(gone), runs, hashlib.sha256(bytes(c for c, g in zip(b, gone, strict=True) if not g)).hexdigest()))
    return sorted(out)


def test_minimisers_do_not_depend_on_the_slice():
    """A window in a short slice and in a long one has the same core, though its grams are found by part of their hash."""
    rnd = random.Random(5)
    window = bytes(rnd.choice(b"abc ") for _ in range(200))
    long = np.frombuffer(bytes(rnd.choice(b"xyz ") for _ in range(70_000)) + window, np.uint8)
    short = np.frombuffer(window, np.uint8)
    a, b = repeats.halves(short, np.array([0, len(short)])), repeats.halves(long, np.array([0, len(long)]))
    inside = b[0] >= 70_000
    assert set(a[2].tolist()) >= set(b[2][inside].tolist()) and inside.sum() > 3


@pytest.mark.parametrize("small", [False, True])
def test_long_repeats(spark, corpus, monkeypatch, small):
    if small:  # many shards and buckets
        for name in ("SHARD_BYTES", "BUCKET_BYTES", "GROUP_BYTES"):
            monkeypatch.setattr(repeats, name, 4000)
    corpus = [*corpus, " ".join(f"v{i * i % 977}" for i in range(25_000)), "head " + " ".join(f"v{i * i % 977}" for i in range(40))]
    base = corpus[0] or "z"
    extra = [base[:k] + "Q" + base[k:] for k in range(0, min(len(base), 300), 37)] + ["ab" * 200, "x" + "ab" * 100, "y" * 49, "y" * 50, "y" * 51]
    texts = [*corpus, *extra]
    got = repeats.long_repeats(docs_of(spark, texts))
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got.collect()) == brute_repeats(list(range(len(texts))), texts)


def test_long_repeats_null_and_repeated_ids(spark):
    t = "a passage of rather more than fifty bytes that stands in all of these"
    got = repeats.long_repeats(docs_of(spark, [t, t, t + " and on", t], [9, 9, 7, None]))
    assert sorted((r.doc_id or -1, r.n_removed) for r in got.collect()) == [(-1, len(t)), (7, 0), (9, len(t)), (9, len(t))]
    assert repeats.long_repeats(docs_of(spark, [t]).limit(0)).count() == 0


# --- 8: decontamination ------------------------------------------------------------------------------------------------


def brute_contamination(texts, items, width=13):
    find = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    windows = {}
    for item, t in items:
        w = find(t)
        k = min(width, len(w))
        for i in range(len(w) - k + 1 if k else 0):
            windows.setdefault(tuple(w[i : i + k]), set()).add(str(item))
    out = []
    for t in texts:
        w, hit, of = find(t), set(), set()
        for k in {len(x) for x in windows}:
            for i in range(len(w) - k + 1):
                if found := windows.get(tuple(w[i : i + k])):
                    hit |= set(range(i, i + k))
                    of |= found
        out.append((len(w), len(hit), len(of), hashlib.sha256(",".join(sorted(of)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return out


@pytest.mark.parametrize("block", [4_000_000, 150])
def test_contamination(spark, block):
    rnd = random.Random(5)
    vocabulary = ["Ab", "c9", "é", "dd", "e", "ß"]
    say = lambda n: rnd.choice([" ", ", ", "-"]).join(rnd.choice(vocabulary) for _ in range(n))
    items = [(k, say(rnd.choice([2, 13, 14, 20]))) for k in range(12)] + [(50, None), (51, "!!"), (2, say(15))]
    texts = [say(rnd.choice([1, 12, 30])) + rnd.choice(["", " " + items[rnd.randrange(12)][1].upper() + "; " + say(5)]) for _ in range(60)] + ODD
    df, bench = docs_of(spark, texts), spark.createDataFrame(items, "item_id long, text string")
    got = by_id(decontaminate.contamination(df, bench, block_bytes=block))
    assert [(got[i].n_words, got[i].n_hit, got[i].n_items, got[i].items_sha256, got[i].contaminated) for i in range(len(texts))] == brute_contamination(texts, items)
    for i, r in got.items():
        words = sum(len(decontaminate.words(texts[i][a:b])) for a, b in (map(int, s.split(":")) for s in r.hit_spans.split(",") if s))
        assert words == r.n_hit
    kept = decontaminate.clean(df, bench, block_bytes=block)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if not r.contaminated}
    assert not any(r.n_hit for r in decontaminate.contamination(df, bench.limit(0)).collect())


def test_items_without_id_contaminate(spark):
    docs = spark.createDataFrame([(1, "so one two three"), (2, "four five"), (3, "clean")], "doc_id long, text string")
    items = spark.createDataFrame([(None, "one two three"), (None, "four five"), (7, "four five")], "item_id long, text string")
    for block in (4_000_000, 10):
        got = {r.doc_id: (r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in decontaminate.contamination(docs, items, block_bytes=block).collect()}
        digest = lambda t: hashlib.sha256(t).hexdigest()
        assert got == {1: (3, 0, digest(b""), True), 2: (2, 1, digest(b"7"), True), 3: (0, 0, digest(b""), False)}
        assert [r.doc_id for r in decontaminate.clean(docs, items, block_bytes=block).collect()] == [3]


@given(st.data())
@settings(max_examples=60, deadline=None)
def test_machine_equals_brute_force(data):
    vocabulary = ["a", "b", "c", "dé"]
    say = lambda most: " ".join(data.draw(st.lists(st.sampled_from(vocabulary), max_size=most)))
    width = data.draw(st.integers(1, 7))
    items = [(str(i), say(14)) for i in range(data.draw(st.integers(0, 5)))]
    texts = [say(40) for _ in range(data.draw(st.integers(1, 5)))]
    machine = decontaminate.Machine(items, width)
    (_, _, hashes, bounds), *_ = decontaminate._hashed(pa.array(texts))
    hit, pairs = machine.find(hashes, bounds)
    for i, t in enumerate(texts):
        w = decontaminate.words(t)
        want, which = set(), set()
        for j, (_, item) in enumerate(items):
            v = decontaminate.words(item)
            k = min(width, len(v))
            for x in range(len(v) - k + 1 if k else 0):
                for y in range(len(w) - k + 1):
                    if w[y : y + k] == v[x : x + k]:
                        want |= set(range(y, y + k))
                        which.add(j)
        assert set(np.flatnonzero(hit[bounds[i] : bounds[i + 1]]).tolist()) == want
        assert set(pairs[pairs[:, 0] == i, 1].tolist()) == which


def test_long_texts_are_scanned_whole(spark):
    item = " ".join(f"w{i % 700}" for i in range(3_000))
    text = "odd " * 20_000 + item + " odd" * 5_000 + " " + item[:200]
    got = by_id(decontaminate.contamination(docs_of(spark, [text, "odd"]), spark.createDataFrame([("1", item)], "item_id string, text string")))
    assert (got[0].n_words, got[0].n_items, got[1].n_hit) == (len(text.split()), 1, 0)
    assert got[0].n_hit == 3_000 + len(item[:200].split(" ")) - (item[200] != " ")


def test_clean_takes_clashing_names(spark):
    df = docs_of(spark, ["so one two three", "clean"]).withColumn("hit_words", F.lit(1)).withColumn("hit_items", F.lit("x"))
    assert [r.doc_id for r in decontaminate.clean(df, spark.createDataFrame([("1", "one two three")], "item_id string, text string")).collect()] == [1]


# --- 9: lines, sentences and paragraphs --------------------------------------------------------------------------------


def brute_spans(t, level, least):
    spans, at = [], 0
    for line in t.split("\n"):
        spans.append((at, at + len(line)))
        at += len(line) + 1
    if level == "paragraph":
        joined, open_ = [], False
        for a, b in spans:
            full = bool(WORD.search(t[a:b]))
            if full and open_:
                joined[-1] = (joined[-1][0], b)
            elif full:
                joined.append((a, b))
            open_ = full
        spans = joined
    if level == "sentence":
        cut = []
        for a, b in spans:
            units, start = [], a
            for m in WORD.finditer(t, a, b):
                after = re.compile(r"[\x20\x09-\x0D]*").match(t, m.end(), b).end()
                if m[0][-1] in ".!?" or after == b:
                    units.append([start, after])
                    start = after
            i = 0
            while i < len(units) - 1:  # short sentences go with the next one
                if sum(1 for _ in WORD.finditer(t, *units[i][-2:])) < least:
                    units[i + 1] = [units[i][0], *units[i + 1]]
                    del units[i]
                else:
                    i += 1
            if len(units) > 1 and sum(1 for _ in WORD.finditer(t, *units[-1][-2:])) < least:
                units[-2:] = [[units[-2][0], units[-1][-1]]]
            cut += [(u[0], u[-1]) for u in units]
        spans = cut
    return [(a, b) for a, b in spans if WORD.search(t[a:b])]


def brute_units(ids, texts, level="sentence", least=8):
    units, out = [], {}
    for i, t in sorted(zip(ids, texts, strict=True), key=lambda x: x[0]):
        t = t or ""
        spans = brute_spans(t, level, least)
        out[i] = [len(spans), []]
        units += [(tuple(WORD.findall(t[a:b].translate(LOWER))), i, a, b) for a, b in spans]
    seen = set()
    for w, i, a, b in units:
        if w in seen:
            out[i][1].append(f"{a}:{b}")
        seen.add(w)
    return {i: (n, len(s), ",".join(s)) for i, (n, s) in out.items()}


LINES = ["é one  two three FOUR five\n\n a b c d e f\nshort\n\n\nONE é two three four five", "a b c d e f\nshort\n\none é two three four five", "\nx y z v w\n\n\nx y  z v w\n", "All rights reserved.\nhttps://a.example/x\nown", "all  RIGHTS reserved.\nhttps://a.example/x\n東京都\n東京都"]


@pytest.mark.parametrize("level", lines.LEVELS)
def test_repeated_units(spark, corpus, level):
    rnd = random.Random(2)
    stops = lambda t: "".join(rnd.choice([". ", "! ", ".  ", " ", " "]) if c == " " else c for c in t)
    texts = [*corpus, *LINES, *map(stops, [t for t in corpus if t][:40]), "w " * 25_000 + "end. " + "v " * 9]
    texts += [t and "Odd start of it " + t[5:] for t in texts[-41:]]
    got = by_id(lines.repeated_units(docs_of(spark, texts), level=level))
    want = brute_units(range(len(texts)), texts, level)
    assert {i: (r.n_units, r.n_removed, r.removed) for i, r in got.items()} == want
    assert sum(n for _, n, _ in want.values()) > 20
    assert lines.repeated_units(docs_of(spark, ["x"]).limit(0)).count() == 0


def test_hot_units_are_broadcast(spark, corpus, monkeypatch):
    monkeypatch.setattr(work, "HOT_LEAST", 1)
    texts = [*corpus, *[f"the same line in all of them\nown {i}" for i in range(300)]]
    monkeypatch.setattr(work, "HOT_SHARE", 100)
    got = by_id(lines.repeated_units(docs_of(spark, texts)))
    assert {i: (r.n_units, r.n_removed, r.removed) for i, r in got.items()} == brute_units(range(len(texts)), texts)


def test_passages_inside_lines_are_found(spark):
    inner = " ".join(f"word{i}" for i in range(30)) + ". " + " ".join(f"more{i}" for i in range(30)) + ". end"  # a short end goes with the sentence before it, so that one differs
    inner = " ".join(f"first{i}" for i in range(30)) + ". " + inner
    got = by_id(lines.repeated_units(docs_of(spark, [f"begins here {inner} so.", f"Quite {inner} other"])))
    assert got[0].n_removed == 0 and got[1].n_removed == 1 and got[1].chars_removed > 150


def test_without():
    assert lines.without("a\nb\nc", "2:3") == "a\nc"
    assert lines.without("One. Two. Three.\nc", "5:10,10:16") == "One. \nc"
    assert lines.without("a. b.\nc", "0:3,3:5") == "c"


def test_repeated_units_null_ids(spark):
    t = "five words or more here"
    got = lines.repeated_units(docs_of(spark, [t, t, t + "\n" + t, None, "other"], [None, 4, 4, None, None])).collect()
    assert sorted((r.doc_id or -1, r.n_units, r.n_removed) for r in got)[:3] == [(-1, 0, 0), (-1, 1, 0), (-1, 1, 1)]
    four = sorted((r.n_units, r.n_removed) for r in got if r.doc_id == 4)
    assert four in ([(1, 0), (2, 2)], [(1, 1), (2, 1)])


# --- 10: chat ----------------------------------------------------------------------------------------------------------


def test_chat(spark):
    rnd = random.Random(6)
    chats = {}
    for c in range(40):
        base = chats[rnd.randrange(c)] if c and rnd.random() < 0.6 else []
        chats[c] = base[: rnd.randrange(1, len(base) + 1) if base else 0] + [(rnd.choice(["user", "assistant", None]), rnd.choice(["hi", "yo", "", None])) for _ in range(rnd.randrange(0 if base else 1, 4))]
    rows = [(c, 10 + 3 * k, r, t, "x") for c, turns in chats.items() for k, (r, t) in enumerate(turns)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, pos string")
    got = {r.conv_id: (r.n_turns, r.n_copies, r.text) for r in chat.chat(df).collect()}
    want = {}
    for c, turns in chats.items():
        same = [k for k, t in chats.items() if t == turns]
        if c == min(same) and not any(len(t) > len(turns) and t[: len(turns)] == turns for t in chats.values()):
            want[c] = (len(turns), len(same), "".join(f"<|im_start|>{r or ''}\n{t or ''}<|im_end|>\n" for r, t in turns))
    assert got == want and len(want) < 40
    assert chat.chat(df.limit(0)).count() == 0
    null = spark.createDataFrame([(None, 1, "user", "a"), (None, 2, "user", "b"), (1, 1, "user", "a")], "conv_id long, turn long, role string, text string")
    assert [(r.conv_id, r.n_turns) for r in chat.chat(null).collect()] == [(None, 2)]


# --- queries and pipeline ----------------------------------------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, sf_dir, name):
    from compare import oracle, rows

    assert rows(queries.QUERIES[name](spark, sf_dir).toPandas()) == rows(oracle(sf_dir, queries.ORACLE_SQL[name]))


def test_pipeline(spark, sf_dir):
    """Each stage against brute force on what its predecessor kept."""
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    bench = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        docs = stage(spark, docs, sf_dir)
        after = {r.doc_id: r for r in docs.collect()}
        if name == "quality":
            labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
            told = [i for i in before if i in labels]
            assert sum((i in after) == bool(labels[i]) for i in told) / len(told) > 0.95
        elif name == "near_dedup":
            near = brute_near(list(before), [r.text for r in before.values()], percent=80)
            assert set(after) == {i for i, (_, _, kept) in near.items() if kept}
        elif name == "decontamination":
            dirty = brute_contamination([r.text for r in before.values()], bench)
            assert set(after) == {i for i, x in zip(before, dirty, strict=True) if not x[4]}
        elif name == "pii":
            assert set(after) == set(before) and all(r.n_chars == len(r.text) for r in after.values())
            assert not any(brute_pii(r.text) for r in after.values())
        else:
            assert set(after) == set(before)
        if name != "packing":
            assert docs.columns == columns
    from folioframe.shared import shared_dir

    before = set(os.listdir(shared_dir(spark)))
    assert {r.doc_id for r in corpus_pipeline.run(spark, sf_dir).collect()} == set(after)
    left = {n.rsplit("-", 1)[0] for n in set(os.listdir(shared_dir(spark))) - before}
    assert left == {"stage-pii", "pieces"}  # what the result still reads


# --- long secrets, many shards ---------------------------------------------------------------------------------------


@pytest.mark.parametrize("n", [600, 5_000, 40_000])
def test_secrets_of_any_length(n):
    body = ("Ab3_-" * n)[:n]
    for text in (f"api_key = {body} end", f'token: "{body}" end', f"password='{body}' end", f"pwd={body}, end", f"Authorization: Bearer {body} end"):
        spans = pii.find(text)
        at = text.index(body)
        assert (at, at + n, "secret") in spans
        assert body[:20] not in pii.masked(text, spans) and body[-20:] not in pii.masked(text, spans)


def test_many_cues_in_one_value():
    """Cues inside a value that is none are judged by what follows them, and the value is read once."""
    began = time.time()
    assert not [s for s in pii.find("token=" * 200_000) if s[2] == "secret"]
    assert time.time() - began < 10
    text = "token=é-" * 1000 + "token=" + "x" * 30 + "7."
    assert [(s[0], text[s[0] : s[1]]) for s in pii.find(text) if s[2] == "secret"] == [(len(text) - 32, "x" * 30 + "7")]


def test_shuffled_cores_do_not_grow_with_shards():
    rnd = random.Random(5)
    texts = [" ".join("".join(rnd.choice("abcdefghij") for _ in range(rnd.randrange(2, 9))) for _ in range(rnd.choice([100, 500, 900]))) for _ in range(1500)]
    batch = pa.RecordBatch.from_arrays([pa.array(rnd.sample(range(10**9), len(texts)), pa.int64()), pa.array(texts, pa.string())], ["rank", "text"])
    size = {n: sum(len(x.as_py()) for b in repeats._cores(iter([batch]), n) for c in ("cores", "near", "owner", "ranks") for x in b.column(c)) for n in (100, 10_000)}
    assert size[10_000] < 1.2 * size[100]
