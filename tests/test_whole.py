"""Queries take all of their input."""

import hashlib
import random
import re
from itertools import combinations

import pytest

from folioframe.functions import similarity
from folioframe.operators import resolve
from folioframe.plans import queries
from folioframe.sources.corpus_view import Corpus


def test_pages_hold_the_whole_text(spark):
    texts = ["", "é𝒳\n" * 400, "y" * 1000, "x" * 3500 + "end", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, full_text string")
    got = {r.id: (r.digest, r.n_chars) for r in queries.page_marked_texts(spark, {"texts": df}).collect()}
    for i, t in enumerate(texts):
        t = t or ""
        want = "".join(f"\n--- Page {p + 1} ---\n{t[p * 1000 : p * 1000 + 1000]}" for p in range(max(1, -(-len(t) // 1000))))
        assert got[i] == (hashlib.md5(want.encode()).hexdigest(), len(want))


def test_letters_are_searched_whole(spark, sf_dir, tmp_path, monkeypatch):
    texts = ["z" * 48 + "bolt", "z" * 148 + "bolt", "z" * 900 + "Bolt", "z" * 900, "bolt", None]
    turns = [(1, i, "clerk", t) for i, t in enumerate(texts)]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    letters = Corpus.from_star(spark, str(tmp_path))["correspondence"]
    docs = spark.createDataFrame([(1, "a.pdf", None)], "id long, file_name string, display_title string")
    found = queries.search.search_facts(letters, docs, "bolt", queries.search.SEARCHES["correspondence"])
    assert [r.id for r in found.collect()] == [1000, 1001, 1002, 1004]
    c = Corpus.from_star(spark, sf_dir)
    c.tables["correspondence"] = letters
    c.tables["documents"] = spark.createDataFrame([(1, "a.pdf", None)], c["documents"].select("id", "file_name", "display_title").schema)
    seen = {}
    monkeypatch.setattr(queries.discovery, "evidence_counts", seen.update)
    queries.discovery_evidence(spark, c)
    assert seen["correspondence"].count() == 4


def brute_pairs(entities, links, threshold=None):
    """Scores of all pairs of (id, type, norm, block) rows that pass the constraints of their types."""
    want = {}
    for a, b in combinations(sorted(entities, key=lambda r: r.id), 2):
        if (a.type, a.block) != (b.type, b.block) or a.block is None or a.norm == b.norm:
            continue
        ratio = similarity.indel_percent(a.norm, b.norm) / 100
        tokens = similarity.indel_percent(similarity.sorted_tokens(a.norm), similarity.sorted_tokens(b.norm)) / 100
        last, first = ([similarity.metaphone(r.norm.split(" ")[at]) for r in (a, b)] for at in (-1, 0))
        both = min(len(r.norm.split(" ")) for r in (a, b)) > 1
        phonetic = 0.0 if a.type != "person" or last[0] != last[1] else 0.5 if both and first[0] != first[1] else 1.0
        shared = len({d for i, d in links if i == a.id} & {d for i, d in links if i == b.id})
        score = 0.4 * ratio + 0.3 * tokens + 0.2 * phonetic + 0.1 * min(shared / 2, 1)
        numbers = [re.findall(r"\d+", r.norm) for r in (a, b)]
        fits = {"person": last[0] == last[1] or ratio >= 0.92, "land_parcel": set(numbers[0]) == set(numbers[1]), "legislation": numbers[0] == numbers[1]}.get(a.type, True)
        if fits and score >= (threshold or resolve.THRESHOLDS.get(a.type, 0.9)):
            want[a.id, b.id] = round(score, 6)
    return want


def keyed(entities):
    norms = entities.where("length(name) >= 5").select("id", "type", resolve.normalised(queries.F.col("name"), queries.F.col("type")).alias("norm"))
    return norms.withColumn("block", resolve.block_key(queries.F.col("norm"), queries.F.col("type"))).collect()


def test_fuzzy_takes_the_names_of_the_table(spark):
    names = ["William Harrington Smith", "Wm. Harrington Smithe", "Willam Harrington Smith", "Harrington William Smith", "é" * 12 + " Smyth", "é" * 11 + "e Smyth", "Ann Lee Smith"]
    names += [f"Customer#{n:09d}" for n in (1, 2, 10, 12, 21, 111111111, 111111112)] + ["Customer Customer Bellingham", "Customer Custommer Bellingham"]
    rows = [(i, n, "person", None) for i, n in enumerate(names)] + [(90, "Northern Land Bank", "organization", None), (91, "Northern Land Banks", "organization", None)]
    entities = spark.createDataFrame(rows, "id long, name string, type string, context string")
    links = [(i, d) for i in (0, 1, 3, 7, 8, 9, 10, 90, 91) for d in (1, 2)] + [(11, 2)]
    mentions = spark.createDataFrame(links, "entity_id long, document_id long")
    docs = spark.createDataFrame([(1, "a.pdf"), (2, "b.pdf")], "id long, file_name string")
    want = brute_pairs(keyed(entities), links)
    c = {"entities": entities, "mentions": mentions, "documents": docs}
    got = {(r.id_a, r.id_b): r.score for r in queries.fuzzy_candidates(spark, c).collect()}
    assert got == want and {(0, 1), (7, 8)} <= set(got)
    assert {(r.id_a, r.id_b) for r in queries.fuzzy_review(spark, c).collect()} == set(want)


@pytest.mark.parametrize("threshold", [None, 0.82, 0.9, 0.74, 0.6, 0.5])
def test_fuzzy_pairs_are_those_of_all_pairs(spark, threshold):
    """Every type with its constraints, names with random edits, few and many common documents."""
    rnd = random.Random(11)
    bases = ["alexandrina wilhelmina montgomery", "john smith", "customer#000012345", "maria del carmen fernandez y lopez de la vega", "o brien", "aaaaaaaaaa aaaaaaaaaa"]
    rows = []
    for k in range(110):
        name = list(rnd.choice(bases))
        for _ in range(rnd.choice([0, 1, 1, 2, 3])):
            at = rnd.randrange(len(name))
            name[at : at + rnd.choice([0, 1, 1])] = rnd.choice(["", "a", "n", "7"])
        rows.append((k, "".join(name), "person", None))
    land = ["Allotment No. 12", "allotment # 12", "Allotment 12 north", "Allotment 21", "Sec. 4 Twp. 9", "section 4 township 9", "section 9 township 4"]
    law = ["H.R. 1234", "HR 1234 an act", "h. r. 1234", "H.R. 1243", "S. 77", "S 77 of 1920", "The S. 77"]
    rows += [(200 + i, n, "land_parcel", None) for i, n in enumerate(land)] + [(300 + i, n, "legislation", None) for i, n in enumerate(law)]
    rows += [(400 + i, n, "organization", None) for i, n in enumerate(["Northern Land Bank", "Northern Land Banks", "The Northern Bank of Land", "Southern Land Bank"])]
    entities = spark.createDataFrame(rows, "id long, name string, type string, context string")
    links = sorted({(i, rnd.randrange(8)) for i, *_ in rows for _ in range(rnd.choice([0, 1, 1, 2]))})
    mentions = spark.createDataFrame(links, "entity_id long, document_id long")
    got = {(r.id_a, r.id_b): round(r.score, 6) for r in resolve.fuzzy_candidates(entities, mentions, threshold=threshold).collect()}
    assert got == brute_pairs(keyed(entities), links, threshold)
    assert len(got) > 10


def test_all_rows_are_offered(spark, sf_dir):
    c = Corpus.from_star(spark, sf_dir)
    docs = c["documents"].select("id", "file_name").collect()
    ids = {r.file_name: r.id for r in queries.id_assignment(spark, c).collect()}
    assert ids == {n: 1001 + i for i, n in enumerate(sorted(r.file_name for r in docs))}
    assert {r.file_name for r in queries.skip_processed(spark, c).collect()} == {r.file_name for r in docs if r.id % 2}
    assert queries.mention_upsert(spark, c).count() >= c["mentions"].where("document_id % 4 <> 0").count() > 0
    names = {(r.name, r.type) for r in queries.entity_find_or_create(spark, c).collect()}
    assert {(r.name, r.type) for r in c["entities"].where("id % 2 = 0").collect()} <= names


@pytest.mark.parametrize("least", [0.5, 0.6, 0.75, 0.9, 0.95])
def test_similar_pairs_lose_none(spark, least):
    """All pairs of a group with the ratio are among those that meet, whatever repeats in the names."""
    rnd = random.Random(int(least * 100))
    bases = ["aaaaaaaaaaaa", "abababab", "customer#000000123", "the northern land and cattle company", "x", "lee", "é𝒳é𝒳é𝒳"]
    rows = []
    for k in range(160):
        name = list(rnd.choice(bases))
        for _ in range(rnd.choice([0, 1, 2, 4, 8])):
            at = rnd.randrange(len(name) + 1)
            name[at : at + rnd.choice([0, 1, 2])] = rnd.choice(["", "a", "b", "0"])
        rows.append((k, "".join(name), k % 2))
    names = spark.createDataFrame(rows, "id long, norm string, side int")
    got = {tuple(r) for r in resolve.similar_pairs(names, least, ["side"]).collect()}
    want = {(a[0], b[0]) for a, b in combinations(rows, 2) if a[2] == b[2] and a[1] != b[1] and similarity.indel_percent(a[1], b[1]) / 100 >= least and a[1] and b[1]}
    assert not want - got, sorted((rows[a][1], rows[b][1]) for a, b in want - got)[:5]
    assert len(want) > 5
    assert all(a < b and a % 2 == b % 2 for a, b in got)
