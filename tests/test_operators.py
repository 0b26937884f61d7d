import random

import pytest
from pyspark.sql import functions as F

from folioframe.functions import json_text
from folioframe.operators import chunking, citations, context, documents, export, fulltext, load, merge, resolve, retrieval, search
from folioframe.plans import ingest, ledger
from folioframe.schemas import TABLES, extraction_struct
from folioframe.sources import catalog, files, manifest


def table(spark, name, *rows):
    fields = TABLES[name].fieldNames()
    return spark.createDataFrame([tuple(r.get(f) for f in fields) for r in rows], TABLES[name])


def brute_chunks(t, size, overlap, tail):
    out, start = [], 0
    while start < len(t):
        out.append((start, min(len(t), start + size)))
        if not tail and start + size >= len(t):
            break
        start += size - overlap
    return out


@pytest.mark.parametrize("tail", [False, True])
def test_chunks(spark, tail):
    texts = [("x" * n) for n in (0, 1, 9, 10, 11, 16, 17, 18, 40, 41)] + ["é𝒳" * 13, None]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, full_text string")
    got = {}
    for r in chunking.chunk_offsets(df, 10, 3, tail).collect():
        got.setdefault(r.id, []).append((r.start, r.end))
    cut = {}
    for r in chunking.chunks(df, 10, 3, tail).orderBy("id", "chunk").collect():
        cut.setdefault(r.id, []).append(r.text)
    for i, t in enumerate(texts):
        want = brute_chunks(t or "", 10, 3, tail)
        assert sorted(got.get(i, [])) == want
        assert cut.get(i, []) == [t[a:b] for a, b in want]


def test_search_drops_orphans_and_orders_nulls_last(spark):
    docs = table(spark, "documents", {"id": 1, "file_name": "a.pdf"})
    events = table(spark, "events", {"id": 1, "document_id": 1, "type": "sale"}, {"id": 2, "document_id": 1, "type": "Sale", "date": "1909"}, {"id": 3, "type": "sale"}, {"id": 4, "document_id": 9, "type": "sale"}, {"id": 5, "document_id": 1, "type": "other", "location": "s_le"})
    got = search.search_facts(events, docs, "sale", search.SEARCHES["events"]).select("id").collect()
    assert [r.id for r in got] == [2, 1]
    assert [r.id for r in search.search_facts(events, docs, "s_le", search.SEARCHES["events"]).collect()] == [2, 1, 5]


def test_entity_search_scores(spark):
    docs = table(spark, "documents", {"id": 1, "file_name": "a.pdf", "display_title": "A"}, {"id": 2, "file_name": "b.pdf"})
    ents = table(spark, "entities", {"id": 1, "name": "Bolt", "type": "person"}, {"id": 2, "name": "bolt co", "type": "organization"}, {"id": 3, "name": "x", "type": "person", "context": "a bolt"})
    ments = table(spark, "mentions", {"id": 1, "entity_id": 1, "document_id": 1}, {"id": 2, "entity_id": 1, "document_id": 2}, {"id": 3, "entity_id": 3, "document_id": 2})
    got = search.search_entities(ents, ments, docs, "bolt").collect()
    assert [(r.id, r.relevance_score, r.source_files) for r in got] == [(1, 1002, ["A", "b.pdf"]), (2, 500, []), (3, 1, ["b.pdf"])]
    assert search.network_candidates(search.search_entities(ents, ments, docs, "bolt")) == ["Bolt"]


def test_network_counts_other_spellings(spark):
    ents = table(spark, "entities", {"id": 1, "name": "Ann", "type": "person"}, {"id": 2, "name": "ann b", "type": "person"}, {"id": 3, "name": "Co", "type": "organization"})
    ments = table(spark, "mentions", *[{"id": i, "entity_id": e, "document_id": d} for i, (e, d) in enumerate([(1, 1), (2, 1), (3, 1), (1, 2), (3, 2), (3, 3)])])
    got = {(r.entity_id, r.shared_docs) for r in search.entity_network(ents, ments, ["ann"]).collect()}
    assert got == {(3, 2), (1, 1), (2, 1)}


def test_passages(spark):
    para = "The quick land sale was recorded here today. " * 2
    t = "Intro paragraph without it.\n\n" + para + "\n\n\n\nOutro land.\n \nland land land land land land land land sold in lots"
    df = spark.createDataFrame([(1, t), (2, None), (3, "")], "id long, full_text string")
    got = {r.id: r.p for r in df.select("id", retrieval.passages(F.col("full_text"), ["land"], 500, 2).alias("p")).collect()}
    assert [p.score for p in got[1]] == [8, 2]
    assert got[1][1].text == "Intro paragraph without it.\n\n" + para.strip() + "\n\nOutro land."
    assert not got[2] and got[3] == []
    cut = df.select(retrieval.passages(F.col("full_text"), ["sale"], 20, 2).alias("p")).first().p
    assert cut[0].text.startswith("...") and cut[0].text.endswith("...") and len(cut[0].text) == 46


@pytest.mark.parametrize("q,hit", [("land sale", True), ('"land sale"', False), ('"sale land"', True), ("land -sale", False), ("nothing or land", True), ("the", False), ("", False)])
def test_web_query(spark, q, hit):
    df = retrieval.with_tokens(spark.createDataFrame([("A sale, land the acres",)], "full_text string"))
    assert df.select(retrieval.match(F.col("tokens"), q)).first()[0] is hit


def test_cover_density(spark):
    df = retrieval.with_tokens(spark.createDataFrame([("a1 b1 x a1 x x b1",), ("x",), (None,)], "full_text string"))
    got = [r[0] for r in df.select(retrieval.rank(F.col("tokens"), "a1 b1")).collect()]
    r = 0.1 + 0.1 / 2 + 0.1 / 3
    assert got[0] == pytest.approx(r / (r + 1)) and got[1:] == [0, 0]


@pytest.mark.parametrize("q,ids", [("sold lands", [1, 3]), ('"land sales"', [1]), ('"sale of the land"', [3]), ("land -sale", [2]), ("-land", [4, 5]), ("nothing or selling", [2]), ("the", []), ("", []), ("-land or sell", [2, 4, 5])])
def test_stemmed_query(spark, q, ids):
    texts = spark.createDataFrame([(1, "Land sales, sold"), (2, "The lands sell"), (3, "A sale of the LAND was sold"), (4, ""), (5, None)], "id long, full_text string").withColumn("hits", F.lit("own"))
    places = fulltext.occurrences(texts)
    for given in ({}, {"places": places, "stems": fulltext.stem_table(places)}):
        got = retrieval.matched(texts, q, stemmed=True, **given)
        assert sorted(r.id for r in got.collect()) == ids and got.columns == ["id", "full_text", "hits", "fts"]
        assert all(r.fts >= 0 for r in got.collect())


def test_native_cover_density_equals_all_stretches(spark):
    """Against a plain walk over the words."""
    rnd = random.Random(6)
    said = [[rnd.choice("abcxyz") for _ in range(rnd.randrange(0, 30))] for _ in range(200)]

    def brute(words):
        at = [(i, t) for i, t in enumerate(words) if t in "abc"]
        need, total, last, held = {t for _, t in at}, 0.0, {}, -1
        for i, t in at:
            last[t] = i
            if len(last) == len(need) and min(last.values()) > held:
                held = min(last.values())
                total += 0.1 / (1 + (i - held) - (len(need) - 1))
        return total / (total + 1)

    df = spark.createDataFrame([(i, [x * 2 for x in w]) for i, w in enumerate(said)], "id int, t array<string>").select("id", retrieval.rank(F.col("t"), "aa bb cc").alias("r"))
    assert {r.id: round(r.r, 9) for r in df.collect()} == {i: round(brute(w), 9) for i, w in enumerate(said)}


def item(**kw):
    return {"chunk": 0, "pos": 0} | kw


def test_merge_nulls_count_as_empty(spark):
    rows = spark.createDataFrame([(1, 0, 0, "A", None, None), (1, 0, 1, " a ", "", ""), (1, 1, 0, "b", None, None)], "document_id long, chunk int, pos int, allottee string, allotment_number string, patent_date string")
    assert sorted((r.chunk, r.pos) for r in merge.first_of_equal(rows, "fee_patents").collect()) == [(0, 0), (1, 0)]


def test_merged_entities(spark):
    schema = "document_id long, chunk int, pos int, type string, name string, context string, acres string, land_type string"
    rows = spark.createDataFrame([(1, 0, 0, "person", " Ann ", "x", "5", None), (1, 0, 1, "person", "ANN", "y", None, None), (1, 1, 0, "person", "ann", "x", None, None), (1, 1, 1, None, "Bob", None, None, None), (1, 1, 2, "person", " ", "z", None, None), (2, 0, 0, "acreage_holding", "lot", "", "40", "farm")], schema)
    got = [tuple(r) for r in merge.merged_entities(rows).orderBy("document_id", "seq").collect()]
    assert got == [(1, 1, "person", "Ann", "x; y", None, None), (1, 2, None, "Bob", "Mentioned in document", None, None), (2, 1, "acreage_holding", "lot", "Mentioned in document", "40", "farm")]


def test_concatenated_keeps_equal_items(spark):
    from folioframe.functions.json_text import parsed

    df = spark.createDataFrame([(1, 0, '{"events":[{"type":"a"}]}'), (1, 1, '{"events":[{"type":"a"},{"type":"b"}]}')], "document_id long, chunk int, reply string")
    got = merge.concatenated(parsed(df, groups=["events"]), ["events"]).first()
    assert [e.type for e in got.events] == ["a", "a", "b"]


def test_upsert_folds_contexts(spark):
    old = spark.createDataFrame([(7, "Ann", "person", "first", "1", None)], "id long, name string, type string, context string, acres string, land_type string")
    new = spark.createDataFrame([(1, "Ann", "person", "second", "2", "farm"), (2, "Ann", "person", "first", None, None), (3, "ann", "person", None, None, None), (4, "", "person", "x", None, None)], "seq long, name string, type string, context string, acres string, land_type string")
    got = {r.id: tuple(r)[1:] for r in load.upserted_entities(old, new, "merge").collect()}
    assert got == {7: ("Ann", "person", "first; second", "2", "farm"), 8: ("ann", "person", None, None, None)}
    assert {r.id: r.context for r in load.upserted_entities(old, new, "first").collect()}[7] == "first"
    assert {r.id: r.context for r in load.upserted_entities(old, new, "last").collect()}[7] == "first"


def test_ids_are_dense(spark):
    df = spark.range(500).select((F.col("id") % 97).alias("k"), F.col("id").alias("v"))
    got = [tuple(r) for r in load.with_ids(df, ["k", "v"], 10).orderBy("id").select("id", "k", "v").collect()]
    assert [g[0] for g in got] == list(range(11, 511)) and [g[1:] for g in got] == sorted(g[1:] for g in got)
    assert load.with_ids(df.limit(0), ["k"]).count() == 0


def test_fact_rows_by_flow(spark):
    rows = spark.createDataFrame([(1, "hr 1", None, "1909", "x"), (1, "", "passed", None, "y")], "document_id long, bill_number string, action_type string, date string, outcome string")
    assert load.fact_rows(rows, "legislative_actions").count() == 0
    got = [(r.bill_number, r.action_type, r.action_date) for r in load.fact_rows(rows, "legislative_actions", "loader").collect()]
    assert got == [("hr 1", "unknown", "1909"), ("unknown", "passed", None)]
    assert load.fact_rows(rows, "legislative_actions", "loader", blank_action=True).first().action_type == ""
    money = spark.createDataFrame([(1, "5", "for tax")], "document_id long, amount string, description string").withColumn("context", F.lit(None).cast("string")).withColumn("for_what", F.lit(None).cast("string"))
    assert load.fact_rows(money, "financial_transactions", "loader").first().context == "for tax"
    ev = spark.createDataFrame([(1, ["a"]), (1, None)], "document_id long, entities_involved array<string>").withColumn("type", F.lit("t"))
    assert [r.metadata for r in load.fact_rows(ev, "events").collect()] == ['["a"]', "[]"]
    assert load.fact_rows(ev, "events", "upload").first().metadata == '{"entities_involved":["a"]}'


@pytest.mark.parametrize("name,key", [("General Land Office", "land office"), ("rev. dr. smith", "dr. smith"), (" Mr. Lee ", "lee"), ("MRS LEE", "lee"), ("", "")])
def test_canonical(spark, name, key):
    assert spark.createDataFrame([(name,)], "n string").select(resolve.canonical(F.col("n"))).first()[0] == key


@pytest.mark.parametrize(
    "name,kind,key,block",
    [("Chas. Lee, Jr.", "person", "charles lee jr", "j"), ("Allotment No. 22", "land_parcel", "allotment 22", "allotment"), ("north half", "land_parcel", "rth half", "rth"), ("The H. R. 12", "legislation", "hr 12", "hr"), ("Bank of Mt. Olive", "location", "bank of mount olive", "bank"), ("St. Paul", "location", "st paul", "paul"), (",.", "person", "", None)],
)
def test_normalised(spark, name, kind, key, block):
    df = spark.createDataFrame([(name, kind)], "n string, k string").withColumn("x", resolve.normalised(F.col("n"), F.col("k")))
    assert tuple(df.select("x", resolve.block_key(F.col("x"), F.col("k"))).first()) == (key, block)


def test_exact_resolution(spark):
    ents = table(spark, "entities", {"id": 1, "name": "ANN LEE", "type": "person", "context": "a", "acres": ""}, {"id": 2, "name": "Mrs. Ann Lee", "type": "person", "context": "b", "acres": "3"}, {"id": 3, "name": "Ann Lee", "type": "person", "context": "ab", "acres": "4"}, {"id": 4, "name": "Ann Lee", "type": "location"})
    ments = table(spark, "mentions", {"id": 1, "entity_id": 1, "document_id": 1, "context": "m1"}, {"id": 2, "entity_id": 2, "document_id": 1, "context": "m2"}, {"id": 3, "entity_id": 3, "document_id": 2}, {"id": 4, "entity_id": 1, "document_id": 5})
    groups = resolve.duplicate_groups(ents, ments)
    assert [tuple(r) for r in groups.collect()] == [("person", "ann lee", 3, 4, 1, "ANN LEE")]
    m = resolve.exact_id_map(ents, groups)
    got = {(r.entity_id, r.document_id): r.context for r in resolve.merged_mentions(ments, m).collect()}
    assert got == {(1, 1): "m1; m2", (1, 2): None, (1, 5): None}
    one = {r.id: r for r in resolve.merged_entities(ents, m).collect()}
    assert set(one) == {1, 4} and (one[1].context, one[1].acres) == ("a; b; ab", "4")


def test_fuzzy_only_persons_by_default(spark):
    names = [("William Harrington Smith", "person"), ("Wm. Harrington Smithe", "person"), ("Northern Land Bank", "organization"), ("Northern Land Banks", "organization"), ("Lee", "person")]
    ents = table(spark, "entities", *[{"id": i, "name": n, "type": t} for i, (n, t) in enumerate(names)])
    ments = table(spark, "mentions", *[{"id": 10 * i + d, "entity_id": i, "document_id": d} for i in range(4) for d in (1, 2)])
    got = resolve.fuzzy_candidates(ents, ments).collect()
    assert [(r.id_a, r.id_b, r.shared_docs, r.phonetic) for r in got] == [(0, 1, 2, 1.0)]
    assert got[0].score == pytest.approx(0.4 * got[0].ratio + 0.3 * got[0].token_sort + 0.3)
    low = resolve.fuzzy_candidates(ents, ments, threshold=0.7).collect()
    assert {(r.id_a, r.id_b) for r in low} == {(0, 1), (2, 3)}


def test_review_chains(spark):
    cols = "type string, id_a long, name_a string, id_b long, name_b string, score double, keep string, decision string"
    rows = spark.createDataFrame([("person", 1, "a", 2, "b", 0.9, "a", "accept"), ("person", 2, "b", 3, "c", 0.9, "b", "accept"), ("person", 3, "c", 4, "d", 0.9, "c", "accept"), ("person", 1, "a", 9, "z", 0.9, "z", "reject"), ("person", 5, "e", 6, "f", 0.9, "f", None)], cols)
    assert {tuple(r) for r in resolve.accepted_id_map(rows).collect()} == {(2, 1), (3, 1), (4, 1)}


@pytest.mark.parametrize("ref,ids", [("42", [42]), ("42, 55", [42, 55]), ("213–25", list(range(213, 226))), ("32–34, 42, 52-53", [32, 33, 34, 42, 52, 53]), ("x", []), ("9-7", []), ("1—2", [1, 2])])
def test_expanded_references(spark, ref, ids):
    assert spark.createDataFrame([(ref,)], "r string").select(citations.expanded_references(F.col("r"))).first()[0] == ids


def test_linked(spark):
    docs = table(spark, "documents", {"id": 3, "file_name": "1909 a.pdf", "collection": "C"}, {"id": 4, "file_name": "b.pdf", "display_title": "B"})
    ans = spark.createDataFrame([(1, "See [Doc 3] and [Doc 4,9], [Doc 4, title]."), (2, None), (3, "none")], "id long, text string")
    got = {r.id: r.text for r in citations.linked(ans, docs, "u").collect()}
    assert got[1].startswith("See [Doc 3, 1909 a.pdf](u/documents/3) and [Doc 4, B](u/documents/4), [Doc 9], [Doc 4, B](u/documents/4).")
    assert got[1].endswith("- **[Doc 4](u/documents/4)** — B\n- **[Doc 3](u/documents/3)** — 1909 a.pdf (*C*, c. 1909)\n")
    assert got[2] is None and got[3] == "none"


def test_file_name_citations_take_the_longest(spark):
    docs = table(spark, "documents", {"id": 1, "file_name": "Lee.pdf"}, {"id": 2, "file_name": "Lee, Ann.pdf"})
    ans = spark.createDataFrame([(1, "(Lee, Ann, 1909) (*Lee.pdf*, 1910) (Lee)")], "id long, text string")
    assert {(r.name, r.doc_id) for r in citations.file_name_citations(ans, docs).collect()} == {("Lee, Ann", 2), ("Lee.pdf", 1), ("Lee", 1)}


def test_bundles_and_contexts(spark):
    docs = table(spark, "documents", {"id": 1, "file_name": "a.pdf", "full_text": "text " * 10, "collection": "C", "summary": "S"}, {"id": 2, "file_name": "b.pdf", "summary": "T"})
    ents = table(spark, "entities", {"id": 1, "name": "Ann", "type": "person"})
    ments = table(spark, "mentions", {"id": 1, "entity_id": 1, "document_id": 1})
    events = table(spark, "events", {"id": 1, "document_id": 1, "type": "sale", "date": "1909", "description": "sold"})
    b = documents.bundles(docs, ents, ments, {"events": events, "financial_transactions": table(spark, "financial_transactions"), "relationships": table(spark, "relationships")}, [1, 5])
    row = b.first()
    assert b.count() == 1 and [e.name for e in row.entities] == ["Ann"] and [e.date for e in row.events] == ["1909"] and row.relationships == []
    text = context.deep_read_context(b).first().context
    assert "DOCUMENT: a.pdf" in text and "[person] Ann" in text and "1909 sale: sold" in text
    assert context.hybrid_context(b, 1).first().context.count("DOCUMENT") == 1
    lines = [r.line for r in context.corpus_lines(docs).orderBy("n").collect()]
    assert lines == ["=== C ===\n[Doc 1] a.pdf\nS", "=== Unknown ===\n[Doc 2] b.pdf\nT"]
    assert context.corpus_context(docs).first().context == "\n\n".join(lines)


def test_without_read(spark):
    ents = spark.createDataFrame([(1, ["a"]), (2, ["a", "b"]), (3, [])], "id long, source_files array<string>")
    facts = spark.createDataFrame([(1, "a"), (2, "c")], "id long, file_name string")
    assert [r.id for r in documents.without_read(ents, ["a"]).collect()] == [2]
    assert [r.id for r in documents.without_read(facts.unionByName(spark.createDataFrame([(3, None)], facts.schema)), ["a"]).collect()] == [2, 3]


def test_additional_sections(spark):
    ents = spark.createDataFrame([(1, "Ann", "person", "c" * 200, ["a", "b", "d", "e"], 9), (2, "Bob", None, None, ["a"], 8)], "id long, name string, type string, context string, source_files array<string>, relevance_score long")
    sold = spark.createDataFrame([(i, None, "p", None, "$1", "b.pdf" if i else "a", "") for i in range(25)], "id long, date string, payer string, payee string, amount string, file_name string, display_title string")
    net = spark.createDataFrame([("Ann", i, f"n{i:02d}", "person", 20 - i) for i in range(12)] + [("Zoe", 1, "x", None, 1)], "searched string, entity_id long, name string, type string, shared_docs long")
    parts = context.additional_sections({"entities": ents, "financial_transactions": sold, "network": net, "relationships": sold.limit(0).selectExpr("id", "file_name", "display_title", "payer as subject", "payer as type", "payer as object")}, ["a"])
    got = {r.n: r.text for p in parts for r in p.collect()}
    assert sorted(got) == [1, 2, 4]
    assert got[1] == f"ADDITIONAL ENTITIES FROM OTHER DOCUMENTS (1):\n  - Ann (person): {'c' * 120} | Sources: a, b, d"
    assert got[2].startswith("ADDITIONAL TRANSACTIONS FROM OTHER DOCUMENTS (24):\n  - [n/d] p → ?: $1 | b.pdf\n") and got[2].count("\n") == 20
    assert got[4].startswith("ENTITY NETWORKS:\n\n  Network for Ann:\n    - n00 (person): 20 shared docs\n") and got[4].count("shared docs") == 11 and got[4].endswith("Network for Zoe:\n    - x (): 1 shared docs")


def test_export(spark):
    rows = spark.createDataFrame([(i,) for i in (5, 1, 4, 2)], "v long")
    assert tuple(export.upper_median(rows, "v").first()) == (4, 1, 5, 3.0, 4)
    parts = export.split(spark.range(25), 0.1).groupBy("part").count().collect()
    assert {r.part: r["count"] for r in parts} == {"train": 22, "validation": 3}
    docs = table(spark, "documents", {"id": 1, "file_name": "a", "full_text": "t" * 30})
    g = export.gathered(docs, table(spark, "entities", {"id": 1, "name": "Ann", "type": "person"}), table(spark, "mentions", {"id": 1, "entity_id": 1, "document_id": 1}), {"financial_transactions": table(spark, "financial_transactions", {"id": 1, "document_id": 1, "for_what": "", "context": "c"})})
    pair = export.training_pairs(g, F.col("full_text"), 2, 10, 20).first()
    assert pair.n_items == 2 and len(pair.prompt) == 20 and '"description":""' in pair.completion
    line = export.chat_lines(export.training_pairs(g, F.col("full_text"), 1, 10, 20)).first().value
    assert line.startswith('{"messages":[{"role":"user"')
    req = export.summary_requests(docs.withColumn("full_text", F.repeat(F.lit("x"), 100)), "p")
    assert req.first().custom_id == "doc-1" and export.summary_requests(docs, "p").count() == 0
    res = spark.createDataFrame([("doc-1", "succeeded", "sum", None), ("doc-2", "errored", "x", None)], "custom_id string, state string, summary string, at timestamp_ntz")
    assert export.apply_summaries(docs, res).first().summary == "sum"


def stub_model():
    """A model that gives the same items for each chunk and fails on one text; made inside, so that it travels whole."""

    def make():
        def ask(prompt):
            if "FAIL" in prompt[-60:]:
                raise ValueError("no reply")
            return '```json\n{"entities":[{"name":"Ann","type":"person","context":"c"}],"events":[{"type":"sale","date":"1909","description":"d"}],"fee_patents":[{"allottee_name":""}]}\n```'

        return ask

    return make


def test_ingest(spark):
    incoming = spark.createDataFrame([("C/a.pdf", "a.pdf", "x" * 25), ("C/b.pdf", "b.pdf", "y" * 8), ("C/f.pdf", "f.pdf", "FAIL")], "file_path string, file_name string, full_text string")
    tables = {t: table(spark, t) for t in TABLES}
    out = ingest.ingest(incoming, tables, stub_model(), "v4", size=10, overlap=2, retries=1, pause=0.0)
    assert [r.id for r in out["documents"].orderBy("id").collect()] == [1, 2, 3]
    assert [(r.name, r.context) for r in out["entities"].collect()] == [("Ann", "c")]
    assert sorted(r.document_id for r in out["mentions"].collect()) == [1, 2]
    assert out["events"].count() == 2 and out["fee_patents"].count() == 0
    again = ingest.ingest(incoming, out, stub_model(), "v4", size=10, overlap=2, retries=0, pause=0.0)
    assert again["documents"].count() == 3 and again["events"].count() == 2
    forced = ingest.ingest(incoming.limit(1), out, stub_model(), "v4", force=True, size=10, overlap=2, retries=0, pause=0.0)
    assert forced["documents"].count() == 3 and forced["events"].count() == 2
    assert ingest.ingest(incoming, tables, stub_model(), dry_run=True)["documents"].count() == 3


def counting_model(folder):
    """A model that notes each call as a file, and fails as the prompt says."""

    def make():
        import os
        import uuid

        from folioframe.plans.ledger import RateLimited, Unavailable

        def ask(prompt):
            with open(os.path.join(folder, uuid.uuid4().hex), "w") as f:
                f.write(prompt[-40:])
            for word, error in (("LIMIT", RateLimited("slow", 0.0)), ("AWAY", Unavailable("away")), ("BAD", ValueError("bad"))):
                if word in prompt[-40:] and not os.path.exists(os.path.join(folder, "..", "well")):
                    raise error
            return '{"entities":[{"name":"Ann","type":"person"}],"events":[{"type":"sale","description":"d"}],"fee_patents":[{"allottee":"A"}]}'

        return ask

    return make


@pytest.mark.parametrize("version", ["v3", "v4"])
def test_one_call_a_chunk(spark, tmp_path, version):
    calls = tmp_path / "calls"
    calls.mkdir()
    incoming = spark.createDataFrame([("C/a.pdf", "a.pdf", "x" * 25), ("C/b.pdf", "b.pdf", "y" * 8), ("C/c.pdf", "c.pdf", "")], "file_path string, file_name string, full_text string")
    tables = {t: table(spark, t) for t in TABLES}
    how = {"size": 10, "overlap": 2, "ledger": str(tmp_path / "ledger"), "model": "m"}
    out = ingest.ingest(incoming, tables, counting_model(str(calls)), version, **how)
    for t in out.values():
        t.count()
    assert len(list(calls.iterdir())) == 4  # three chunks of the first text, one of the second
    assert out["events"].count() == 2 and out["mentions"].count() == 2 and out["fee_patents"].count() == 2
    more = incoming.unionByName(spark.createDataFrame([("A/new.pdf", "new.pdf", "z")], incoming.schema))  # ids move; known chunks are still known
    again = ingest.ingest(more, tables, counting_model(str(calls)), version, **how)
    assert again["mentions"].count() == 3 and len(list(calls.iterdir())) == 5
    ingest.ingest(incoming, tables, counting_model(str(calls)), version, **(how | {"model": "other"}))
    assert len(list(calls.iterdir())) == 9


def test_calls_that_fail(spark, tmp_path):
    calls, path = tmp_path / "calls", str(tmp_path / "ledger")
    calls.mkdir()
    said = ["LIMIT", "AWAY", "BAD", "fine", "fine", None]
    prompts = spark.createDataFrame([(str(i), 0, t, i) for i, t in enumerate(said)], "source string, chunk int, prompt string, state_of int")
    ask = lambda **how: {r.source: r for r in ledger.with_replies(prompts, counting_model(str(calls)), path, retries=2, pause=0.0, **how).collect()}
    got = ask()
    assert [(got[str(i)].state, got[str(i)].attempts) for i in range(6)] == [("limited", 3), ("unasked", 1), ("refused", 1), ("answered", 1), ("answered", 1), ("answered", 1)]
    assert len(list(calls.iterdir())) == 8 and got["2"].error == "bad" and got["2"].state_of == 2
    ask()  # limits and absent models are asked again, what was refused is not
    assert len(list(calls.iterdir())) == 12
    (tmp_path / "well").write_text("")
    got = ask()
    assert {s: r.state for s, r in got.items()} == {"0": "answered", "1": "answered", "2": "refused", "3": "answered", "4": "answered", "5": "answered"}
    assert ask(again=True)["2"].state == "answered" and len(list(calls.iterdir())) == 15
    assert {r.state: (r.n, r.attempts) for r in ledger.state_counts(spark, path).collect()} == {"answered": (6, 6)}
    ledger.compact(spark, path)
    ask(again=True)
    assert len(list(calls.iterdir())) == 15 and spark.read.parquet(path).count() == 6


def test_a_dead_model_is_given_up(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()
    prompts = spark.createDataFrame([(str(i), 0, "AWAY") for i in range(30)], "source string, chunk int, prompt string")
    got = ledger.with_replies(prompts, counting_model(str(calls)), str(tmp_path / "ledger"), give_up=3, pause=0.0)
    assert len(list(calls.iterdir())) == 3 and got.where("state = 'unasked'").count() == 30
    assert ledger.with_replies(prompts.limit(0), counting_model(str(calls)), str(tmp_path / "none")).count() == 0


def test_a_killed_run_is_resumed(spark, tmp_path):
    """Tasks that ended keep their replies though the job fails; the next run asks for the rest alone."""
    calls, path = tmp_path / "calls", str(tmp_path / "ledger")
    calls.mkdir()
    prompts = spark.createDataFrame([(str(i), 0, f"p{i}") for i in range(40)], "source string, chunk int, prompt string")

    def breaking(folder):
        model = counting_model(folder)

        def make():
            import os

            ask = model()

            def one(prompt):
                if len(os.listdir(folder)) >= 20 and not os.path.exists(os.path.join(folder, "..", "well")):
                    os._exit(1)
                return ask(prompt)

            return one

        return make

    with pytest.raises(Exception, match="."):
        ledger.with_replies(prompts, breaking(str(calls)), path, task_calls=4)
    kept = ledger.read(spark, path).count()
    (tmp_path / "well").write_text("")
    before = len(list(calls.iterdir()))
    assert 0 < kept < 40
    assert ledger.with_replies(prompts, breaking(str(calls)), path, task_calls=4).where("state = 'answered'").count() == 40
    assert len(list(calls.iterdir())) - before == 40 - kept


def test_clashing_names(spark):
    docs = table(spark, "documents", {"id": 1, "file_name": "a", "display_title": "t"}, {"id": 2, "file_name": "b"}).withColumn("new", F.lit(5)).withColumn("__title", F.lit("u"))
    new = spark.createDataFrame([(1, "c", 9, None)], "id long, file_name string, new int, collection string")
    got = {r.id: r for r in load.updated_documents(docs, new).collect()}
    assert (got[1].file_name, got[1].new, got[1].display_title, got[2].file_name, got[2].new) == ("c", 9, "t", "b", 5)
    set_ = {r.id: r for r in load.set_by_id(docs, spark.createDataFrame([(2, "x")], "id long, display_title string"), ["display_title"]).collect()}
    assert (set_[1].display_title, set_[2].display_title, set_[2]["__title"]) == ("t", "x", "u")
    said = spark.createDataFrame([('{"events":[{"type":"x"}]}', "mine", 3)], "reply string, __json string, settled int")
    row = json_text.parsed(said).first()
    assert (row["__json"], row.settled, row.valid_json, row.result.events[0].type) == ("mine", 3, True, "x")


def test_router():
    choose = ingest.router({"a": list, "a-big": dict})
    assert choose("a-big-1") is dict and choose("a-1") is list
    with pytest.raises(ValueError):
        choose("b")


def test_files(spark, tmp_path):
    for n in ("x/b.pdf", "x/y/a.pdf", "x/a Duplicate.pdf", "x/c.txt"):
        p = tmp_path / n
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text("t")
    found = files.listing(spark, str(tmp_path))
    assert [r.file_name for r in found.collect()] == ["a Duplicate.pdf", "b.pdf", "a.pdf"]
    assert [r.file_name for r in files.batch_window(files.without_copies(found), 2, 1).collect()] == ["a.pdf"]
    assert files.uuid_map(spark, str(tmp_path / "none.json")).count() == 0
    (tmp_path / "u.json").write_text('{"a.pdf":"1","b.pdf":"2"}')
    assert files.uuid_map(spark, str(tmp_path / "u.json")).count() == 2
    cand = spark.createDataFrame([("person", 1, "a", 2, "b", 0.9, "a", None)], "type string, id_a long, name_a string, id_b long, name_b string, score double, keep string, decision string")
    files.write_review(cand, str(tmp_path / "review"))
    assert [tuple(r) for r in files.review_file(spark, str(tmp_path / "review")).collect()] == [tuple(r) for r in cand.collect()]
    files.dump_context(str(tmp_path / "ctx"), a=spark.range(2), b=cand)
    assert len(files.load_context(spark, str(tmp_path / "ctx")).first().a) == 2
    rows = spark.createDataFrame([(1, 'q "x", y\nz')], "id long, t string")
    files.write_csv(rows, str(tmp_path / "csv"))
    assert files.read_csv(spark, str(tmp_path / "csv"), rows.schema).first().t == 'q "x", y\nz'


def test_catalog(spark):
    catalog.create(spark, "survey_test", "v3")
    assert "survey_test" in catalog.corpora(spark) and catalog.load(spark, "survey_test", "taxes") is None
    catalog.create(spark, "survey_test", "v4")
    assert catalog.load_or_empty(spark, "survey_test", "taxes").count() == 0
    rows = spark.createDataFrame([(1, "Ann", "person")], "id long, name string, type string")
    catalog.append(rows, "survey_test", "entities")
    assert catalog.load(spark, "survey_test", "entities").first().name == "Ann"
    catalog.swap(table(spark, "entities", {"id": 2, "name": "Bob", "type": "person"}), "survey_test", "entities")
    assert [r.name for r in catalog.load(spark, "survey_test", "entities").collect()] == ["Bob"]
    spark.sql("DROP DATABASE survey_test CASCADE")


def test_streaming(spark, tmp_path):
    from folioframe.streaming import incremental

    src = tmp_path / "in"
    (src / "C").mkdir(parents=True)
    (src / "C" / "a.txt").write_text("one")
    run = lambda: incremental.run_available(incremental.incoming_stream(spark, str(src)), str(tmp_path / "cp"), incremental.path_upsert(str(tmp_path / "out"))).awaitTermination()
    run()
    (src / "C" / "b.txt").write_text("two")
    run()
    run()
    got = spark.read.parquet(str(tmp_path / "out")).orderBy("file_name").collect()
    assert [(r.file_name, r.full_text, r.collection) for r in got] == [("a.txt", "one", "C"), ("b.txt", "two", "C")]


def test_schema_groups():
    assert [f.name for f in extraction_struct().fields][:3] == ["entities", "events", "financial_transactions"]


def test_linked_file_names(spark):
    docs = table(spark, "documents", {"id": 1, "file_name": "Lee.pdf"}, {"id": 2, "file_name": "Lee, Ann.pdf"})
    ans = spark.createDataFrame([(1, "(Lee, Ann, 1909) (*Lee.pdf*, 1910) (none.pdf)"), (2, None)], "id long, text string")
    got = {r.id: r.text for r in citations.linked_file_names(ans, docs, "u").collect()}
    assert got == {1: "([Lee, Ann](u/documents/2), 1909) (*[Lee.pdf](u/documents/1)*, 1910) (none.pdf)", 2: None}


def test_comparison(spark):
    from folioframe.plans import comparison

    prompts = spark.createDataFrame([(1, "q1", "p one"), (2, "q2", "p two")], "id long, question string, prompt string")
    make = lambda reply: lambda: lambda prompt: reply
    choose = ingest.router({"a": make('{"events":[{"type":"x"}]}'), "b": make("no | json")})
    runs = comparison.run_matrix(prompts, ["a-1", "b-1"], choose)
    got = [tuple(r) for r in comparison.extraction_summary(runs, ["events"]).collect()]
    assert got == [("a-1", 2, 2, 2, 2), ("b-1", 2, 0, 0, 0)]
    answers = comparison.answer_summary(runs)
    assert answers.count() == 4 and answers.where("model = 'b-1'").first().word_count == 3
    text = comparison.report("Runs", ["two prompts"], runs.select("model", "question", "reply"), ["question", "model"])
    assert text.splitlines()[4:8] == ["| model | question | reply |", "|---|---|---|", '| a-1 | q1 | {"events":[{"type":"x"}]} |', "| b-1 | q1 | no \\| json |"]


def test_json_schema():
    from folioframe.schemas import json_schema

    found = json_schema(["entities", "events"])
    assert found["required"] == ["entities", "events"] and found["type"] == "object"
    item = found["properties"]["events"]["items"]
    assert item["properties"]["entities_involved"] == {"type": "array", "items": {"type": "string"}} and item["properties"]["date"] == {"type": "string"}
    assert set(item["required"]) == set(item["properties"]) and item["additionalProperties"] is False


def test_jdbc_reads_ranges_of_a_key(spark):
    url = "jdbc:derby:memory:folio;create=true"
    spark.range(100).selectExpr("id AS ID", "concat('n', id) AS NAME").write.jdbc(url, "NAMES")
    whole = catalog.jdbc(spark, url, "NAMES")
    parts = catalog.jdbc(spark, url, "NAMES", "ID", (0, 100), 4)
    assert parts.rdd.getNumPartitions() == 4
    assert sorted(map(tuple, parts.collect())) == sorted(map(tuple, whole.collect())) == sorted((i, f"n{i}") for i in range(100))


def test_discovery_context_has_its_sections_in_order(spark):
    label = {"file_name": "a.pdf", "display_title": ""}
    ents = spark.createDataFrame([(1, "Ann", "person", "clerk", 2, 3, ["a.pdf"])], "id long, name string, type string, context string, relevance_score int, doc_count int, source_files array<string>")
    events = spark.createDataFrame([(i, "sale", f"19{i:02d}", "lot", "x" * 300) for i in range(50)], "id long, type string, date string, location string, description string").withColumns({k: F.lit(v) for k, v in label.items()})
    net = spark.createDataFrame([("Ann", i, f"P{i:02d}", "person", 20 - i) for i in range(20)], "searched string, entity_id long, name string, type string, shared_docs int")
    taxes = spark.createDataFrame([(1, "t")], "id long, taxpayer string")
    got = context.discovery_context({"network": net, "taxes": taxes, "events": events, "entities": ents})
    heads = [line for line in got.split("\n") if line.endswith(" total):")]
    assert heads == ["EXTRACTED ENTITIES (1 total):", "EVENTS (50 total):", "ENTITY NETWORKS (15 total):"]
    assert got.count("sale: ") == 40 and "x" * 200 in got and "x" * 201 not in got and "P14" in got and "P15" not in got


@pytest.mark.parametrize(
    "text,want",
    [
        ("(Report (1909).pdf)", {("Report (1909).pdf", 1)}), ("(*Report (1909)*, 1 May)", {("Report (1909)", 1)}), ("(1909)", {("1909", 2)}), ("(A, b (c), d.pdf, x", set()),
        ("(A, b (c), d.pdf, see (1909))", {("A, b (c), d.pdf", 3), ("1909", 2)}), ("((1909.pdf))", {("1909.pdf", 2)}), ("(report (1909).pdf)", {("1909", 2)}), ("()(,)(*)(**)", {("*", 4)}), (None, set()),
    ],
)
def test_names_with_parentheses(spark, text, want):
    docs = spark.createDataFrame([(1, "Report (1909).pdf"), (2, "1909.pdf"), (3, "A, b (c), d.pdf"), (4, "*"), (9, "1909.pdf")], "id long, file_name string")
    ans = spark.createDataFrame([(1, text)], "id long, text string")
    assert {(r.name, r.doc_id) for r in citations.file_name_citations(ans, docs).collect()} == want


def test_links_to_identifiers(spark):
    docs = spark.createDataFrame([(1, "R (é).pdf"), (2, "plain"), (3, "none.pdf")], "id long, file_name string")
    uuids = spark.createDataFrame([("R (é).pdf", "U1"), ("plain", "U2"), ("plain.pdf", "U3")], "file_name string, uuid string")
    ans = spark.createDataFrame([(1, "é (R (é)*, 1909) (plain) (none.pdf) (R (é).pdf)"), (2, None)], "id long, text string")
    got = {r.id: r.text for r in citations.linked_file_names(ans, docs, uuids=uuids).collect()}
    assert got == {1: "é ([R (é)](x-item://U1)*, 1909) ([plain](x-item://U3)) (none.pdf) ([R (é).pdf](x-item://U1))", 2: None}
    assert {r.id: r.text for r in citations.linked_file_names(ans, docs).collect()} == {r.id: r.text for r in ans.collect()}


def accepted(spark, pairs):
    rows = [("person", b, f"n{b}", a, f"n{a}", 0.9, f"n{b}", "accept") for a, b in pairs]
    return spark.createDataFrame(rows, "type string, id_a long, name_a string, id_b long, name_b string, score double, keep string, decision string")


@pytest.mark.parametrize(
    "pairs,want",
    [
        ([(1, 2), (2, 3), (3, 1)], {(2, 1), (3, 1)}), ([(1, 2), (2, 3)], {(1, 3), (2, 3)}), ([(1, 2), (1, 3)], {(1, 2), (3, 2)}), ([(1, 1)], set()), ([], set()), ([(5, 4), (4, 5), (5, 6)], {(4, 6), (5, 6)}),
        ([(i, i + 1) for i in range(1000)], {(i, 1000) for i in range(1000)}), ([(i, (i + 1) % 1000) for i in range(1000)], {(i, 0) for i in range(1, 1000)}),
    ],
)
def test_merges_keep_one_entity_each(spark, pairs, want):
    assert {tuple(r) for r in resolve.accepted_id_map(accepted(spark, pairs)).collect()} == want


def test_merge_plan(spark):
    ents = table(spark, "entities", *[{"id": i, "name": f"n{i}", "type": "person"} for i in (1, 2, 3)])
    ments = table(spark, "mentions", *[{"id": k, "entity_id": e, "document_id": d} for k, (e, d) in enumerate([(1, 1), (2, 1), (2, 2), (3, 2), (3, 3)])])
    got = {tuple(r) for r in resolve.merge_plan(accepted(spark, [(2, 1), (3, 1)]), ents, ments).collect()}
    assert got == {(2, "n2", 1, "n1", 1, 1), (3, "n3", 1, "n1", 1, 1)}


def test_versions_are_whole(spark, tmp_path):
    store = manifest.Store(spark, str(tmp_path / "v"))
    assert store.latest() == 0 and store.read() == {}
    ids = lambda t: sorted(r.id for r in t.collect())
    rows = lambda *x: spark.createDataFrame([(i,) for i in x], "id long")
    assert store.commit({"a": rows(1), "b": rows(2)}) == 1
    held = store.read()
    assert store.commit({"a": held["a"].unionByName(rows(3)), "b": rows()}) == 2  # a table may be built from its own last version
    assert (ids(held["a"]), ids(held["b"])) == ([1], [2])  # who reads the old version goes on reading it
    assert {n: ids(t) for n, t in store.read().items()} == {"a": [1, 3], "b": []}
    assert {n: ids(t) for n, t in store.read(1).items()} == {"a": [1], "b": [2]}


def test_commits_that_meet(spark, tmp_path):
    store, other = (manifest.Store(spark, str(tmp_path / "v")) for _ in range(2))
    rows = lambda *x: spark.createDataFrame([(i,) for i in x], "id long")
    store.commit({"a": rows(1), "b": rows(2), "c": rows()})
    base = other.latest()
    store.commit({"a": rows(9)})
    with pytest.raises(manifest.Conflict, match="a"):
        other.commit({"a": rows(5)}, base=base)
    with pytest.raises(manifest.Conflict, match="a"):
        other.commit({"b": rows(5)}, base=base, reads=("a",))
    assert other.commit({"b": rows(5)}, base=base) == 3  # apart from the other commit: both stand
    assert {n: [r.id for r in t.collect()] for n, t in store.read().items()} == {"a": [9], "b": [5], "c": []}
    assert store.commit({"c": None}) == 4 and set(store.read()) == {"a", "b"}
    taken = store._put
    store._put = lambda v, held: taken(v, {"x": held["a"]}) and False  # the number is taken between the look and the rename
    with pytest.raises(manifest.Conflict):
        store.commit({"a": rows(7)})


def test_a_killed_commit_leaves_the_old_version(spark, tmp_path):
    store = manifest.Store(spark, str(tmp_path / "v"))
    rows = lambda *x: spark.createDataFrame([(i,) for i in x], "id long")
    store.commit({"a": rows(1), "b": rows(2)})
    bad = rows(1).select(F.raise_error(F.lit("killed")).cast("long").alias("id"))
    with pytest.raises(Exception, match="killed"):
        store.commit({"a": rows(8), "b": bad})
    assert store.versions() == [1] and {n: [r.id for r in t.collect()] for n, t in store.read().items()} == {"a": [1], "b": [2]}
    store.commit({"b": rows(3)})
    store.commit({"b": rows(4)})
    assert store.vacuum(keep=1) == 4 and store.versions() == [3]  # the killed commit's two folders, and b's first two
    assert {n: [r.id for r in t.collect()] for n, t in store.read().items()} == {"a": [1], "b": [4]}
    assert store.vacuum() == 0
