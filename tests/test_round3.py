"""Small cases of the findings of round 3."""

import hashlib
import json

import duckdb

from pyspark.sql import functions as F

import __spark_entry__
from compare import rows

from folioframe.operators import citations, context, documents, export, load, merge, resolve, retrieval, search
from folioframe.plans import exchange, ingest
from folioframe.sources import manifest


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_sums_of_ids_pass_a_bigint(spark, tmp_path):
    store = manifest.Store(spark, str(tmp_path / "v"))
    store.commit({"t": spark.range(3).withColumn("id", F.lit(2**62))})
    assert [tuple(r) for r in exchange._counted_versions(store, [1]).collect()] == [(1, "t", 3, 3 * 2**62)]
    store.commit({"t": spark.range(3)})
    out = exchange._counted_versions(store, [2])
    assert out.schema["ids"].dataType.simpleString() == "bigint" and [tuple(r) for r in out.collect()] == [(2, "t", 3, 3)]


def test_mentions_meet_entities_of_one_name_last(spark):
    entities = spark.range(40).select("id", F.lit("bolt").alias("name"), F.lit("part").alias("type"))
    said = [("bolt", "part", d, f"c{s}", s) for d in (1, 2, None) for s in (2, 1)] + [(None, "part", 1, "x", 0)]
    incoming = spark.createDataFrame(said, "name string, type string, document_id long, context string, seq long")
    there = spark.createDataFrame([(3, 1), (4, 1), (3, None)], "entity_id long, document_id long")
    out = load.new_mentions(entities, incoming, there)
    want = {(e, d, "c1") for e in range(40) for d in (1, 2, None)} - {(3, 1, "c1"), (4, 1, "c1")}
    got = [tuple(r) for r in out.collect()]
    assert len(got) == len(want) and set(got) == want
    text = plan(out)
    assert text.index("Join") < text.index("Exchange")  # nothing is shuffled after the entities were met


def test_upserts_carry_no_list_of_all_items(spark):
    old = spark.createDataFrame([(i, "bolt", "part", "ctx" if i == 2 else None, None, None) for i in (1, 2)], "id long, name string, type string, context string, acres string, land_type string")
    rows = [(s, n, "part", c, a, None) for n in ("bolt", "nut") for s, c, a in ((5, "b", None), (1, "a", "1"), (3, "b", "3"), (4, "", None), (2, "a", None))]
    new = spark.createDataFrame(rows, "seq long, name string, type string, context string, acres string, land_type string")
    got = {m: {(r.id, r.name): (r.context, r.acres) for r in load.upserted_entities(old, new, m).collect()} for m in ("merge", "first", "last")}
    assert got["merge"] == {(1, "bolt"): ("a; b", "3"), (2, "bolt"): ("ctx; a; b", "3"), (3, "nut"): ("a; b", "3")}
    assert got["first"] == {(1, "bolt"): (None, "1"), (2, "bolt"): ("ctx", "1"), (3, "nut"): ("a", "1")}
    assert got["last"] == {(1, "bolt"): ("b", "1"), (2, "bolt"): ("b", "1"), (3, "nut"): ("b", "1")}
    assert "collect_list" not in plan(load.upserted_entities(old, new, "last"))


def test_long_names_meet_by_long_grams(spark):
    """Names that share a surname and a trigram somewhere don't meet; misspelled ones do."""
    said = [hashlib.md5(str(i).encode()).hexdigest()[:20] for i in range(600)]
    rows = [(i, f"{h[:10]} {h[10:]} kingsley", "b") for i, h in enumerate(said)] + [(1000 + i, f"{h[:10]} {h[10:14]}{h[15:]} kingsley", "b") for i, h in enumerate(said[:20])]
    got = {tuple(r) for r in resolve.similar_pairs(spark.createDataFrame(rows, "id long, norm string, block string"), 0.95, ["block"]).collect()}
    assert {(i, 1000 + i) for i in range(20)} <= got and len(got) < 60


def test_copies_of_a_name_pair_with_its_double(spark):
    rows = [(i, "alexandrina montgomery", "person") for i in range(4)] + [(10 + i, "alexandrina montgomerry", "person") for i in range(3)]
    entities, mentions = spark.createDataFrame(rows, "id long, name string, type string"), spark.createDataFrame([(0, 1), (10, 1), (10, 2), (1, 3)], "entity_id long, document_id long")
    got = {(r.id_a, r.id_b): r.shared_docs for r in resolve.fuzzy_candidates(entities, mentions).collect()}
    assert got == {(a, b): int((a, b) == (0, 10)) for a in range(4) for b in (10, 11, 12)}


def test_candidates_are_as_long_as_names():
    text = "see (Ab (1), c.pdf, 1909) and (*Ab (1), c*) or (Ab)"
    assert {n for *_, n in citations.cited_candidates(text, 12, frozenset((8, 12)))} <= {n for *_, n in citations.cited_candidates(text, 12)}
    assert [n for *_, n in citations.cited_candidates(text, 12, frozenset((8, 12)))] == [n for *_, n in citations.cited_candidates(text, 12) if len(n) in (8, 12)]


def test_children_are_cut_to_the_documents_before_they_are_counted(spark):
    texts = spark.createDataFrame([(1, "a.pdf", None, "one tion", None), (2, "b.pdf", None, "two", None)], "id long, file_name string, display_title string, full_text string, collection string")
    mentions = spark.createDataFrame([(7, 1), (8, 1), (9, 5), (9, None)], "entity_id long, document_id long").distinct()
    assert [(r.id, r.entity_count) for r in retrieval.list_documents(texts, mentions).collect()] == [(1, 2), (2, 0)]
    assert [(r.id, r.entity_count) for r in retrieval.search_documents(texts, mentions, "tion").collect()] == [(1, 2)]
    assert "LeftSemi" in plan(retrieval.search_documents(texts, mentions, "tion"))


def test_an_opening_that_ends_at_a_line_break(spark, tmp_path):
    """The block of the first two lines has 99 characters; that of the second one adds a line break and more."""
    first, second = "then the other the " + "a" * 24, "the ation " + "b" * 45
    rows_ = [(1, f"{first}\n{second}\nan end without one, long enough")]
    spark.createDataFrame(rows_, "doc_id long, text string").selectExpr("*", "'en' AS lang", "'web' AS source", "length(text) AS n_chars").write.parquet(str(tmp_path / "documents.parquet"))
    got = __spark_entry__.queries()["passages_topk"](spark, str(tmp_path)).toPandas()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.execute(__spark_entry__.oracle_sql()["passages_topk"]).df()
    assert len(first) + 1 + len(second) == 99 and len(got) == 2 and rows(got) == rows(want)


def test_forms_of_a_query_are_broadcast(spark):
    texts = spark.createDataFrame([(1, "walks and walking"), (2, "a walk"), (3, "none")], "id long, full_text string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = retrieval.matched(texts, "walked", stemmed=True).select("id")
        assert "BroadcastHashJoin" in plan(out) and {r.id for r in out.collect()} == {1, 2}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_bundles_with_numbers(spark):
    docs = spark.createDataFrame([(1,), (2,)], "id long")
    ents, ments = spark.createDataFrame([(7, "t", "n", "c")], "id long, type string, name string, context string"), spark.createDataFrame([(7, 1)], "entity_id long, document_id long")
    sold = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "document_id long, payer string")
    got = {r.id: (len(r.entities), r.financial_transactions) for r in documents.bundles(docs, ents, ments, {}, numbers={"financial_transactions": sold}).collect()}
    assert got == {1: (1, 2), 2: (0, 0)}


def test_links_are_made_without_python(spark):
    docs = spark.createDataFrame([(4, "a.pdf", "Four", "C"), (5, "b 1909.pdf", None, None)], "id long, file_name string, display_title string, collection string")
    said = ["[Doc 4] [Doc 5, x y] [Doc 6, z] [Doc 4,5-6]", "[Doc , ] none", "[Doc 007, t]", "", None, "[Doc 4](u) [Doc 4, q](u)"]
    out = citations.linked(spark.createDataFrame(list(enumerate(said)), "id long, text string"), docs, "https://x")
    got = {r.id: r.text for r in out.collect()}
    four, five = "[Doc 4, Four](https://x/documents/4)", "[Doc 5, b 1909.pdf](https://x/documents/5)"
    tail = "\n\n---\n\n### Sources Cited\n\n- **[Doc 5](https://x/documents/5)** — b 1909.pdf\n- **[Doc 4](https://x/documents/4)** — Four (*C*)\n"
    assert got == {0: f"{four} {five} [Doc 6] {four}, {five}, [Doc 6]{tail}", 1: said[1], 2: "[Doc 7]", 3: "", 4: None, 5: said[5]}
    assert "Python" not in plan(out)


def test_searches_are_read_again_without_a_second_search(spark):
    docs = spark.createDataFrame([(1, "a.pdf", None), (2, "b.pdf", "B")], "id long, file_name string, display_title string")
    ents = spark.createDataFrame([(1, "bolt", "person", None), (2, "bolts", "part", "x"), (3, "nut", "part", "y")], "id long, name string, type string, context string")
    ments = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (1, 9), (3, 1), (2, None)], "entity_id long, document_id long")
    out = search.search_entities(ents, ments, docs, "bolt")
    assert [tuple(r) for r in out.collect()] == [(1, "bolt", "person", None, 3, ["B", "a.pdf"], 1003), (2, "bolts", "part", "x", 0, [], 500)]
    assert "Join" not in plan(out) and all("Join" not in plan(p) or "mentions" not in plan(p) for p in context.additional_sections({"entities": out}, ["a.pdf"]))
    assert {(r.entity_id, r.shared_docs) for r in search.entity_network(ents, ments, ["bolt"]).collect()} == {(3, 1)}


def test_a_ledger_needs_no_tables(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(ingest, "loaded", lambda *a, **b: 1 / 0)
    assert len(__spark_entry__.queries()["reply_ledger"](spark, sf_dir).take(1)) == 1


def test_entities_of_one_place_are_numbered_alike_in_any_order(spark):
    said = [(1, 0, 5, t, n, None, None, None) for t in ("a", "b", "c", "d", None) for n in ("x", "Y", "z")] + [(1, 0, 4, "z", "first", None, None, None)]
    schema = "document_id long, chunk int, pos int, type string, name string, context string, acres string, land_type string"
    want = [(1, "z", "first")] + [(i + 2, t, n) for i, (t, n) in enumerate((t, n) for t in (None, "a", "b", "c", "d") for n in ("x", "Y", "z"))]
    for given in (said, said[::-1]):
        out = merge.merged_entities(spark.createDataFrame(given, schema))
        assert sorted((r.seq, r.type, r.name) for r in out.collect()) == want


def test_items_of_one_id_are_exported_alike_in_any_order(spark):
    docs = spark.createDataFrame([(1, "text")], "id long, full_text string")
    ents, ments = spark.createDataFrame([(3, "Ann", "person", None)], "id long, name string, type string, context string"), spark.createDataFrame([(3, 1), (4, 1)], "entity_id long, document_id long")
    said = [(7, 1, "sold", s, "bolt", None) for s in ("c", "a", None, "b")] + [(6, 1, "leases", "z", "nut", "x")]
    for given in (said, said[::-1]):
        facts = spark.createDataFrame(given, "id long, document_id long, type string, subject string, object string, context string")
        g = export.gathered(docs, ents, ments, {"relationships": facts.repartition(3)})
        pair = export.training_pairs(g, F.col("full_text"), 1, 1).first()
        got = json.loads(pair.completion)
        assert [(r["subject"], r["type"]) for r in got["relationships"]] == [("z", "leases"), ("", "sold"), ("a", "sold"), ("b", "sold"), ("c", "sold")]
        assert [e["name"] for e in got["entities"]] == ["Ann"] and pair.n_items == 6
