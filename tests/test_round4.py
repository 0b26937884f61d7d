"""Findings of round 4."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioframe.operators import export, load, members, merge, resolve


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_cascades_do_not_shuffle_the_facts(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        there = [-130, -64, -1, 0, 1, 62, 63, 64, 127, 128, 10**12, None, 62]
        facts = spark.createDataFrame([(i, d, "x") for i, d in enumerate(there)], "id long, document_id long, payer string")
        gone = spark.createDataFrame([(-64,), (-1,), (63,), (128,), (10**12,), (None,), (63,)], "id long")
        for out in (load.cascaded({"financial_transactions": facts}, gone), load.cleared({"financial_transactions": facts}, gone)):
            left = out["financial_transactions"]
            assert sorted(r.id for r in left.collect()) == [0, 3, 4, 5, 7, 8, 11, 12]
            assert left.columns == facts.columns and "Exchange hashpartitioning" not in plan(left)
        docs = spark.createDataFrame([(i, "t") for i in (-64, 5, 63)], "id long, full_text string")
        assert [r.id for r in load.cascaded({"documents": docs}, gone)["documents"].collect()] == [5]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_sets_that_are_too_large_are_joined(spark, monkeypatch):
    monkeypatch.setattr(members, "MOST_WORDS", 1)
    rows, ids = spark.range(200).withColumn("id_there", F.lit(1)), spark.createDataFrame([(3,), (150,), (3,)], "id long")
    assert members.words(ids) is None
    assert sorted(r.id for r in members.among(rows, "id", ids, None).collect()) == [3, 150]
    assert members.among(rows, "id", ids, None, without=True).count() == 198
    texts = spark.createDataFrame([("a",), ("b",)], "id string")
    assert [r.id for r in members.among(texts, "id", texts.where("id = 'a'"), members.words(texts)).collect()] == ["a"]


def test_first_of_equal_ties_go_by_fields(spark):
    rows = [(1, 1, 5, "Agent", "x", None, "s"), (1, 1, 5, " agent ", "x", None, "s"), (1, 1, 5, "AGENT", "x", None, "s"), (1, 2, 5, " ", "x", None, "s"), (1, 2, 5, None, "x", None, "s")]
    schema = "document_id long, chunk long, pos long, sender string, recipient string, date string, subject string"
    given = [merge.first_of_equal(spark.createDataFrame(r, schema).coalesce(1), "correspondence").collect() for r in (rows, rows[::-1], rows[2:] + rows[:2])]
    assert {frozenset(tuple(r) for r in g) for g in given} == {frozenset({rows[1], rows[4]})}


def test_uploaded_entities_ties_go_by_fields(spark):
    rows = [(1, 1, 5, "person", "Ann", "b"), (1, 1, 5, "person", "ANN", "c"), (1, 1, 5, "person", "ANN", None)]
    schema = "document_id long, chunk long, pos long, type string, name string, context string"
    given = [merge.uploaded_entities(spark.createDataFrame(r, schema).coalesce(1)).collect() for r in (rows, rows[::-1])]
    assert [[tuple(r) for r in g] for g in given] == [[rows[2]], [rows[2]]]


def test_gathered_cuts_mentions_before_they_meet_entities(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        texts = spark.createDataFrame([(1, "a"), (2, "b")], "id long, full_text string")
        entities = spark.createDataFrame([(7, "Ann", "person", None)], "id long, name string, type string, context string")
        mentions = spark.createDataFrame([(7, 1), (7, 3), (7, None)], "entity_id long, document_id long")
        out = export.gathered(texts, entities, mentions, {})
        assert "BroadcastHashJoin" in plan(out) and "LeftSemi" in plan(out)
        assert sorted((r.id, r.n_items, len(r.entities)) for r in out.collect()) == [(1, 1, 1), (2, 0, 0)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_comparable_cuts_mentions_before_they_are_collected(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        entities = spark.createDataFrame([(7, "Ann Lee", "person"), (8, "Acre One", "land_parcel"), (9, "Bob Lee", "person")], "id long, name string, type string")
        mentions = spark.createDataFrame([(7, 2), (7, 1), (7, 1), (8, 1), (7, None)], "entity_id long, document_id long")
        out = resolve.comparable(entities, mentions, ["person"])
        assert "BroadcastHashJoin" in plan(out)
        assert sorted((r.id, r.doc_ids, r.doc_count) for r in out.collect()) == [(7, [1, 2], 2), (9, [], 0)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
