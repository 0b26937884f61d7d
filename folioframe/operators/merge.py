"""Merging the extraction results of a document's chunks: the first of equal items stays, contexts are joined."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import strip
from .ordering import free_name

_text = lambda c: F.coalesce(F.col(c), F.lit(""))
_folded = lambda c: strip(F.lower(_text(c)))


def item_key(group: str) -> list[Column]:
    """What makes two items of a group equal. Null counts as empty."""
    return {
        "financial_transactions": lambda: [_text("amount"), _text("payer"), _text("payee"), F.left(_text("for_what"), F.lit(50))],
        "relationships": lambda: [_text("type"), _text("subject"), _text("object")],
        "events": lambda: [_text("type"), _text("date"), F.left(_text("description"), F.lit(100))],
        "fee_patents": lambda: [_folded("allottee"), strip(_text("allotment_number")), _text("patent_date")],
        "correspondence": lambda: [_folded("sender"), _folded("recipient"), _text("date"), F.left(_text("subject"), F.lit(50))],
        "legislative_actions": lambda: [strip(F.upper(_text("bill_number"))), _text("action_type"), _text("action_date")],
    }[group]()


def items(parsed: DataFrame, group: str, doc_col: str = "document_id", chunk_col: str = "chunk") -> DataFrame:
    """(document_id, chunk, pos, fields…): one row an item of a group, in its place."""
    return parsed.select(F.col(doc_col).alias("document_id"), F.col(chunk_col).alias("chunk"), F.posexplode(F.col("result")[group]).alias("pos", "x")).select("document_id", "chunk", "pos", "x.*")


def _first(rows: DataFrame, key: list[Column]) -> DataFrame:
    """The first row of each key in a document, by chunk and position; rows that share both go by their fields, nulls first."""
    fields = [f.name for f in rows.schema.fields if f.name not in ("document_id", "chunk", "pos") and "map<" not in f.dataType.simpleString()]
    order = Window.partitionBy("document_id", *key).orderBy("chunk", "pos", *[F.asc_nulls_first(f"`{c}`") for c in fields])
    place = free_name(rows.columns, "place")
    return rows.withColumn(place, F.row_number().over(order)).where(F.col(place) == 1).drop(place)


def first_of_equal(rows: DataFrame, group: str) -> DataFrame:
    """The first item, by chunk and position, of each set of equal ones in a document."""
    return _first(rows, item_key(group))


def merged_entities(rows: DataFrame) -> DataFrame:
    """(document_id, seq, type, name, context, acres, land_type): entities equal in type and folded name are one.

    The first spelling stays; distinct contexts are joined by "; " in the order they appear, or say that the entity is
    mentioned; acres and land type come from the first and only for acreage holdings. Blank names drop out. Items that share
    a chunk and a position are ordered by their fields, and entities that begin there by type and folded name.
    """
    named = rows.withColumn("name", strip(_text("name"))).where("name <> ''").withColumn("context", strip(_text("context")))
    item = F.struct("chunk", "pos", "name", "context", "acres", "land_type")
    per = named.groupBy("document_id", "type", F.lower("name").alias("key")).agg(F.sort_array(F.collect_list(item)).alias("x"))
    first = F.get("x", F.lit(0))
    contexts = F.array_distinct(F.filter(F.transform("x", lambda i: i["context"]), lambda c: c != ""))
    holding = lambda f: F.when(F.col("type") == "acreage_holding", first[f])
    placed = per.select("document_id", "key", first["chunk"].alias("chunk"), first["pos"].alias("pos"), "type", first["name"].alias("name"), F.coalesce(F.nullif(F.array_join(contexts, "; "), F.lit("")), F.lit("Mentioned in document")).alias("context"), holding("acres").alias("acres"), holding("land_type").alias("land_type"))
    order = Window.partitionBy("document_id").orderBy("chunk", "pos", "type", "key")
    return placed.withColumn("seq", F.row_number().over(order)).select("document_id", "seq", "type", "name", "context", "acres", "land_type")


def uploaded_entities(rows: DataFrame) -> DataFrame:
    """The upload flow's rule: equal are folded but unstripped names of one type; the first stays as it is."""
    return _first(rows, [F.lower(_text("name")), F.col("type")])


def concatenated(parsed: DataFrame, groups: list[str], doc_col: str = "document_id") -> DataFrame:
    """(document_id, groups…): the chunks' lists end to end, without removing equal items."""
    rows = parsed.select(F.col(doc_col).alias("document_id"), "chunk", "result").groupBy("document_id").agg(F.sort_array(F.collect_list(F.struct("chunk", "result"))).alias("x"))
    of = lambda g: lambda c: c["result"][g]
    return rows.select("document_id", *[F.flatten(F.transform("x", of(g))).alias(g) for g in groups])
