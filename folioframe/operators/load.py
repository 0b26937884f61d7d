"""Loading merged items into the corpus tables: ids, upserts, re-extraction, cascades. Tables are versions: each
operator returns the new rows or the new whole table, and the caller writes it beside the old one and swaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import CHILDREN, CLEARED, TABLES
from .members import among, words
from .ordering import free_name, numbered


def with_ids(rows: DataFrame, order: list[str], start: int = 0, partitions: int | None = None) -> DataFrame:
    """Rows with ids from start + 1 on, without gaps, by ``order``, nulls first. No task sorts the whole."""
    return numbered(rows, [F.asc_nulls_first(c) for c in order], "id", start, partitions)


def unprocessed(incoming: DataFrame, documents: DataFrame) -> DataFrame:
    """Files whose path no document has."""
    return incoming.join(documents.select("file_path").where("file_path is not null"), "file_path", "left_anti")


def existing_ids(incoming: DataFrame, documents: DataFrame) -> DataFrame:
    """Files with the smallest id of a document of their name, or null."""
    return incoming.join(documents.groupBy("file_name").agg(F.min("id").alias("existing_id")), "file_name", "left")


def cleared(tables: dict[str, DataFrame], document_ids: DataFrame) -> dict[str, DataFrame]:
    """Tables without the facts of documents that are to be extracted again. Entities stay, and so do the latest groups' tables."""
    gone = document_ids.select("id")
    held = words(gone)
    return {n: among(t, "document_id", gone, held, without=True) if n in CLEARED else t for n, t in tables.items()}


def cascaded(tables: dict[str, DataFrame], document_ids: DataFrame) -> dict[str, DataFrame]:
    """Tables without some documents and all that hangs on them."""
    gone = document_ids.select("id")
    held = words(gone)
    without = lambda t, c: among(t, c, gone, held, without=True)
    return {n: without(t, "id") if n == "documents" else without(t, "document_id") if n in CHILDREN else t for n, t in tables.items()}


def updated_documents(documents: DataFrame, updates: DataFrame, keep: tuple[str, ...] = ("id", "summary", "summary_date", "display_title")) -> DataFrame:
    """Documents overwritten by updates of the same id; ``keep`` columns stay, and all of a document without update."""
    fields = [c for c in documents.columns if c in updates.columns and c not in keep]
    new = updates.select("id", F.struct(F.lit(True).alias("there"), *[F.col(c).alias(f"f{i}") for i, c in enumerate(fields)]).alias(free_name(documents.columns, "new")))
    change = F.col(new.columns[1])
    value = {c: change[f"f{i}"] for i, c in enumerate(fields)}
    return documents.join(new, "id", "left").select(*[F.when(change.isNotNull(), value[c]).otherwise(F.col(c)).alias(c) if c in value else F.col(c) for c in documents.columns])


def set_by_id(documents: DataFrame, values: DataFrame, columns: list[str]) -> DataFrame:
    """Documents with some columns set where ``values`` (id, columns…) has a value."""
    new = values.select("id", F.struct(*[F.col(c).alias(f"f{i}") for i, c in enumerate(columns)]).alias(free_name(documents.columns, "new")))
    change = F.col(new.columns[1])
    value = {c: change[f"f{i}"] for i, c in enumerate(columns)}
    return documents.join(new, "id", "left").select(*[F.coalesce(value[c], F.col(c)).alias(c) if c in value else F.col(c) for c in documents.columns])


def fold_contexts(contexts: Column, base: Column) -> Column:
    """Contexts appended in order: the first fills an empty base; a later one joins by "; " unless its first 50 characters,
    where % and _ are wildcards, are in what is there."""
    def step(acc: Column, c: Column) -> Column:
        present = F.like(acc, F.concat(F.lit("%"), F.left(c, F.lit(50)), F.lit("%")))
        return F.when(F.coalesce(c, F.lit("")) == "", acc).when(F.coalesce(acc, F.lit("")) == "", c).when(present, acc).otherwise(F.concat(acc, F.lit("; "), c))

    return F.aggregate(contexts, base, step)


def upserted_entities(entities: DataFrame, incoming: DataFrame, mode: str = "merge") -> DataFrame:
    """Entities after items (seq, name, type, context, acres, land_type) came in their order. Equal: name and type, exactly.

    merge: contexts fold in; the latest acres and land type that aren't null win. first: the first context stays.
    last: the last context wins. New entities get the ids after the largest, in the order of their first item.
    """
    named = incoming.where("coalesce(name, '') <> ''")
    item = F.struct("seq", "context", "acres", "land_type")
    ends = {"head": (F.min, item), "tail": (F.max, item), "acred": (F.max, F.when(F.col("acres").isNotNull(), item)), "landed": (F.max, F.when(F.col("land_type").isNotNull(), item))}
    # Many entities may have one name and take a copy of what comes for it: the ends, and in merging each context where it first comes.
    by = ["name", "type", "context"] if mode == "merge" else ["name", "type"]
    per = named.groupBy(*by).agg(*[how(x).alias(k) for k, (how, x) in ends.items()])
    if mode == "merge":
        told = F.when(F.coalesce("context", F.lit("")) != "", F.struct("head.seq", "context"))
        per = per.groupBy("name", "type").agg(*[how(k).alias(k) for k, (how, _) in ends.items()], F.sort_array(F.collect_list(told)).alias("told"))
        per = per.withColumn("told", F.transform("told", lambda i: i["context"]))
    both = entities.join(per.withColumn("seq", F.col("head.seq")), ["name", "type"], "full")
    known, came = F.col("id").isNotNull(), F.col("head").isNotNull()
    if mode == "merge":
        context = fold_contexts(F.coalesce("told", F.array().cast("array<string>")), F.col("context"))
    elif mode == "first":
        context = F.when(known, F.col("context")).otherwise(F.col("head.context"))
    else:
        context = F.when(came, F.col("tail.context")).otherwise(F.col("context"))
    acres, land = (F.coalesce("acred.acres", "acres"), F.coalesce("landed.land_type", "land_type")) if mode == "merge" else (F.coalesce("acres", "head.acres"), F.coalesce("land_type", "head.land_type"))
    out = both.select("id", "name", "type", context.alias("context"), acres.alias("acres"), land.alias("land_type"), "seq")
    top = entities.agg(F.max("id")).first()[0] or 0
    new = with_ids(out.where("id is null").drop("id"), ["seq", "name", "type"], top)
    columns = ["id", "name", "type", "context", "acres", "land_type"]
    return out.where("id is not null").select(*columns).unionByName(new.select(*columns))


def new_mentions(entities: DataFrame, incoming: DataFrame, mentions: DataFrame, parts: int = 16) -> DataFrame:
    """(entity_id, document_id, context) for incoming items, the first of each pair, where the pair isn't there yet.

    Many entities may have one name. So items are cut to the first of each name and document, and take along which
    entities of that name the document has already, before they meet the entities: what comes of that is the result and
    isn't shuffled. A name's items are dealt in ``parts``, by document.
    """
    ids = entities.select(F.col("id").alias("entity_id"), "name", "type")
    first = incoming.where("name is not null and type is not null").groupBy("name", "type", "document_id").agg(F.min_by("context", F.struct("seq", "context")).alias("context"))
    there = mentions.where("document_id is not null").select("entity_id", "document_id").join(ids, "entity_id").groupBy("name", "type", "document_id").agg(F.collect_set("entity_id").alias("known"))
    asked = first.join(there, ["name", "type", "document_id"], "left").withColumn("part", F.pmod(F.xxhash64("document_id"), F.lit(parts)).cast("int"))
    dealt = ids.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    met = asked.join(dealt, ["name", "type", "part"]).where(~F.coalesce(F.array_contains("known", F.col("entity_id")), F.lit(False)))
    return met.select("entity_id", "document_id", "context")


#: Required fields of a fact, and how item keys become columns in either dialect.
REQUIRED = {"fee_patents": ["allottee"], "correspondence": ["sender", "recipient"], "legislative_actions": ["bill_number", "action_type"], "testimony": ["witness"]}
RENAMED = {
    "fee_patents": {"allottee": "allottee_name", "trust_to_fee_mechanism": "mechanism", "subsequent_buyer": "buyer", "mortgage_amount": "mortgage"},
    "legislative_actions": {"action_date": "date"},
}
#: Columns that the upload flow doesn't fill.
NOT_UPLOADED = {"fee_patents": {"land_description", "patent_number", "sale_date", "mortgage_amount", "mortgage_holder"}, "legislative_actions": {"bill_title", "co_sponsors"}}


def fact_rows(items: DataFrame, table: str, flow: str = "pipeline", blank_action: bool = False) -> DataFrame:
    """Table rows of items. pipeline: rows without a required field drop out. loader: the field says "unknown" (an action
    type may stay empty), and a purpose goes to context. upload: like the pipeline, with fewer columns."""
    columns = [f.name for f in TABLES[table].fields if f.name not in ("id", "created_date", "document_id", "metadata")]
    have = set(items.columns)

    def value(c: str) -> Column:
        names = [n for n in (c, RENAMED.get(table, {}).get(c)) if n in have]
        if table == "financial_transactions" and flow == "loader" and c in ("context", "for_what"):
            return F.coalesce("description", "context") if c == "context" else F.lit(None).cast("string")
        if flow == "upload" and c in NOT_UPLOADED.get(table, set()) or not names:
            return F.lit(None).cast("string")
        return F.coalesce(*[F.col(n) for n in names])

    out = items.select("document_id", *[value(c).alias(c) for c in columns], *(["entities_involved"] if table == "events" and "entities_involved" in have else []))
    for c in REQUIRED.get(table, []):
        empty = F.coalesce(F.col(c), F.lit("")) == ""
        if flow == "loader":
            out = out.withColumn(c, F.when(empty, F.lit("" if c == "action_type" and blank_action else "unknown")).otherwise(F.col(c)))
        else:
            out = out.where(~empty)
    if table == "events":
        involved = F.col("entities_involved") if "entities_involved" in out.columns else F.lit(None).cast("array<string>")
        metadata = {"pipeline": F.to_json(F.coalesce(involved, F.array().cast("array<string>"))), "upload": F.to_json(F.struct(F.coalesce(involved, F.array().cast("array<string>")).alias("entities_involved"))), "loader": F.lit(None).cast("string")}[flow]
        out = out.withColumn("metadata", metadata).drop("entities_involved")
    return out


def involved_entities(metadata: Column) -> Column:
    """Entity names of an event from either shape of its metadata; null and other JSON give an empty list."""
    return F.coalesce(F.from_json(metadata, "array<string>"), F.from_json(metadata, "struct<entities_involved:array<string>>")["entities_involved"], F.array().cast("array<string>"))
