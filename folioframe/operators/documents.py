"""Corpus statistics, summaries, and documents with all that hangs on them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .retrieval import counted


def table_counts(tables: dict[str, DataFrame | None]) -> DataFrame:
    """(table_name, n_rows); a missing table counts 0."""
    spark = next(t for t in tables.values() if t is not None).sparkSession
    parts = [t.agg(F.count("*").alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows") if t is not None else spark.range(1).select(F.lit(n).alias("table_name"), F.lit(0).cast("long").alias("n_rows")) for n, t in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def type_counts(entities: DataFrame) -> DataFrame:
    """(type, n) of entities, most frequent first."""
    return entities.groupBy("type").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "type")


def texts_present(texts: DataFrame) -> DataFrame:
    return texts.agg(F.count(F.when(F.col("full_text").isNotNull() & (F.col("full_text") != ""), 1)).alias("n_with_text"))


def distinct_collections(documents: DataFrame) -> DataFrame:
    """How many collections there are; none counts as one of its own."""
    return documents.agg((F.countDistinct("collection") + F.max(F.when(F.col("collection").isNull(), 1).otherwise(0))).alias("n_collections"))


def summaries(documents: DataFrame, blank: bool = True) -> DataFrame:
    """Documents with a summary by (collection, file_name); without ``blank`` ones by id."""
    own = documents.where("summary is not null").select("id", "file_name", "display_title", "summary", "collection")
    if blank:
        return own.orderBy(F.asc_nulls_last("collection"), "file_name", "id")
    return own.where("summary <> ''").orderBy("id")


#: Columns of a bundle's lists, each sorted by what stands first.
BUNDLE = {
    "events": ("date", "type", "location", "description"),
    "financial_transactions": ("date", "amount", "type", "payer", "payee", "for_what"),
    "relationships": ("subject", "type", "object", "context"),
}


def bundles(documents: DataFrame, entities: DataFrame, mentions: DataFrame, facts: dict[str, DataFrame], ids: list[int] | None = None, numbers: dict[str, DataFrame] | None = None) -> DataFrame:
    """Documents with their entities, events, transactions and relationships as sorted arrays of structs; an absent id gives no row.

    One grouped join a child instead of a query a document. With ``ids`` every child is filtered first. Children in
    ``numbers`` come as how many there are, under their names, so their fields are neither read nor shuffled.
    """
    pick = lambda df, col: df.where(F.col(col).isin(ids)) if ids is not None else df
    out = pick(documents, "id")
    linked = pick(mentions, "document_id").select("entity_id", "document_id").join(entities.select(F.col("id").alias("entity_id"), "type", "name", "context"), "entity_id")
    children = {"entities": linked.select(F.col("document_id").alias("id"), F.struct("type", "name", "context").alias("x"))}
    for name, columns in BUNDLE.items():
        if name in facts:
            children[name] = pick(facts[name], "document_id").select(F.col("document_id").alias("id"), F.struct(*columns).alias("x"))
    for name, child in children.items():
        kind = child.schema["x"].dataType.simpleString()
        per = child.groupBy("id").agg(F.sort_array(F.collect_list("x")).alias(name))
        out = out.join(per, "id", "left").withColumn(name, F.coalesce(name, F.array().cast(f"array<{kind}>")))
    return counted(out, {name: pick(child, "document_id") for name, child in (numbers or {}).items()})


def documents_by_names(documents: DataFrame, names: list[str]) -> DataFrame:
    """Documents in the order of a list of file names; of documents with one name the largest id, and a name once a mention."""
    spark = documents.sparkSession
    asked = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "pos int, file_name string")
    found = documents.where(F.col("file_name").isin(names)).groupBy("file_name").agg(F.max("id").alias("id"))
    return asked.join(found, "file_name").join(documents.drop("file_name"), "id").orderBy("pos")


def bundles_by_names(documents: DataFrame, entities: DataFrame, mentions: DataFrame, facts: dict[str, DataFrame], names: list[str]) -> DataFrame:
    """Bundles of documents, with ``pos``, in the order of a list of file names (see ``documents_by_names``); children are filtered by the ids first."""
    found = documents_by_names(documents.select("id", "file_name"), names).select("pos", "id")
    ids = sorted({r.id for r in found.collect()})  # as many as there are names
    return found.join(bundles(documents, entities, mentions, facts, ids), "id").orderBy("pos")


def without_read(rows: DataFrame, read: list[str]) -> DataFrame:
    """What documents already read don't cover: entities with a source file outside them, or facts of other files."""
    if "source_files" in rows.columns:
        return rows.where(F.exists("source_files", lambda f: ~f.isin(read)))
    return rows.where(F.col("file_name").isNull() | ~F.col("file_name").isin(read))


__all__ = ["bundles", "bundles_by_names", "counted", "distinct_collections", "documents_by_names", "summaries", "table_counts", "texts_present", "type_counts", "without_read"]
