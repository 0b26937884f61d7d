"""Term search over entities and fact tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import any_ilike, query_terms
from ..shared import written


@dataclass(frozen=True)
class FactSearch:
    """Columns that are searched and returned, and the text order of the result."""

    table: str
    searched: tuple[str, ...]
    returned: tuple[str, ...]
    order: tuple[str, ...]
    limit: int


SEARCHES = {
    s.table: s
    for s in (
        FactSearch("events", ("description", "type", "location"), ("type", "date", "location", "description", "metadata"), ("date",), 100),
        FactSearch("financial_transactions", ("payer", "payee", "for_what", "context"), ("amount", "type", "payer", "payee", "for_what", "date", "context"), ("date",), 50),
        FactSearch("relationships", ("subject", "object", "type", "context"), ("type", "subject", "object", "context"), ("subject", "type"), 100),
        FactSearch("fee_patents", ("allottee", "allotment_number", "subsequent_buyer", "attorney", "trust_to_fee_mechanism", "context"), ("allottee", "allotment_number", "acreage", "land_description", "patent_date", "patent_number", "trust_to_fee_mechanism", "subsequent_buyer", "sale_price", "sale_date", "attorney", "mortgage_amount", "mortgage_holder", "context"), ("patent_date",), 50),
        FactSearch("correspondence", ("sender", "recipient", "sender_title", "recipient_title", "subject", "context"), ("sender", "sender_title", "recipient", "recipient_title", "date", "subject", "action_requested", "outcome", "context"), ("date",), 50),
        FactSearch("legislative_actions", ("bill_number", "bill_title", "sponsor", "action_type", "outcome", "context"), ("bill_number", "bill_title", "sponsor", "co_sponsors", "action_type", "action_date", "vote_count", "committee", "outcome", "context"), ("action_date",), 50),
        FactSearch("testimony", ("witness", "witness_title", "subject", "key_claims", "committee", "location"), ("witness", "witness_title", "hearing", "committee", "location", "date", "subject", "key_claims", "questioner"), ("date",), 50),
        FactSearch("taxes", ("taxpayer", "land_description", "tax_type", "county", "status", "context"), ("taxpayer", "land_description", "tax_type", "amount", "year", "status", "county", "context"), ("year",), 50),
        FactSearch("mortgages", ("borrower", "lender", "land_description", "status", "context", "amount"), ("borrower", "lender", "amount", "land_description", "acreage", "date", "interest_rate", "status", "context"), ("date",), 50),
    )
}


def search_facts(facts: DataFrame, documents: DataFrame, query: str, search: FactSearch, limit: int | None = None) -> DataFrame:
    """Facts with a term of the query in a searched column, with their document's names.

    Facts without a document drop out. Order: the search's text columns, nulls last, then id. Filter and projection
    come before the join, and the limit is a top-k, so neither side is sorted whole.
    """
    found = facts.where(any_ilike(list(search.searched), query_terms(query))).select("id", "document_id", *search.returned)
    names = documents.select(F.col("id").alias("document_id"), "file_name", "display_title")
    order = [F.col(c).asc_nulls_last() for c in search.order]
    return found.join(names, "document_id").select("id", *search.returned, "file_name", "display_title").orderBy(*order, "id").limit(limit or search.limit)


def search_entities(entities: DataFrame, mentions: DataFrame, documents: DataFrame, query: str, limit: int = 200) -> DataFrame:
    """Entities with a term in name or context: documents they are in, source files, and a relevance score.

    Score: documents, plus 1000 for a person whose name holds a term or 500 for another such entity. Entities without
    mentions have no source files (an empty list). Order: score, name, id.

    Mentions are cut to the found entities before they are told apart, and only the first entities meet their documents:
    what the plan below gives is a written table of at most ``limit`` rows, however often it is read.
    """
    terms = query_terms(query)
    found = written(entities.where(any_ilike(["name", "context"], terms)).select("id", "name", "type", "context"), "found")
    own = lambda of: mentions.select("entity_id", "document_id").join(of.select(F.col("id").alias("entity_id")), "entity_id", "left_semi").withColumnRenamed("entity_id", "id")
    # Copies of a pair go first: a count of distinct ones then needs no second shuffle of all.
    counts = own(found).where("document_id is not null").distinct().groupBy("id").agg(F.count("*").alias("doc_count"))
    named = any_ilike(["name"], terms)
    bonus = F.when(named & (F.col("type") == "person"), 1000).when(named, 500).otherwise(0)
    order = [F.desc("relevance_score"), F.col("name"), F.col("id")]
    scored = found.join(counts, "id", "left").withColumn("doc_count", F.coalesce("doc_count", F.lit(0).cast("long"))).withColumn("relevance_score", bonus + F.col("doc_count"))
    first = written(scored.orderBy(*order).limit(limit), "first")
    pairs = written(own(first).where("document_id is not null").distinct(), "pairs")
    shown = documents.select(F.col("id").alias("document_id"), F.coalesce("display_title", "file_name").alias("source"))
    shown = shown.join(pairs.select("document_id"), "document_id", "left_semi")
    sources = pairs.join(shown, "document_id").groupBy("id").agg(F.sort_array(F.collect_set("source")).alias("source_files"))
    whole = first.join(sources, "id", "left").withColumn("source_files", F.coalesce("source_files", F.array().cast("array<string>")))
    return written(whole.select("id", "name", "type", "context", "doc_count", "source_files", "relevance_score"), "entities").orderBy(*order)


def entity_network(entities: DataFrame, mentions: DataFrame, names: list[str], limit: int = 50) -> DataFrame:
    """For each name, the entities that share documents with an entity whose name holds it, by shared documents.

    All names are served by one self-join of the mentions, which are cut first to the searched entities and then to their
    documents; pairs are counted before names are joined.
    """
    asked = entities.select(F.col("id").alias("own"), "name").where(any_ilike(["name"], names))
    which = F.array_compact(F.array(*[F.when(F.col("name").ilike(f"%{n}%"), F.lit(n)) for n in names]))
    own = written(asked.select("own", F.explode(which).alias("searched")), "asked")
    edges = mentions.select("entity_id", "document_id")
    mine = edges.join(own.select(F.col("own").alias("entity_id")), "entity_id", "left_semi").distinct().withColumnRenamed("entity_id", "own")
    left = written(own.join(mine, "own").select("searched", "own", "document_id"), "linked")
    near = edges.join(left.select("document_id"), "document_id", "left_semi").distinct()
    shared = left.join(near, "document_id").where("entity_id <> own").groupBy("searched", "entity_id").agg(F.countDistinct("document_id").alias("shared_docs"))
    top = shared.join(entities.select(F.col("id").alias("entity_id"), "name", "type", "context"), "entity_id")
    if len(names) == 1:
        return top.select("searched", "entity_id", "name", "type", "context", "shared_docs").orderBy(F.desc("shared_docs"), "name", "entity_id").limit(limit)
    rank = F.row_number().over(Window.partitionBy("searched").orderBy(F.desc("shared_docs"), "name", "entity_id"))
    return top.withColumn("n", rank).where(F.col("n") <= limit).select("searched", "entity_id", "name", "type", "context", "shared_docs")


def network_candidates(found: DataFrame, least_docs: int = 2, most: int = 10, first: int = 5) -> list[str]:
    """Names of the first persons in a search result, where their number is neither none nor over ``most``."""
    rows = found.where((F.col("type") == "person") & (F.col("doc_count") >= least_docs)).orderBy(F.desc("relevance_score"), "name", "id").select("name").limit(most + 1).collect()
    return [r[0] for r in rows[:first]] if 1 <= len(rows) <= most else []
