"""Context for a language model, assembled as text from evidence tables. Sections keep to caps of their own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import allowance, doc_date, label, tokens_by_chars, truncated
from ..shared import written
from .documents import without_read
from .ordering import numbered

_or = lambda c, default="": F.coalesce(F.col(c), F.lit(default))
_source = lambda: F.concat(F.lit("Source: "), label(F.col("display_title"), F.col("file_name")))


def capped(rows: DataFrame, per: list[str], order: list[Column], most: int) -> DataFrame:
    """The first rows of each group, with their place ``n``."""
    n = F.row_number().over(Window.partitionBy(*per).orderBy(*order))
    return rows.withColumn("n", n).where(F.col("n") <= most)


def section(title: str, lines: DataFrame, total: int | None = None) -> DataFrame:
    """One row of text from (n, line): a title with the total, then the lines in their order; no row where there is no line."""
    per = lines.agg(F.sort_array(F.collect_list(F.struct("n", "line"))).alias("x"), F.count("*").alias("total"))
    head = F.concat(F.lit(title), F.lit(" ("), F.lit(total) if total is not None else F.col("total"), F.lit(" total):\n"))
    return per.where("total > 0").select(F.concat(head, F.array_join(F.transform("x", lambda i: i["line"]), "\n")).alias("text"))


def _line(kind: str) -> Column:
    """How a fact is shown."""
    cut = lambda c, n: F.left(_or(c), F.lit(n))
    return {
        "events": F.concat(F.lit("  - ["), _or("date", "n/d"), F.lit("] "), _or("type"), F.lit(": "), cut("description", 200), F.lit("\n    Location: "), _or("location", "n/a"), F.lit(" | "), _source()) if kind == "events" else None,
        "financial_transactions": F.concat(F.lit("  - ["), _or("date", "n/d"), F.lit("] "), _or("type"), F.lit(": "), _or("payer", "?"), F.lit(" → "), _or("payee", "?"), F.lit(", Amount: "), _or("amount", "n/a"), F.lit("\n    For: "), _or("for_what", "n/a"), F.lit(" | Context: "), cut("context", 150), F.lit(" | "), _source()) if kind == "financial_transactions" else None,
        "relationships": F.concat(F.lit("  - "), _or("subject", "?"), F.lit(" —["), _or("type", "?"), F.lit("]→ "), _or("object", "?"), F.lit("\n    Context: "), cut("context", 150), F.lit(" | "), _source()) if kind == "relationships" else None,
    }[kind]


FACT_SECTIONS = {"events": ("EVENTS", 40, ("date",)), "financial_transactions": ("FINANCIAL TRANSACTIONS", 30, ("date",)), "relationships": ("RELATIONSHIPS", 40, ("subject", "type"))}
#: Shown as "key: value" parts, with how many rows.
PART_SECTIONS = {
    "fee_patents": ("FEE PATENTS", 30, "patent_date", {"allottee": "", "allotment_number": "Allotment: ", "acreage": "Acreage: ", "patent_date": "Patent date: ", "trust_to_fee_mechanism": "Mechanism: ", "subsequent_buyer": "Sold to: ", "sale_price": "Sale price: ", "attorney": "Attorney: ", "mortgage_amount": "Mortgage: "}),
    "correspondence": ("CORRESPONDENCE", 30, "date", {"date": "", "sender": "From: ", "sender_title": "", "recipient": "To: ", "recipient_title": "", "subject": "Subject: ", "action_requested": "Action requested: ", "outcome": "Outcome: "}),
    "legislative_actions": ("LEGISLATIVE ACTIONS", 30, "action_date", {"bill_number": "", "action_type": "", "action_date": "", "bill_title": "Title: ", "sponsor": "Sponsor: ", "vote_count": "Vote: ", "committee": "Committee: ", "outcome": "Outcome: "}),
}


def fact_lines(rows: DataFrame, kind: str) -> DataFrame:
    """(n, line) of a section's first facts."""
    if kind in FACT_SECTIONS:
        _, most, order = FACT_SECTIONS[kind]
        line = _line(kind)
    else:
        _, most, by, parts = PART_SECTIONS[kind]
        order = (by,)
        shown = [F.when(_or(c) != "", F.concat(F.lit(p), F.left(c, F.lit(200)))) for c, p in parts.items()]
        line = F.concat(F.lit("  - "), F.concat_ws(" | ", *shown), F.lit("\n    "), _source())
    first = rows.orderBy(*[F.asc_nulls_last(c) for c in order], "id").limit(most)
    n = F.row_number().over(Window.orderBy(*[F.asc_nulls_last(c) for c in order], "id"))
    return first.select(n.alias("n"), line.alias("line"))


def entity_lines(entities: DataFrame, per_type: int = 25) -> DataFrame:
    """(n, line) of the first entities of each type, with up to three sources."""
    first = capped(entities, ["type"], [F.desc("relevance_score"), F.col("name"), F.col("id")], per_type)
    sources = F.when(F.size("source_files") > 0, F.array_join(F.slice("source_files", 1, 3), ", ")).otherwise(F.lit("unknown"))
    line = F.concat(F.lit("  ["), F.upper("type"), F.lit("] "), F.col("name"), F.lit(" (in "), F.col("doc_count"), F.lit(" docs): "), F.left(_or("context"), F.lit(200)), F.lit("\n      Sources: "), sources)
    return first.select(F.row_number().over(Window.orderBy("type", "n")).alias("n"), line.alias("line"))


def discovery_context(evidence: dict[str, DataFrame]) -> str:
    """Sections in order: passages, entities, facts, networks, documents. Testimony, taxes and mortgages are searched but not shown."""
    parts: list[DataFrame] = []
    if "passages" in evidence:
        rows = evidence["passages"].select("id", label(F.col("display_title"), F.col("file_name")).alias("label"), "rank", F.posexplode("passages").alias("i", "p"))
        cut = F.when(F.length("p.text") > 800, F.concat(F.left("p.text", F.lit(800)), F.lit("..."))).otherwise(F.col("p.text"))
        order = Window.orderBy(F.desc("rank"), "id", "i")
        parts.append(section("PASSAGES", rows.select(F.row_number().over(order).alias("n"), F.concat(F.lit("  === "), F.col("label"), F.lit(" === [Passage "), F.col("i") + 1, F.lit("]:\n  "), cut).alias("line"))))
    if "entities" in evidence:
        parts.append(section("EXTRACTED ENTITIES", entity_lines(evidence["entities"]), evidence["entities"].count()))
    for kind in (*FACT_SECTIONS, *PART_SECTIONS):
        if kind in evidence:
            parts.append(section((FACT_SECTIONS.get(kind) or PART_SECTIONS[kind])[0], fact_lines(evidence[kind], kind), evidence[kind].count()))
    if "network" in evidence:
        first = capped(evidence["network"], ["searched"], [F.desc("shared_docs"), F.col("name"), F.col("entity_id")], 15)
        parts.append(section("ENTITY NETWORKS", first.select(F.row_number().over(Window.orderBy("searched", "n")).alias("n"), F.concat(F.lit("  "), F.col("searched"), F.lit(": "), F.col("name"), F.lit(" ("), F.col("type"), F.lit("): "), F.col("shared_docs"), F.lit(" shared documents")).alias("line"))))
    if "documents" in evidence:
        first = evidence["documents"].limit(25)
        parts.append(section("DOCUMENTS", first.select(F.row_number().over(Window.orderBy(F.desc("rank"), F.desc("entity_count"), "id")).alias("n"), F.concat(F.lit("  - "), label(F.col("display_title"), F.col("file_name"))).alias("line"))))
    return "\n\n".join(r[0] for p in parts for r in p.collect())


def _listed(title: str, column: str, most: int, show) -> Column:
    some = F.slice(F.col(column), 1, most)
    return F.when(F.size(column) > 0, F.concat(F.lit(f"\n{title}:\n"), F.array_join(F.transform(some, show), "\n"))).otherwise(F.lit(""))


def deep_read_context(bundles: DataFrame, most_tokens: int = 160_000, entities: int = 1_000_000, others: int = 1_000_000) -> DataFrame:
    """(id, context) of document bundles: a head, the text up to a budget, and what was extracted from it."""
    text = truncated(F.coalesce("full_text", F.lit("")), most_tokens, "\n\n[... document truncated ...]")
    head = F.concat(F.lit("DOCUMENT: "), label(F.col("display_title"), F.col("file_name")), F.lit("\nCollection: "), _or("collection", "n/a"), F.lit("\nPages (about): "), F.greatest(F.lit(1), F.floor(F.length(F.coalesce("full_text", F.lit(""))) / 3000)), F.lit("\n\n"))
    nz = lambda c: F.coalesce(c, F.lit(""))
    lists = F.concat(
        _listed("ENTITIES", "entities", entities, lambda e: F.concat(F.lit("  - ["), nz(e["type"]), F.lit("] "), nz(e["name"]))),
        _listed("EVENTS", "events", others, lambda e: F.concat(F.lit("  - "), nz(e["date"]), F.lit(" "), nz(e["type"]), F.lit(": "), nz(e["description"]))),
        _listed("TRANSACTIONS", "financial_transactions", others, lambda e: F.concat(F.lit("  - "), nz(e["date"]), F.lit(" "), nz(e["payer"]), F.lit(" → "), nz(e["payee"]), F.lit(" "), nz(e["amount"]))),
        _listed("RELATIONSHIPS", "relationships", others, lambda e: F.concat(F.lit("  - "), nz(e["subject"]), F.lit(" "), nz(e["type"]), F.lit(" "), nz(e["object"]))),
    )
    return bundles.select("id", F.concat(head, text, lists).alias("context"))


#: What other documents say beside those read whole: titles, how many lines, and their order (fixed values).
ADDITIONAL = {
    "entities": ("ADDITIONAL ENTITIES FROM OTHER DOCUMENTS", 40, (F.desc, "relevance_score"), (F.asc, "name"), (F.asc, "id")),
    "financial_transactions": ("ADDITIONAL TRANSACTIONS FROM OTHER DOCUMENTS", 20, (F.asc_nulls_last, "date"), (F.asc, "id")),
    "relationships": ("ADDITIONAL RELATIONSHIPS FROM OTHER DOCUMENTS", 20, (F.asc_nulls_last, "subject"), (F.asc_nulls_last, "type"), (F.asc, "id")),
}


def _additional_line(kind: str) -> Column:
    if kind == "entities":
        sources = F.array_join(F.slice("source_files", 1, 3), ", ")
        return F.concat(F.lit("  - "), F.col("name"), F.lit(" ("), _or("type"), F.lit("): "), F.left(_or("context"), F.lit(120)), F.lit(" | Sources: "), sources)
    if kind == "financial_transactions":
        return F.concat(F.lit("  - ["), _or("date", "n/d"), F.lit("] "), _or("payer", "?"), F.lit(" → "), _or("payee", "?"), F.lit(": "), _or("amount", "?"), F.lit(" | "), label(F.col("display_title"), F.col("file_name")))
    return F.concat(F.lit("  - "), _or("subject", "?"), F.lit(" —["), _or("type"), F.lit("]→ "), _or("object", "?"), F.lit(" | "), label(F.col("display_title"), F.col("file_name")))


def additional_sections(evidence: dict[str, DataFrame], read: list[str]) -> list[DataFrame]:
    """A row (n, text) a section of what a search found in documents that weren't read whole: entities that also come from
    another document, facts of others, and the networks of persons. A section without lines has no row."""
    parts: list[DataFrame] = []
    for i, (kind, (title, most, *order)) in enumerate(ADDITIONAL.items()):
        if kind not in evidence:
            continue
        rest = written(without_read(evidence[kind], read), "rest")  # a search's first rows, read twice below
        by = [way(c) for way, c in order]
        first = rest.orderBy(*by).limit(most).select(F.row_number().over(Window.orderBy(*by)).alias("n"), _additional_line(kind).alias("line"))
        per = first.agg(F.sort_array(F.collect_list(F.struct("n", "line"))).alias("x")).where(F.size("x") > 0)
        total = rest.agg(F.count("*").alias("total"))
        whole = per.withColumn("k", F.lit(1)).join(total.withColumn("k", F.lit(1)), "k")
        parts.append(whole.select(F.lit(i + 1).alias("n"), F.concat(F.lit(f"{title} ("), "total", F.lit("):\n"), F.array_join(F.transform("x", lambda r: r["line"]), "\n")).alias("text")))
    if "network" in evidence:
        first = capped(evidence["network"], ["searched"], [F.desc("shared_docs"), F.col("name"), F.col("entity_id")], 10)
        each = first.groupBy("searched").agg(F.sort_array(F.collect_list(F.struct("n", F.concat(F.lit("    - "), "name", F.lit(" ("), _or("type"), F.lit("): "), "shared_docs", F.lit(" shared docs")).alias("line")))).alias("x"))
        lines = each.select("searched", F.concat(F.lit("\n  Network for "), "searched", F.lit(":\n"), F.array_join(F.transform("x", lambda r: r["line"]), "\n")).alias("line"))
        per = lines.agg(F.sort_array(F.collect_list(F.struct("searched", "line"))).alias("x")).where(F.size("x") > 0)
        parts.append(per.select(F.lit(len(ADDITIONAL) + 1).alias("n"), F.concat(F.lit("ENTITY NETWORKS:\n"), F.array_join(F.transform("x", lambda r: r["line"]), "\n")).alias("text")))
    return parts


def hybrid_context(bundles: DataFrame, n_documents: int, cap: int = 170_000, more: list[DataFrame] | None = None) -> DataFrame:
    """One row: the documents' contexts joined, each within its allowance, 30 entities and 15 of the rest a document, then
    the sections (n, text) of what other documents add; capped as a whole."""
    each = deep_read_context(bundles.where("full_text <> ''"), allowance(n_documents), 30, 15)
    rows = each.select(F.lit(0).alias("n"), "id", F.col("context").alias("text"))
    for section_rows in more or []:
        rows = rows.unionByName(section_rows.select("n", F.lit(0).cast("long").alias("id"), "text"))
    joined = rows.agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("n", "id", "text"))), lambda x: x["text"]), "\n\n").alias("context"))
    return joined.select(truncated(F.col("context"), cap, "\n\n[... context truncated ...]").alias("context"))


def corpus_lines(documents: DataFrame, dates: bool = True, by_id: bool = False) -> DataFrame:
    """(n, id, line) of all summaries: a header where the collection changes, then "[Doc id] name (date)" and the summary.

    Lines are numbered over range partitions; whether the collection changes at a partition's start is told by the last
    row of the one before.
    """
    order = [F.col("id").asc()] if by_id else [F.asc_nulls_last("collection"), F.asc("file_name"), F.asc("id")]
    group = F.coalesce("collection", F.lit("Unknown"))
    own = documents.where("summary is not null" + (" and summary <> ''" if by_id else "")).select("id", "file_name", "display_title", "summary", "collection")
    placed = numbered(own, order, "n", before=group)
    changed = F.coalesce(F.col("before") != group, F.lit(True))
    date = F.when(doc_date(F.col("file_name")) != "", F.concat(F.lit(" ("), doc_date(F.col("file_name")), F.lit(")"))).otherwise(F.lit("")) if dates else F.lit("")
    line = F.concat(F.when(changed, F.concat(F.lit("=== "), group, F.lit(" ===\n"))).otherwise(F.lit("")), F.lit("[Doc "), F.col("id"), F.lit("] "), label(F.col("display_title"), F.col("file_name")), date, F.lit("\n"), F.col("summary"))
    return placed.select("n", "id", line.alias("line"))


def corpus_context(documents: DataFrame, **how) -> DataFrame:
    """One row with the joined lines and the estimated tokens: the text is a model's input, so it is one value by nature."""
    lines = corpus_lines(documents, **how).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("n", "line"))), lambda x: x["line"]), "\n\n").alias("context"))
    return lines.withColumn("est_tokens", tokens_by_chars(F.col("context")))
