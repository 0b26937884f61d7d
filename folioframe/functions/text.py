"""Text functions as column expressions. Whitespace, case and lengths follow Unicode code points."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that count for nothing in term frequencies (fixed values).
STOP_WORDS = [
    "the", "and", "for", "are", "but", "not", "you", "all", "can", "had",
    "her", "was", "one", "our", "out", "has", "have", "been", "some", "them",
    "than", "its", "over", "such", "that", "this", "with", "will", "each",
    "make", "from", "they", "also", "many", "then", "what", "when",
    "who", "how", "which", "their", "said", "were", "into", "more", "other",
    "about", "would", "there", "could", "after", "should", "these", "where",
    "being", "those", "still", "between", "tell", "know", "consider",
    "look", "find", "evidence", "discuss", "describe", "explain",
]


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once however often it is used."""
    return F.get(F.transform(F.array(value), lambda v: use(v)), F.lit(0))


def query_terms(query: str) -> list[str]:
    """Words of over two characters; where there is none, the query itself."""
    return [t for t in query.split() if len(t) > 2] or [query.strip()]


def content_terms(query: str) -> list[str]:
    """Query terms less stop words; where none is left, all terms."""
    terms = query_terms(query)
    return [t for t in terms if t.lower() not in STOP_WORDS and len(t) > 2] or terms


def any_ilike(columns: list[str | Column], terms: list[str]) -> Column:
    """Any column holds any term, in any case. ``%`` and ``_`` in a term stay wildcards; null columns are false."""
    hits = [(F.col(c) if isinstance(c, str) else c).ilike(f"%{t}%") for c in columns for t in terms]
    return F.coalesce(reduce(lambda a, b: F.coalesce(a, F.lit(False)) | F.coalesce(b, F.lit(False)), hits), F.lit(False))


def strip(c: Column) -> Column:
    """Leading and trailing whitespace goes, no-break spaces and tabs too."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def occurrences(text: Column, term: str) -> Column:
    """How often a non-empty term occurs without overlap, in any case."""
    low, t = F.lower(text), term.lower()
    return ((F.length(low) - F.length(F.replace(low, F.lit(t), F.lit("")))) / F.lit(max(1, len(t)))).cast("long")


def term_hits(text: Column, terms: list[str]) -> Column:
    return F.coalesce(reduce(lambda a, b: a + b, [occurrences(text, t) for t in terms]), F.lit(0).cast("long"))


def word_count(text: Column) -> Column:
    return F.size(F.filter(F.split(text, r"(?U)\s+"), lambda w: w != ""))


def label(display_title: Column, file_name: Column) -> Column:
    """The title, or where it is null or empty the file name."""
    return F.coalesce(F.nullif(display_title, F.lit("")), file_name)


def doc_date(file_name: Column) -> Column:
    """"c. 19xx" or "c. 19xx-yy" for the first year, or range, that stands as a word in a file name; else empty."""
    year = F.regexp_extract(file_name, r"\b(1[89]\d{2}(?:\s*[-–]\s*\d{2,4})?)\b", 1)
    return F.when(year != "", F.concat(F.lit("c. "), year)).otherwise(F.lit(""))


def centuries(text: Column) -> Column:
    """The first two digits of the years in the opening 5,000 characters, distinct and sorted."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(F.left(text, F.lit(5000)), F.lit(r"\b(19|20)\d{2}\b"), 1)))


def escape_dollars(text: Column) -> Column:
    return F.replace(text, F.lit("$"), F.lit("\\$"))


# Four estimates of model tokens that are used in different places and stay apart.
def tokens_by_chars(text: Column) -> Column:
    return F.floor(F.length(text) / F.lit(3.2))


def tokens_by_four(text: Column) -> Column:
    return F.floor(F.length(text) / F.lit(4))


def tokens_by_words(text: Column) -> Column:
    return F.floor(word_count(text) * F.lit(1.33))


def tokens_exported(prompt: Column, completion: Column) -> Column:
    return (F.length(prompt) + F.length(completion)) / F.lit(4)


def pages(text: Column) -> Column:
    return F.greatest(F.lit(1), F.floor(F.length(text) / F.lit(3000)))


def truncated(text: Column, tokens: int, marker: str) -> Column:
    """At most int(tokens * 3.2) characters, with a marker where something was cut."""
    most = int(tokens * 3.2)
    return F.when(F.length(text) > most, F.concat(F.left(text, F.lit(most)), F.lit(marker))).otherwise(text)


def allowance(n_documents: int, each: int = 45_000, together: int = 130_000) -> int:
    """Tokens for each document of a joint context."""
    return min(each, together // max(1, n_documents))


# Evidence metrics of a written answer: month names, patterns and section titles (fixed values).
_MONTHS = "January|February|March|April|May|June|July|August|September|October|November|December"
EVIDENCE = {
    "dollar_amounts": r"\$[\d,]+(?:\.\d{2})?",
    "acreage_mentions": r"(?i)[\d,]+\s*acres?",
    "dates": rf"\b(?:{_MONTHS})\s+\d{{1,2}},?\s+\d{{4}}",
    "bill_numbers": r"[SH]\.?\s*(?:R\.)?\s*\d+",
    "allotment_numbers": r"(?i)(?:allot(?:ment|tee)?|No\.)\s*#?\s*\d+",
}
SECTIONS = {"has_prove": "what the documents prove", "has_suggest": "what the documents suggest", "has_gaps": "gaps in the record"}


def evidence(text: Column) -> dict[str, Column]:
    """Word count, distinct cited documents, counts of evidence and presence of sections; null texts have none."""
    t = F.coalesce(text, F.lit(""))
    out = {"word_count": word_count(t), "doc_citations": F.size(F.array_distinct(F.regexp_extract_all(t, F.lit(r"\[Doc\s+(\d+)"), 1)))}
    out |= {k: F.regexp_count(t, F.lit(p)) for k, p in EVIDENCE.items()}
    return out | {k: F.contains(F.lower(t), F.lit(s)) for k, s in SECTIONS.items()}
