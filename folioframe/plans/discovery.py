"""Question-driven flows: discovery, deep read, both together, and whole-corpus synthesis."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import context, documents, retrieval, search
from ..sources.corpus_view import Corpus
from .prompts import analysis_prompt


def discover(corpus: Corpus, query: str, max_docs: int = 30, per_doc: int = 5) -> dict[str, DataFrame]:
    """All evidence for a question, lazily: ten searches, passages, documents, and the networks of up to five persons in one join."""
    evidence = {"entities": search.search_entities(corpus["entities"], corpus["mentions"], corpus["documents"], query)}
    for name, how in search.SEARCHES.items():
        if name in corpus:
            evidence[name] = search.search_facts(corpus[name], corpus["documents"], query, how)
    if "texts" in corpus:
        evidence["passages"] = retrieval.search_passages(corpus["texts"], corpus["mentions"], query, max_docs, per_doc)
        evidence["documents"] = retrieval.search_documents(corpus["texts"], corpus["mentions"], query)
    names = search.network_candidates(evidence["entities"])
    if names:
        evidence["network"] = search.entity_network(corpus["entities"], corpus["mentions"], names)
    return evidence


def evidence_counts(evidence: dict[str, DataFrame]) -> DataFrame:
    return documents.table_counts(dict(evidence))


def deep_read(corpus: Corpus, ids: list[int]) -> DataFrame:
    """Bundles of documents: texts with what was extracted from them."""
    facts = {k: corpus[k] for k in documents.BUNDLE if k in corpus}
    return documents.bundles(corpus["texts"], corpus["entities"], corpus["mentions"], facts, ids)


def hybrid(corpus: Corpus, query: str, k: int = 5) -> DataFrame:
    """The context of the k documents that rank highest for reading in full, and of what other documents add to them."""
    ranked = retrieval.rank_documents(corpus["texts"], corpus["mentions"], corpus["financial_transactions"], corpus["relationships"], query).limit(k)
    chosen = ranked.select("id", "file_name").collect()  # k rows
    evidence = {"entities": search.search_entities(corpus["entities"], corpus["mentions"], corpus["documents"], query)}
    for name in ("financial_transactions", "relationships"):
        evidence[name] = search.search_facts(corpus[name], corpus["documents"], query, search.SEARCHES[name])
    if names := search.network_candidates(evidence["entities"]):
        evidence["network"] = search.entity_network(corpus["entities"], corpus["mentions"], names)
    more = context.additional_sections(evidence, [r.file_name for r in chosen])
    return context.hybrid_context(deep_read(corpus, [r.id for r in chosen]), len(chosen), more=more)


def corpus_prompt(summarised: DataFrame, question: str) -> DataFrame:
    own = context.corpus_context(summarised)
    return own.select(analysis_prompt("corpus", question, F.col("context")).alias("prompt"), "est_tokens")
