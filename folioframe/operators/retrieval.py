"""Full-text match and rank, passages, document search and ranking."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.stem import cover_density
from ..functions.text import any_ilike, bound, content_terms, query_terms, strip, term_hits
from .fulltext import NO_HITS, every_alternative_wants, holds, n_wanted, occurrences, parse, query_stems, stem_hits, stem_table, tokens
from ..shared import written
from .ordering import free_name

#: Lower-case name parts of finding aids and reference lists, which ranking leaves out (fixed values).
REFERENCE_NAMES = ["finding aid", "archives west", "haley papers", "mansfield papers"]


def parse_query(query: str) -> list[list[tuple[bool, list[str]]]]:
    """A web-style query as alternatives of (wanted, words): bare words and "phrases" are joined by and, ``or`` separates, ``-`` negates."""
    return [[(wanted, [w for _, w in words]) for wanted, words in g] for g in parse(query)]


def match(token_column: Column, query: str) -> Column:
    """Whether tokens satisfy the query as they stand; a query of stop words alone matches nothing."""
    flat = F.concat(F.lit(" "), F.array_join(token_column, " "), F.lit(" "))

    def atom(wanted: bool, words: list[str]) -> Column:
        hit = F.array_contains(token_column, words[0]) if len(words) == 1 else F.contains(flat, F.lit(f" {' '.join(words)} "))
        return hit if wanted else ~hit

    groups = [reduce(lambda a, b: a & b, [atom(*a) for a in g]) for g in parse_query(query)]
    return reduce(lambda a, b: a | b, groups) if groups else F.lit(False)


def rank(token_column: Column, query: str) -> Column:
    """Cover density of the wanted words, as they stand."""
    words = list(dict.fromkeys(w for g in parse_query(query) for wanted, ws in g if wanted for w in ws))
    if len(words) <= 1:
        r = F.size(F.filter(token_column, lambda t: t.isin(words))) * F.lit(0.1)
        return r / (r + 1)
    known = F.array(*map(F.lit, words))
    placed = F.transform(token_column, lambda t, i: F.struct(i.alias("pos"), (F.array_position(known, t) - 1).cast("int").alias("term")))
    return cover_density(F.filter(placed, lambda h: h["term"] >= 0), len(words))


def with_tokens(texts: DataFrame) -> DataFrame:
    """Texts with their tokens."""
    return texts.withColumn("tokens", tokens(F.col("full_text")))


def matched(texts: DataFrame, query: str, stemmed: bool = False, or_else: Column | None = None, places: DataFrame | None = None, stems: DataFrame | None = None) -> DataFrame:
    """Texts that match, or that ``or_else`` holds for, with their rank as ``fts``.

    Plain: a generator yields a text's tokens if they match, so they are made once; as a column and a filter, the filter
    would be pushed below the column and the text be cut into tokens twice. Stemmed: the places of the query's stems come
    from ``places`` (document_id, pos, token) and the table ``stems``, where they are stored, else from the texts.
    """
    if not stemmed:
        own = free_name(texts.columns, "tokens")
        hit = lambda t: match(t, query) if or_else is None else match(t, query) | or_else
        found = texts.withColumn(own, F.explode(F.filter(F.array(tokens(F.col("full_text"))), hit)))
        return found.withColumn("fts", rank(F.col(own), query)).drop(own)
    groups, own = parse(query), free_name(texts.columns, "hits")
    places = occurrences(texts) if places is None else places
    hits = stem_hits(places, stem_table(places) if stems is None else stems, query_stems(groups)).select(F.col("document_id").alias("id"), F.col("hits").alias(own))
    joined = texts.join(hits, "id", "inner" if or_else is None and every_alternative_wants(groups) else "left")
    known, n = F.coalesce(own, F.array().cast(NO_HITS)), n_wanted(groups)
    found = joined.where(holds(known, groups) if or_else is None else holds(known, groups) | or_else)
    return found.withColumn("fts", cover_density(F.filter(known, lambda h: h["term"] < n), n) if n else F.lit(0.0)).drop(own)


def token_index(texts: DataFrame) -> DataFrame:
    """(token, document_id, positions): an inverted index to write once, bucketed by token, for repeated queries."""
    return occurrences(texts).groupBy("token", "document_id").agg(F.sort_array(F.collect_list("pos")).alias("positions"))


def index_match(index: DataFrame, words: list[str]) -> DataFrame:
    """(document_id, hits): documents that have all the words, from an index; only the words' lists are read."""
    words = sorted({w.lower() for w in words})
    return index.where(F.col("token").isin(words)).groupBy("document_id").agg(F.count("*").alias("n"), F.sum(F.size("positions")).alias("hits")).where(F.col("n") == len(words)).select("document_id", "hits")


def passages(text: Column, terms: list[str], context_chars: int = 500, most: int = 5, separator: str = r"\n\s*\n", joiner: str = "\n\n", ends: Callable[[Column], Column] = strip) -> Column:
    """The best passages of a text as an array of (score, text), all in one row's expressions.

    Paragraphs of over 30 characters that hold terms, by score, then length, then position; each with its neighbours;
    long blocks are cut around the first term that they hold; equal openings (100 characters, any case, less what
    ``ends`` takes off them) count once.
    """
    low = [t.lower() for t in terms]
    tidy = F.regexp_replace(F.regexp_replace(text, r"\n{3,}", "\n\n"), r"[ \t]+", " ")
    parts = F.filter(F.transform(F.split(tidy, separator), strip), lambda p: p != "")

    def hits(p: Column) -> Column:
        """Occurrences of all terms, with the paragraph lower-cased once."""
        return bound(F.lower(p), lambda l: reduce(lambda a, b: a + b, [((F.length(l) - F.length(F.replace(l, F.lit(t), F.lit("")))) / len(t)).cast("long") for t in low]))

    def cut(block: Column) -> Column:
        places = lambda l: F.filter(F.array(*[(F.instr(l, t) - 1) for t in low]), lambda p: p >= 0)
        pos = F.get(bound(F.lower(block), places), F.lit(0))

        def around(p: Column) -> Column:
            start = F.greatest(F.lit(0), p - context_chars)
            return F.when(p >= 0, F.concat(F.lit("..."), block.substr(start + 1, F.least(F.length(block), p + context_chars) - start), F.lit("...")))

        return F.when(F.length(block) > 2 * context_chars, F.coalesce(bound(pos, around), block)).otherwise(block)

    def pick(ps: Column) -> Column:
        scored = F.transform(ps, lambda p, i: F.struct((-hits(p)).alias("score"), (-F.length(p)).alias("length"), i.alias("i")))
        good = F.array_sort(F.filter(scored, lambda s: (s["score"] < 0) & (s["length"] < -30)))
        first = F.slice(good, 1, 2 * most)
        blocks = F.transform(first, lambda s: F.struct((-s["score"]).alias("score"), cut(F.array_join(F.slice(ps, F.greatest(s["i"], F.lit(1)), F.when(s["i"] > 0, 3).otherwise(2)), joiner)).alias("text")))
        keyed = F.transform(blocks, lambda b: F.struct(ends(F.lower(F.left(b["text"], F.lit(100)))).alias("key"), b.alias("block")))
        empty = F.array().cast("array<struct<key:string,block:struct<score:bigint,text:string>>>")
        unique = F.aggregate(keyed, empty, lambda acc, x: F.when(F.exists(acc, lambda y: y["key"] == x["key"]), acc).otherwise(F.concat(acc, F.array(x))))
        return F.transform(F.slice(unique, 1, most), lambda x: x["block"])

    return bound(parts, pick)


def _entity_counts(mentions: DataFrame) -> DataFrame:
    return mentions.groupBy("document_id").agg(F.count("*").alias("n"))


def counted(documents: DataFrame, children: dict[str, DataFrame], among: DataFrame | None = None) -> DataFrame:
    """Documents with a count of each child table, 0 where there is none: each child is counted before it is joined, and
    first cut to the ids in ``among``, where given: a table with the documents' ids that is cheap to read."""
    for name, child in children.items():
        if among is not None:
            child = child.join(among.select(F.col("id").alias("document_id")), "document_id", "left_semi")
        per = child.where("document_id is not null").groupBy(F.col("document_id").alias("id")).agg(F.count("*").alias(name))
        documents = documents.join(per, "id", "left").withColumn(name, F.coalesce(name, F.lit(0)))
    return documents


def _leading(ranked: DataFrame, mentions: DataFrame, limit: int) -> DataFrame:
    """The first rows by rank, entities and id, with entity_count. Entities are counted only for rows whose rank is that
    of the last place or higher: no other can be among the first."""
    own = written(ranked, "ranked")
    least = own.select("rank").orderBy(F.desc("rank")).limit(limit).agg(F.min("rank")).first()[0]
    near = written(own.where(F.col("rank") >= F.lit(least)), "leading") if least is not None else own
    return counted(near, {"entity_count": mentions}, near).orderBy(F.desc("rank"), F.desc("entity_count"), "id").limit(limit)


def search_passages(texts: DataFrame, mentions: DataFrame, query: str, max_docs: int = 15, per_doc: int = 3, context_chars: int = 600, stemmed: bool = False, separator: str = r"\n\s*\n") -> DataFrame:
    """(id, file_name, rank, entity_count, passages) of the best documents that have passages.

    Web-style query first; if nothing matches, all its words; if nothing matches, any term by ILIKE, which has rank 0
    and orders by entities.
    """
    terms = query_terms(query)
    plain = " ".join(w for g in parse_query(query) for _, ws in g for w in ws)
    for asked in dict.fromkeys((query, plain)):
        hits = matched(texts, asked, stemmed)
        if not hits.isEmpty():
            ranked = hits.withColumn("rank", F.round("fts", 6))
            break
    else:
        ranked = texts.where(any_ilike(["full_text"], terms)).withColumn("rank", F.lit(0.0))
    top = _leading(ranked.select("id", "file_name", "display_title", "rank"), mentions, max_docs).join(texts.select("id", "full_text"), "id").orderBy(F.desc("rank"), F.desc("entity_count"), "id")
    return top.withColumn("passages", passages(F.col("full_text"), terms, context_chars, per_doc, separator)).where(F.size("passages") > 0).select("id", "file_name", "display_title", "rank", "entity_count", "passages")


def search_documents(texts: DataFrame, mentions: DataFrame, query: str, limit: int = 30, stemmed: bool = False) -> DataFrame:
    """(id, file_name, display_title, collection, rank, entity_count): full-text or file-name hits, by rank and entities."""
    hits = matched(texts, query, stemmed, any_ilike(["file_name"], query_terms(query)))
    ranked = hits.withColumn("rank", F.round(F.coalesce("fts", F.lit(0.0)), 6)).select("id", "file_name", "display_title", "collection", "rank")
    return _leading(ranked, mentions, limit).select("id", "file_name", "display_title", "collection", "rank", "entity_count")


def list_documents(texts: DataFrame, mentions: DataFrame, query: str = "") -> DataFrame:
    """The first 200 documents by file name, or the first 100 that a search finds; with whether they have text."""
    has = (F.col("full_text").isNotNull() & (F.col("full_text") != "")).alias("has_text")
    if not query.strip():
        first = texts.select("id", "file_name", "display_title", "collection", has).orderBy(F.asc_nulls_last("file_name"), "id").limit(200)
        return counted(first, {"entity_count": mentions}, first).orderBy("file_name", "id")
    flags = texts.select("id", has)
    return search_documents(texts, mentions, query, 100).join(flags, "id").orderBy(F.desc("rank"), F.desc("entity_count"), "id").select("id", "file_name", "display_title", "collection", "has_text", "entity_count")


def rank_documents(texts: DataFrame, mentions: DataFrame, transactions: DataFrame, relationships: DataFrame, query: str, stemmed: bool = False) -> DataFrame:
    """Documents that match a query, scored for reading in full: id, file_name, est_tokens, term_hits, richness, score.

    (10 * rank + hits per 1000 tokens + 3 ln(hits) + richness per 1000 tokens + 15 * share of terms in the file name)
    times a factor of size that favours 5,000 to 45,000 tokens. Richness counts entities, five times transactions and
    three times relationships. Finding aids are left out. Order: score, id.
    """
    terms = content_terms(query)
    found = matched(texts.where(~F.lower("file_name").rlike("|".join(REFERENCE_NAMES))), query, stemmed)
    length = F.greatest(F.coalesce(F.length("full_text"), F.lit(1)), F.lit(1))
    name_hits = reduce(lambda a, b: a + b, [F.contains(F.lower("file_name"), F.lit(t.lower())).cast("int") for t in terms])
    slim = found.select(
        "id", "file_name", F.floor(length / F.lit(3.2)).alias("est_tokens"), term_hits(F.col("full_text"), terms).alias("term_hits"),
        (name_hits / len(terms) * 15).alias("name_bonus"), "fts",
    )
    rich = counted(slim, {"entity_count": mentions, "transaction_count": transactions, "relationship_count": relationships}, texts).withColumn("richness", F.col("entity_count") + 5 * F.col("transaction_count") + 3 * F.col("relationship_count"))
    per = F.greatest(F.lit(1.0), F.col("est_tokens") / 1000)
    tokens_ = F.col("est_tokens")
    factor = F.when(tokens_ < 3000, 0.3).when(tokens_ < 5000, 0.6).when(tokens_ <= 45000, 1.0).when(tokens_ <= 100000, 0.7).otherwise(0.3)
    score = (10 * F.col("fts") + F.col("term_hits") / per + 3 * F.log(F.greatest(F.lit(1), F.col("term_hits"))) + F.col("richness") / per + F.col("name_bonus")) * factor
    return rich.withColumn("score", score).select("id", "file_name", "est_tokens", "term_hits", "richness", "score").orderBy(F.desc("score"), "id")
