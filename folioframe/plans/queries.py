"""The engine's operators as queries over the star-schema tables, each with the same in DuckDB's SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import json_text, text
from ..operators import chunking, citations, context, documents, export, load, merge, resolve, retrieval, search
from ..sources import files
from ..sources.corpus_view import Corpus, ctes
from . import discovery

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
PARAGRAPH = r"\n"


def query(sql: str | None = None):
    """Register a function of (spark, corpus) under its name, with its SQL."""

    def register(fn: Callable[[SparkSession, Corpus], DataFrame]):
        QUERIES[fn.__name__] = lambda spark, sf_dir: fn(spark, Corpus.from_star(spark, sf_dir))
        if sql:
            ORACLE_SQL[fn.__name__] = sql
        return fn

    return register


def _ilike(columns: list[str], terms: list[str]) -> str:
    return "(" + " OR ".join(f"coalesce({c} ILIKE '%{t}%', false)" for c in columns for t in terms) + ")"


# --- entity and fact search -------------------------------------------------------------------------------------------

_ENTITY_TERMS = ["bolt", "BUILDING", "000000012"]


@query(f"""{ctes('documents', 'entities', 'mentions')}
SELECT e.id, e.name, e.type, e.context, count(DISTINCT d.document_id) AS doc_count,
  array_to_string(coalesce(list_sort(list_distinct(list(coalesce(g.display_title, g.file_name)) FILTER (WHERE g.id IS NOT NULL))), []), '; ') AS source_files,
  (CASE WHEN {_ilike(['e.name'], _ENTITY_TERMS)} THEN CASE WHEN e.type = 'person' THEN 1000 ELSE 500 END ELSE 0 END) + count(DISTINCT d.document_id) AS relevance_score
FROM c_entities e LEFT JOIN c_mentions d ON d.entity_id = e.id LEFT JOIN c_documents g ON g.id = d.document_id
WHERE {_ilike(['e.name', 'e.context'], _ENTITY_TERMS)}
GROUP BY e.id, e.name, e.type, e.context ORDER BY relevance_score DESC, e.name, e.id LIMIT 200""")
def search_entities(spark, c):
    found = search.search_entities(c["entities"], c["mentions"], c["documents"], " ".join(_ENTITY_TERMS) + " of")
    return found.withColumn("source_files", F.array_join("source_files", "; "))


_FACT_QUERIES = {
    "events": "click k_.%7 an", "financial_transactions": "bolt lease", "relationships": "widget Brand#1", "fee_patents": "private 0000000", "correspondence": "user the",
    "legislative_actions": "enacted 7", "testimony": "NATION_1 agent", "taxes": "delinquent lot 7", "mortgages": "Bank active",
}


def _fact_search(name: str, asked: str) -> None:
    how = search.SEARCHES[name]
    order = ", ".join(f"f.{c} ASC NULLS LAST" for c in how.order)
    sql = f"""{ctes('documents', name)}
SELECT f.id, {', '.join('f.' + c for c in how.returned)}, d.file_name, d.display_title
FROM c_{name} f JOIN c_documents d ON f.document_id = d.id WHERE {_ilike(['f.' + c for c in how.searched], text.query_terms(asked))}
ORDER BY {order}, f.id LIMIT {how.limit}"""

    def run(spark, c):
        return search.search_facts(c[name], c["documents"], asked, how)

    run.__name__ = f"search_{name}"
    query(sql)(run)


for _name, _asked in _FACT_QUERIES.items():
    _fact_search(_name, _asked)


@query(f"""{ctes('entities', 'mentions')}
SELECT '000000012' AS searched, e2.id AS entity_id, e2.name, e2.type, e2.context, count(DISTINCT m1.document_id) AS shared_docs
FROM c_entities e1 JOIN c_mentions m1 ON m1.entity_id = e1.id JOIN c_mentions m2 ON m1.document_id = m2.document_id AND m2.entity_id <> m1.entity_id JOIN c_entities e2 ON e2.id = m2.entity_id
WHERE e1.name ILIKE '%000000012%' GROUP BY e2.id, e2.name, e2.type, e2.context ORDER BY shared_docs DESC, e2.name, e2.id LIMIT 50""")
def entity_network(spark, c):
    return search.entity_network(c["entities"], c["mentions"], ["000000012"])


_PEOPLE = ["customer#000000003", "customer#000000017", "supplier#000000005"]


@query(f"""{ctes('entities', 'mentions')}, asked AS (SELECT unnest({_PEOPLE}) AS searched)
SELECT searched, entity_id, name, type, context, shared_docs FROM (
  SELECT searched, e2.id AS entity_id, e2.name, e2.type, e2.context, count(DISTINCT m1.document_id) AS shared_docs
  FROM asked JOIN c_entities e1 ON e1.name ILIKE concat('%', searched, '%') JOIN c_mentions m1 ON m1.entity_id = e1.id
  JOIN c_mentions m2 ON m1.document_id = m2.document_id AND m2.entity_id <> m1.entity_id JOIN c_entities e2 ON e2.id = m2.entity_id GROUP BY ALL)
QUALIFY row_number() OVER (PARTITION BY searched ORDER BY shared_docs DESC, name, entity_id) <= 50""")
def entity_networks(spark, c):
    return search.entity_network(c["entities"], c["mentions"], _PEOPLE)


# --- corpus statistics ------------------------------------------------------------------------------------------------

_COUNTED = ["documents", "entities", "mentions", "events", "financial_transactions", "relationships", "fee_patents", "correspondence", "legislative_actions", "testimony", "taxes", "mortgages"]


@query(f"{ctes(*_COUNTED)} " + " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM c_{t}" for t in _COUNTED) + " UNION ALL SELECT 'absent', 0")
def corpus_stats(spark, c):
    return documents.table_counts({t: c[t] for t in _COUNTED} | {"absent": None})


@query(f"{ctes('entities')} SELECT type, count(*) AS n FROM c_entities GROUP BY type ORDER BY n DESC, type")
def entity_type_counts(spark, c):
    return documents.type_counts(c["entities"])


@query(f"{ctes('documents', 'texts')} SELECT (SELECT count(DISTINCT collection) + max(CASE WHEN collection IS NULL THEN 1 ELSE 0 END) FROM c_documents) AS n_collections, (SELECT count(*) FROM c_texts WHERE full_text <> '') AS n_with_text")
def collection_stats(spark, c):
    n = documents.texts_present(c["texts"]).first()[0]
    return documents.distinct_collections(c["documents"]).withColumn("n_with_text", F.lit(n))


@query(f"{ctes('documents')} SELECT id, file_name, display_title, summary, collection FROM c_documents WHERE summary IS NOT NULL")
def all_summaries(spark, c):
    return documents.summaries(c["documents"])


@query(f"""{ctes('documents')} SELECT count(*) AS n, CAST(sum(len(list_filter(regexp_split_to_array(summary, '\\s+'), lambda x: x <> ''))) AS BIGINT) AS words,
  CAST(floor(sum(len(list_filter(regexp_split_to_array(summary, '\\s+'), lambda x: x <> ''))) / count(*)) AS BIGINT) AS mean_words FROM c_documents WHERE summary IS NOT NULL""")
def summary_statistics(spark, c):
    return export.summary_statistics(c["documents"])


# --- text functions and chunks ----------------------------------------------------------------------------------------


def _chunk_sql(tail: bool) -> str:
    n = "CAST(ceil(length(full_text) / 3500.0) AS INT)" if tail else "CAST(greatest(1, ceil((length(full_text) - 500) / 3500.0)) AS INT)"
    return f"""{ctes('texts')} SELECT id, CAST(k AS INT) AS chunk, CAST(k * 3500 AS INT) AS start, CAST(least(k * 3500 + 4000, length(full_text)) AS INT) AS "end"
FROM (SELECT id, full_text, unnest(range({n})) AS k FROM c_texts WHERE length(full_text) > 0)"""


@query(_chunk_sql(False))
def chunk_offsets(spark, c):
    return chunking.chunk_offsets(c["texts"], 4000, 500)


@query(_chunk_sql(True))
def chunk_offsets_tail(spark, c):
    return chunking.chunk_offsets(c["texts"], 4000, 500, tail=True)


@query(f"""{ctes('texts')} SELECT id, CAST(k AS INT) AS chunk, md5(substring(full_text, k * 3500 + 1, 4000)) AS digest
FROM (SELECT id, full_text, unnest(range(CAST(greatest(1, ceil((length(full_text) - 500) / 3500.0)) AS INT))) AS k FROM c_texts WHERE length(full_text) > 0)""")
def chunk_texts(spark, c):
    return chunking.chunks(c["texts"], 4000, 500).select("id", "chunk", F.md5("text").alias("digest"))


_PAGES = "CAST(greatest(1, ceil(length(full_text) / 1000.0)) AS INT)"


@query(f"""{ctes('texts')}, m AS (SELECT id, string_agg('\n--- Page ' || CAST(p AS VARCHAR) || ' ---\n' || coalesce(substring(full_text, (p - 1) * 1000 + 1, 1000), ''), '' ORDER BY p) AS t
FROM (SELECT id, full_text, unnest(range(1, {_PAGES} + 1)) AS p FROM c_texts) GROUP BY id) SELECT id, md5(t) AS digest, CAST(length(t) AS INT) AS n_chars FROM m""")
def page_marked_texts(spark, c):
    """As many pages as the text fills."""
    return chunking.page_marked(_text_pages(c)).select("id", F.md5("full_text").alias("digest"), F.length("full_text").alias("n_chars"))


@query(f"""{ctes('texts')}, m AS (SELECT id, left(string_agg('--- Page ' || CAST(p AS VARCHAR) || ' ---\n' || coalesce(substring(full_text, (p - 1) * 1000 + 1, 1000), '') || '\n', '' ORDER BY p), 2500) AS t
FROM (SELECT id, full_text, unnest(range(1, {_PAGES} + 1)) AS p FROM c_texts) GROUP BY id) SELECT id, md5(t) AS digest, CAST(length(t) AS INT) AS n_chars FROM m""")
def page_marked_capped(spark, c):
    """The other style of markers, with a cap of characters: the feature that bounds what a first look costs."""
    return chunking.page_marked(_text_pages(c), style="brief", cap=2500).select("id", F.md5("full_text").alias("digest"), F.length("full_text").alias("n_chars"))


def _text_pages(c):
    cut = F.regexp_extract_all("full_text", F.lit("(?s).{1,1000}"), F.lit(0))
    return c["texts"].select("id", F.posexplode(F.when(F.length("full_text") > 0, cut).otherwise(F.array(F.lit(""))))).select("id", (F.col("pos") + 1).alias("page"), F.col("col").alias("text"))


@query(f"""{ctes('texts')} SELECT id, coalesce(nullif(display_title, ''), file_name) AS label,
  CASE WHEN regexp_extract(file_name, '\\b(1[89]\\d\\d(?:\\s*[-–]\\s*\\d{{2,4}})?)\\b', 1) <> '' THEN 'c. ' || regexp_extract(file_name, '\\b(1[89]\\d\\d(?:\\s*[-–]\\s*\\d{{2,4}})?)\\b', 1) ELSE '' END AS doc_date FROM c_texts""")
def doc_dates(spark, c):
    return c["texts"].select("id", text.label(F.col("display_title"), F.col("file_name")).alias("label"), text.doc_date(F.col("file_name")).alias("doc_date"))


@query(f"""{ctes('texts')} SELECT id, CAST(floor(length(full_text) / 3.2) AS BIGINT) AS by_chars, CAST(floor(length(full_text) / 4) AS BIGINT) AS by_four,
  CAST(floor(len(list_filter(regexp_split_to_array(full_text, '\\s+'), lambda x: x <> '')) * 1.33) AS BIGINT) AS by_words, CAST(greatest(1, floor(length(full_text) / 3000)) AS BIGINT) AS pages,
  CAST(length(CASE WHEN length(full_text) > 3200 THEN left(full_text, 3200) || ' [cut]' ELSE full_text END) AS INT) AS n_cut FROM c_texts""")
def token_estimates(spark, c):
    t = F.col("full_text")
    return c["texts"].select("id", text.tokens_by_chars(t).alias("by_chars"), text.tokens_by_four(t).alias("by_four"), text.tokens_by_words(t).alias("by_words"), text.pages(t).alias("pages"), F.length(text.truncated(t, 1000, " [cut]")).alias("n_cut"))


_TERMS = ["the", "Tion", "er"]


@query(f"""{ctes('texts')} SELECT id, {', '.join(f"CAST((length(lower(full_text)) - length(replace(lower(full_text), '{t.lower()}', ''))) / {len(t)} AS BIGINT) AS n_{t.lower()}" for t in _TERMS)},
  array_to_string(list_sort(list_distinct(regexp_extract_all(left(full_text, 5000), '\\b(19|20)\\d\\d\\b', 1))), ',') AS centuries FROM c_texts""")
def term_hits(spark, c):
    return c["texts"].select("id", *[text.occurrences(F.col("full_text"), t).alias(f"n_{t.lower()}") for t in _TERMS], F.array_join(text.centuries(F.col("full_text")), ",").alias("centuries"))


def _passages_sql(terms: list[str], chars: int, most: int, joiner: str) -> str:
    """CTEs over c_texts that end in ``best`` (id, place, score, passage)."""
    found = lambda t: f"instr(lower(block), '{t}')"
    start = lambda t: f"greatest(0, {found(t)} - 1 - {chars})"
    cuts = " ".join(f"WHEN {found(t)} > 0 THEN '...' || substring(block, {start(t)} + 1, least(length(block), {found(t)} - 1 + {chars}) - {start(t)}) || '...'" for t in terms)
    score = " + ".join(f"(length(lower(para)) - length(replace(lower(para), '{t}', ''))) / {len(t)}" for t in terms)
    return f"""parts AS (
  SELECT id, list_filter(list_transform(string_split(regexp_replace(full_text, '[ \\t]+', ' ', 'g'), chr(10)), lambda x: trim(x)), lambda x: x <> '') AS p FROM c_texts),
each AS (SELECT id, p, i, p[i] AS para FROM (SELECT id, p, unnest(range(1, len(p) + 1)) AS i FROM parts)),
scored AS (SELECT id, i, para, {score} AS score, array_to_string(p[greatest(1, i - 1):least(len(p), i + 1)], {joiner}) AS block FROM each),
cut AS (SELECT id, i, score, length(para) AS n, CASE WHEN length(block) > {2 * chars} THEN CASE {cuts} ELSE block END ELSE block END AS passage FROM scored WHERE score > 0 AND length(para) > 30),
top AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, n DESC, i) AS r FROM cut QUALIFY r <= {2 * most}),
uniq AS (SELECT * FROM top QUALIFY row_number() OVER (PARTITION BY id, trim(lower(left(passage, 100))) ORDER BY r) = 1),
best AS (SELECT id, CAST(place - 1 AS INT) AS place, CAST(score AS BIGINT) AS score, passage FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY r) AS place FROM uniq) WHERE place <= {most})"""


@query(f"{ctes('texts')}, {_passages_sql(['ation', 'the'], 200, 5, 'chr(10)')} SELECT * FROM best")
def passages_topk(spark, c):
    best = retrieval.passages(F.col("full_text"), ["ation", "the"], 200, 5, PARAGRAPH, "\n", F.trim)  # as the SQL: an opening that a line break ends differs from one without
    return c["texts"].select("id", F.posexplode(best).alias("place", "p")).select("id", "place", F.col("p.score").alias("score"), F.col("p.text").alias("passage"))


# --- full text ---------------------------------------------------------------------------------------------------------

_TOKENS = r"regexp_extract_all(lower(full_text), '[\p{L}\p{N}]+')"


@query(f"""{ctes('texts')}, t AS (SELECT id, {_TOKENS} AS w FROM c_texts)
SELECT id, (list_contains(w, 'tion') AND list_contains(w, 'onand')) OR (list_contains(w, 'reth') AND NOT list_contains(w, 'onon')) OR contains(' ' || array_to_string(w, ' ') || ' ', ' ertion ist ') AS hit,
  round(len(list_filter(w, lambda x: x = 'tion')) * 0.1 / (len(list_filter(w, lambda x: x = 'tion')) * 0.1 + 1), 6) AS rank FROM t""")
def fts_match(spark, c):
    found = retrieval.with_tokens(c["texts"])
    hit = retrieval.match(F.col("tokens"), 'tion onand or reth -onon or "ertion ist"')
    return found.select("id", hit.alias("hit"), F.round(retrieval.rank(F.col("tokens"), "tion"), 6).alias("rank"))


_DENSITY = f"""h AS (SELECT id, unnest({_TOKENS}) AS token, unnest(range(len({_TOKENS}))) AS pos FROM c_texts),
x AS (SELECT *, lag(token) OVER w AS token_before, lag(pos) OVER w AS pos_before, min(token) OVER (PARTITION BY id) <> max(token) OVER (PARTITION BY id) AS have_both FROM h WHERE token IN ('tion', 'reth') WINDOW w AS (PARTITION BY id ORDER BY pos)),
r AS (SELECT id, have_both, sum(CASE WHEN NOT have_both THEN 0.1 WHEN token_before <> token THEN 0.1 / (pos - pos_before) ELSE 0 END) AS r FROM x GROUP BY id, have_both)"""


@query(f"""{ctes('texts')}, {_DENSITY}
SELECT c_texts.id, round(CAST(coalesce(r / (r + 1), 0) AS DOUBLE), 6) AS rank FROM c_texts LEFT JOIN r ON r.id = c_texts.id""")
def fts_cover_density(spark, c):
    """Ranks by two words: every stretch from one of them to the next other one counts a tenth of its length's inverse."""
    found = retrieval.with_tokens(c["texts"])
    return found.select("id", F.round(retrieval.rank(F.col("tokens"), "tion reth"), 6).alias("rank"))


@query(f"""{ctes('texts')}, t AS (SELECT id AS document_id, unnest({_TOKENS}) AS token FROM c_texts)
SELECT document_id, count(*) AS hits FROM t WHERE token IN ('tion', 'reth') GROUP BY document_id HAVING count(DISTINCT token) = 2""")
def inverted_index_match(spark, c):
    return retrieval.index_match(retrieval.token_index(c["texts"]), ["tion", "reth"])


_N_ENTITIES = "LEFT JOIN (SELECT document_id, count(*) AS n FROM c_mentions GROUP BY document_id) m ON m.document_id = t.id"
_RANKED = "round(len(list_filter(w, lambda x: x = 'tion')) * 0.1 / (len(list_filter(w, lambda x: x = 'tion')) * 0.1 + 1), 6)"


@query(f"""{ctes('texts', 'mentions')}, t AS (SELECT *, {_TOKENS} AS w FROM c_texts)
SELECT t.id, file_name, display_title, collection, {_RANKED} AS rank, coalesce(m.n, 0) AS entity_count FROM t {_N_ENTITIES}
WHERE list_contains(w, 'tion') OR file_name ILIKE '%tion%' ORDER BY rank DESC, entity_count DESC, t.id LIMIT 30""")
def search_documents_metadata(spark, c):
    return retrieval.search_documents(c["texts"], c["mentions"], "tion")


@query(f"""{ctes('texts', 'mentions')}, t AS (SELECT *, {_TOKENS} AS w FROM c_texts)
SELECT t.id, file_name, display_title, collection, full_text IS NOT NULL AND full_text <> '' AS has_text, coalesce(m.n, 0) AS entity_count FROM t {_N_ENTITIES}
WHERE list_contains(w, 'tion') OR file_name ILIKE '%tion%' ORDER BY {_RANKED} DESC, entity_count DESC, t.id LIMIT 100""")
def list_documents_found(spark, c):
    return retrieval.list_documents(c["texts"], c["mentions"], "tion")


@query(f"""{ctes('texts', 'mentions')} SELECT t.id, file_name, display_title, collection, full_text IS NOT NULL AND full_text <> '' AS has_text, coalesce(m.n, 0) AS entity_count
FROM (SELECT * FROM c_texts ORDER BY file_name, id LIMIT 200) t {_N_ENTITIES}""")
def list_documents_first(spark, c):
    return retrieval.list_documents(c["texts"], c["mentions"]).select("id", "file_name", "display_title", "collection", "has_text", "entity_count")


@query(f"""{ctes('texts', 'mentions', 'financial_transactions', 'relationships')}, t AS (SELECT *, {_TOKENS} AS w FROM c_texts),
x AS (SELECT t.id, file_name, floor(greatest(1, length(full_text)) / 3.2) AS est, (length(lower(full_text)) - length(replace(lower(full_text), 'tion', ''))) / 4 AS hits,
  CASE WHEN contains(lower(file_name), 'tion') THEN 15.0 ELSE 0.0 END AS bonus, len(list_filter(w, lambda v: v = 'tion')) * 0.1 AS r,
  coalesce(m.n, 0) + 5 * coalesce(f.n, 0) + 3 * coalesce(l.n, 0) AS rich FROM t {_N_ENTITIES}
  LEFT JOIN (SELECT document_id, count(*) AS n FROM c_financial_transactions GROUP BY document_id) f ON f.document_id = t.id LEFT JOIN (SELECT document_id, count(*) AS n FROM c_relationships GROUP BY document_id) l ON l.document_id = t.id
  WHERE list_contains(w, 'tion') AND NOT regexp_matches(lower(file_name), 'finding aid|archives west|haley papers|mansfield papers'))
SELECT id, file_name, CAST(est AS BIGINT) AS est_tokens, CAST(hits AS BIGINT) AS term_hits, CAST(rich AS BIGINT) AS richness,
  round((10 * r / (r + 1) + hits / greatest(1.0, est / 1000) + 3 * ln(greatest(1, hits)) + rich / greatest(1.0, est / 1000) + bonus) * (CASE WHEN est < 3000 THEN 0.3 WHEN est < 5000 THEN 0.6 WHEN est <= 45000 THEN 1.0 WHEN est <= 100000 THEN 0.7 ELSE 0.3 END), 4) AS score FROM x""")
def rank_documents(spark, c):
    return retrieval.rank_documents(c["texts"], c["mentions"], c["financial_transactions"], c["relationships"], "the tion").withColumn("score", F.round("score", 4))


@query(f"""{ctes('texts', 'mentions')}, {_passages_sql(['tion', 'reth'], 600, 3, 'chr(10) || chr(10)')}, {_DENSITY},
found AS (SELECT t.id, file_name, round(CAST(r / (r + 1) AS DOUBLE), 6) AS rank, coalesce(m.n, 0) AS entity_count FROM c_texts t JOIN r ON r.id = t.id AND r.have_both {_N_ENTITIES} ORDER BY rank DESC, entity_count DESC, t.id LIMIT 15)
SELECT found.id, file_name, rank, entity_count, CAST(count(*) AS INT) AS n_passages, md5(string_agg(passage, chr(0) ORDER BY place)) AS passages FROM found JOIN best ON best.id = found.id GROUP BY ALL""")
def search_full_text_passages(spark, c):
    found = retrieval.search_passages(c["texts"], c["mentions"], "tion reth", separator=PARAGRAPH)
    told = F.md5(F.array_join(F.transform("passages", lambda p: p["text"]), "\0").cast("binary"))
    return found.select("id", "file_name", "rank", "entity_count", F.size("passages").alias("n_passages"), told.alias("passages"))


@query(f"""{ctes('texts', 'mentions')}, {_passages_sql(['tio', 'zzqx'], 600, 3, 'chr(10) || chr(10)')},
found AS (SELECT t.id, file_name, coalesce(m.n, 0) AS entity_count FROM c_texts t {_N_ENTITIES} WHERE full_text ILIKE '%tio%' OR full_text ILIKE '%zzqx%' ORDER BY entity_count DESC, t.id LIMIT 15)
SELECT id, file_name, CAST(0 AS DOUBLE) AS rank, entity_count FROM found WHERE id IN (SELECT id FROM best)""")
def search_passages_by_part(spark, c):
    """No text has both words, so any text that holds a part of one is found: rank 0, by entities."""
    return retrieval.search_passages(c["texts"], c["mentions"], "tio zzqx", separator=PARAGRAPH).select("id", "file_name", "rank", "entity_count")


# --- replies and merging -----------------------------------------------------------------------------------------------


@query(f"""SELECT o_orderkey AS id, o_orderkey % 6 IN (0, 1, 5) AS valid_json, CASE WHEN o_orderkey % 6 IN (0, 1, 5) THEN 2 ELSE 0 END AS n_entities, 0 AS n_events,
  CASE WHEN o_orderkey % 6 IN (0, 1, 5) THEN 1 ELSE 0 END AS n_relationships, CASE WHEN o_orderkey % 6 IN (0, 1, 5) THEN 3 ELSE 0 END AS n_items FROM orders""")
def extraction_scores(spark, c):
    orders = c["documents"]  # the projection keeps a row an order
    body = F.expr("concat('{\"entities\":[{\"name\":\"x\",\"type\":\"person\"},{\"name\":\"b\",\"type\":null}],\"events\":\"none\",\"relationships\":[{\"subject\":\"s\"}]}')")
    fence = lambda head: F.concat(F.lit(head + "\n"), body, F.lit("\n```"))
    k = F.col("id") % 6
    reply = F.when(k == 0, fence("```json")).when(k == 1, body).when(k == 2, F.concat(body, F.lit(" trailing"))).when(k == 3, F.left(body, F.lit(30))).when(k == 4, F.lit("")).otherwise(fence("```"))
    return export.extraction_scores(orders.select("id", reply.alias("reply")), ["entities", "events", "relationships"]).drop("reply")


@query(r"""SELECT o_orderkey AS id, CASE o_orderkey % 3 WHEN 0 THEN '{"a":1}' WHEN 1 THEN '{"a":1}' ELSE '{"a":{"b":2}}' END AS strict, '{"a":1}' AS lines FROM orders""")
def fence_strip(spark, c):
    k = F.col("id") % 3
    strict = F.when(k == 0, F.lit('```json\n{"a":1}\n```')).when(k == 1, F.lit(' {"a":1} ')).otherwise(F.lit('```\n{"a":{"b":2}}\n```'))
    return c["documents"].select("id", json_text.unfenced(strict).alias("strict"), json_text.unfenced(F.lit('```json\n{"a":1}\n```'), "lines").alias("lines"))


#: Extraction items of a document in chunks: line items stand for them, so equal keys occur.
_ITEMS = {
    "financial_transactions": ("SELECT l_orderkey % 500 AS document_id, l_linenumber AS chunk, CAST(round(l_extendedprice * 100) AS BIGINT) AS pos, l_returnflag AS type, CAST(CAST(floor(l_quantity / 10) AS BIGINT) AS STRING) AS amount, l_linestatus AS payer, CASE WHEN l_partkey % 3 = 0 THEN NULL ELSE 'p' END AS payee, CAST(NULL AS STRING) AS date, 'sale of land' AS for_what FROM {lineitem}", ["amount", "payer", "payee", "substring(for_what, 1, 50)"]),
    "relationships": ("SELECT l_orderkey % 500 AS document_id, l_linenumber AS chunk, CAST(round(l_extendedprice * 100) AS BIGINT) AS pos, l_returnflag AS type, CAST(l_suppkey % 5 AS STRING) AS subject, CASE WHEN l_partkey % 4 = 0 THEN '' WHEN l_partkey % 4 = 1 THEN NULL ELSE 'o' END AS object FROM {lineitem}", ["type", "subject", "object"]),
    "events": ("SELECT l_orderkey % 500 AS document_id, l_linenumber AS chunk, CAST(round(l_extendedprice * 100) AS BIGINT) AS pos, l_returnflag AS type, CAST(1900 + l_partkey % 3 AS STRING) AS date, concat('event at line ', CAST(l_linenumber % 4 AS STRING)) AS description FROM {lineitem}", ["type", "date", "substring(description, 1, 100)"]),
    "fee_patents": ("SELECT l_orderkey % 500 AS document_id, l_linenumber AS chunk, CAST(round(l_extendedprice * 100) AS BIGINT) AS pos, CASE WHEN l_partkey % 2 = 0 THEN ' Ann Lee' ELSE 'ANN LEE ' END AS allottee, CAST(l_suppkey % 4 AS STRING) AS allotment_number, CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE '1909' END AS patent_date FROM {lineitem}", ["trim(lower(coalesce(allottee, '')))", "trim(coalesce(allotment_number, ''))", "patent_date"]),
    "correspondence": ("SELECT l_orderkey % 500 AS document_id, l_linenumber AS chunk, CAST(round(l_extendedprice * 100) AS BIGINT) AS pos, CASE WHEN l_partkey % 2 = 0 THEN 'Agent' ELSE ' agent ' END AS sender, CAST(l_suppkey % 3 AS STRING) AS recipient, CAST(NULL AS STRING) AS date, l_returnflag AS subject FROM {lineitem}", ["trim(lower(coalesce(sender, '')))", "trim(lower(coalesce(recipient, '')))", "date", "substring(subject, 1, 50)"]),
    "legislative_actions": ("SELECT l_orderkey % 500 AS document_id, l_linenumber AS chunk, CAST(round(l_extendedprice * 100) AS BIGINT) AS pos, CASE WHEN l_partkey % 2 = 0 THEN 'hr 1' ELSE ' HR 1' END AS bill_number, l_returnflag AS action_type, CAST(1900 + l_suppkey % 3 AS STRING) AS action_date FROM {lineitem}", ["trim(upper(coalesce(bill_number, '')))", "action_type", "action_date"]),
}


def _lines(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    return spark.sql(sql, lineitem=spark.read.parquet(f"{sf_dir}/lineitem.parquet"))


def _merge_query(group: str, items_sql: str, keys: list[str]) -> None:
    key = ", ".join(f"coalesce({k}, '')" for k in keys)
    ORACLE_SQL[f"merge_{group}"] = f"SELECT * FROM ({items_sql.format(lineitem='lineitem')}) QUALIFY row_number() OVER (PARTITION BY document_id, {key} ORDER BY chunk, pos) = 1"
    QUERIES[f"merge_{group}"] = lambda spark, sf_dir: merge.first_of_equal(_lines(spark, sf_dir, items_sql), group)


for _group, (_sql, _keys) in _ITEMS.items():
    _merge_query(_group, _sql, _keys)

_MENTIONED = """SELECT l_orderkey % 500 AS document_id, l_linenumber AS chunk, CAST(round(l_extendedprice * 100) AS BIGINT) AS pos, CASE WHEN l_suppkey % 3 = 0 THEN 'acreage_holding' ELSE 'person' END AS type,
  CASE WHEN l_suppkey % 10 = 0 THEN ' ' WHEN l_partkey % 2 = 0 THEN concat('NAME ', CAST(l_suppkey % 10 AS STRING)) ELSE concat(' name ', CAST(l_suppkey % 10 AS STRING)) END AS name,
  CASE WHEN l_partkey % 5 = 0 THEN NULL WHEN l_partkey % 5 = 1 THEN '' ELSE concat('context ', CAST(l_partkey % 5 AS STRING)) END AS context, CAST(l_linenumber AS STRING) AS acres, l_returnflag AS land_type FROM {lineitem}"""


def _merge_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.merged_entities(_lines(spark, sf_dir, _MENTIONED))


QUERIES["merge_entities"] = _merge_entities
ORACLE_SQL["merge_entities"] = f"""WITH i AS (SELECT *, trim(name) AS n, trim(coalesce(context, '')) AS ctx FROM ({_MENTIONED.format(lineitem='lineitem')}) WHERE trim(name) <> ''),
firsts AS (SELECT * FROM i QUALIFY row_number() OVER (PARTITION BY document_id, type, lower(n) ORDER BY chunk, pos) = 1),
contexts AS (SELECT document_id, type, k, string_agg(ctx, '; ' ORDER BY chunk, pos) AS c FROM (SELECT document_id, type, lower(n) AS k, ctx, chunk, pos FROM i WHERE ctx <> '' QUALIFY row_number() OVER (PARTITION BY document_id, type, lower(n), ctx ORDER BY chunk, pos) = 1) GROUP BY ALL)
SELECT f.document_id, CAST(row_number() OVER (PARTITION BY f.document_id ORDER BY chunk, pos) AS INT) AS seq, f.type, f.n AS name, coalesce(c, 'Mentioned in document') AS context,
  CASE WHEN f.type = 'acreage_holding' THEN acres END AS acres, CASE WHEN f.type = 'acreage_holding' THEN land_type END AS land_type
FROM firsts f LEFT JOIN contexts ON f.document_id = contexts.document_id AND f.type = contexts.type AND lower(f.n) = contexts.k"""

# --- loading -----------------------------------------------------------------------------------------------------------


@query(f"""{ctes('entities')}, i AS (SELECT id AS seq, CASE WHEN id % 2 = 0 THEN name ELSE concat('New ', CAST(id % 50 AS STRING)) END AS name, type, concat('ctx ', CAST(id % 7 AS STRING)) AS context FROM c_entities),
old AS (SELECT * FROM c_entities WHERE id % 3 <> 1), fresh AS (SELECT name, type, min(seq) AS seq, arg_min(context, seq) AS context FROM i WHERE NOT EXISTS (SELECT 1 FROM old WHERE old.name = i.name AND old.type = i.type) GROUP BY name, type)
SELECT id, name, type, context FROM old UNION ALL SELECT (SELECT max(id) FROM old) + row_number() OVER (ORDER BY seq, name, type), name, type, context FROM fresh""")
def entity_find_or_create(spark, c):
    """All entities are offered; two of three are there already, and half of the rest come under new names."""
    offered = c["entities"]
    old = c["entities"].where("id % 3 <> 1").withColumn("acres", F.lit(None).cast("string")).withColumn("land_type", F.lit(None).cast("string"))
    name = F.when(F.col("id") % 2 == 0, F.col("name")).otherwise(F.concat(F.lit("New "), F.col("id") % 50))
    incoming = offered.select(F.col("id").alias("seq"), name.alias("name"), "type", F.concat(F.lit("ctx "), F.col("id") % 7).alias("context"), F.lit(None).cast("string").alias("acres"), F.lit(None).cast("string").alias("land_type"))
    return load.upserted_entities(old, incoming, "first").select("id", "name", "type", "context")


@query(f"""{ctes('entities', 'mentions')}, i AS (SELECT e.name, e.type, m.document_id FROM c_mentions m JOIN c_entities e ON e.id = m.entity_id)
SELECT x.id AS entity_id, i.document_id, true AS is_new FROM i JOIN c_entities x ON x.name = i.name AND x.type = i.type
WHERE NOT EXISTS (SELECT 1 FROM c_mentions m WHERE m.document_id % 4 = 0 AND m.entity_id = x.id AND m.document_id = i.document_id) GROUP BY x.id, i.document_id""")
def mention_upsert(spark, c):
    """All mentions are offered; those of each fourth document are there already."""
    incoming = c["mentions"].join(c["entities"].select(F.col("id").alias("entity_id"), "name", "type", "context"), "entity_id").select("name", "type", "document_id", "context", F.col("entity_id").alias("seq"))
    return load.new_mentions(c["entities"], incoming, c["mentions"].where("document_id % 4 = 0")).select("entity_id", "document_id", F.lit(True).alias("is_new"))


#: Two items an entity: the second has a context that the first holds for every third, none for every fifth.
_OFFERED = """SELECT id * 2 + k AS seq, CASE WHEN id % 2 = 0 THEN name ELSE concat('New ', CAST(id % 50 AS STRING)) END AS name, type,
  CASE WHEN k = 0 THEN concat('ctx ', CAST(id % 7 AS STRING)) WHEN id % 5 = 0 THEN NULL WHEN id % 3 = 0 THEN 'ctx' ELSE concat('more ', CAST(id % 4 AS STRING)) END AS context,
  CASE WHEN k = 1 AND id % 4 = 0 THEN CAST(id % 640 AS STRING) END AS acres, CASE WHEN k = 0 AND id % 6 = 0 THEN 'trust' END AS land_type FROM {entities}, {twice}"""
_OLD = "SELECT *, CASE WHEN id % 8 = 0 THEN '40' END AS acres, CAST(NULL AS STRING) AS land_type FROM {entities} WHERE id % 3 <> 1"


def _upsert_sql(context: str, acres: str, land: str) -> str:
    offered = _OFFERED.format(entities="c_entities", twice="(SELECT unnest([0, 1]) AS k)")
    return f"""{ctes('entities')}, i AS ({offered}), old AS ({_OLD.format(entities='c_entities')}),
per AS (SELECT name, type, min(seq) AS seq, list(context ORDER BY seq) AS ctxs, list(acres ORDER BY seq) AS a, list(land_type ORDER BY seq) AS l FROM i GROUP BY name, type),
x AS (SELECT id, coalesce(old.name, per.name) AS name, coalesce(old.type, per.type) AS type, {context} AS context, {acres} AS acres, {land} AS land_type, seq FROM old FULL JOIN per ON old.name = per.name AND old.type = per.type)
SELECT CASE WHEN id IS NULL THEN (SELECT max(id) FROM old) + row_number() OVER (PARTITION BY id IS NULL ORDER BY seq, name, type) ELSE id END AS id, name, type, context, acres, land_type FROM x"""


_FOLD = """list_reduce(list_prepend(old.context, coalesce(ctxs, [])), lambda acc, c: CASE WHEN coalesce(c, '') = '' THEN acc WHEN coalesce(acc, '') = '' THEN c
  WHEN acc LIKE '%' || left(c, 50) || '%' THEN acc ELSE acc || '; ' || c END)"""
_LATEST = "coalesce(list_filter({0}, lambda v: v IS NOT NULL)[-1], old.{1})"


@query(_upsert_sql(_FOLD, _LATEST.format("a", "acres"), _LATEST.format("l", "land_type")))
def entity_upsert_merge(spark, c):
    return _upserted(spark, c, "merge")


@query(_upsert_sql("CASE WHEN ctxs IS NOT NULL THEN ctxs[-1] ELSE old.context END", "coalesce(old.acres, a[1])", "coalesce(old.land_type, l[1])"))
def entity_upsert_last(spark, c):
    return _upserted(spark, c, "last")


def _upserted(spark, c, mode):
    old = spark.sql(_OLD, entities=c["entities"])
    offered = spark.sql(_OFFERED, entities=c["entities"], twice=spark.range(2).select(F.col("id").alias("k")))
    return load.upserted_entities(old, offered, mode)


_FACT_ROWS = "SELECT document_id, CASE WHEN pos % 7 = 0 THEN '' ELSE allottee END AS allottee, allotment_number, patent_date"


@query(f"""SELECT document_id, allottee, allotment_number, patent_date FROM ({_FACT_ROWS} FROM ({_ITEMS['fee_patents'][0].format(lineitem='lineitem')})) WHERE allottee <> ''""")
def fact_rows_pipeline(spark, c):
    return _patent_rows(spark, c, "pipeline")


@query(f"""SELECT document_id, CASE WHEN allottee = '' THEN 'unknown' ELSE allottee END AS allottee, allotment_number, patent_date FROM ({_FACT_ROWS} FROM ({_ITEMS['fee_patents'][0].format(lineitem='lineitem')}))""")
def fact_rows_loader(spark, c):
    return _patent_rows(spark, c, "loader")


@query(f"""SELECT document_id, allottee, allotment_number, patent_date, CAST(NULL AS VARCHAR) AS patent_number FROM ({_FACT_ROWS} FROM ({_ITEMS['fee_patents'][0].format(lineitem='lineitem')})) WHERE allottee <> ''""")
def fact_rows_upload(spark, c):
    return _patent_rows(spark, c, "upload", "patent_number")


@query(f"SELECT document_id, CASE WHEN bill_number = '' THEN 'unknown' ELSE bill_number END AS bill_number, action_type, action_date FROM ({_ITEMS['legislative_actions'][0].format(lineitem='lineitem')})")
def fact_rows_bills(spark, c):
    return load.fact_rows(_lines(spark, c.sf_dir, _ITEMS["legislative_actions"][0]), "legislative_actions", "loader").select("document_id", "bill_number", "action_type", "action_date")


def _patent_rows(spark, c, flow, *more):
    rows = _lines(spark, c.sf_dir, _ITEMS["fee_patents"][0])
    blank = rows.withColumn("allottee", F.when(F.col("pos") % 7 == 0, F.lit("")).otherwise(F.col("allottee")))
    return load.fact_rows(blank.withColumn("patent_number", F.lit("7")), "fee_patents", flow).select("document_id", "allottee", "allotment_number", "patent_date", *more)


_GONE = "SELECT id FROM c_documents WHERE id % 10 = 3"


@query(f"""{ctes('documents', 'mentions', 'events', 'taxes')}
SELECT 'documents' AS table_name, count(*) AS n_rows FROM c_documents WHERE id NOT IN ({_GONE}) UNION ALL SELECT 'mentions', count(*) FROM c_mentions WHERE document_id NOT IN ({_GONE})
UNION ALL SELECT 'events', count(*) FROM c_events WHERE document_id IS NULL OR document_id NOT IN ({_GONE}) UNION ALL SELECT 'taxes', count(*) FROM c_taxes WHERE document_id NOT IN ({_GONE})""")
def cascade_delete(spark, c):
    tables = {t: c[t] for t in ("documents", "mentions", "events", "taxes")}
    return documents.table_counts(load.cascaded(tables, c["documents"].where("id % 10 = 3")))


@query(f"""{ctes('documents', 'mentions', 'events', 'taxes')}
SELECT 'mentions' AS table_name, count(*) AS n_rows FROM c_mentions WHERE document_id NOT IN ({_GONE})
UNION ALL SELECT 'events', count(*) FROM c_events WHERE document_id IS NULL OR document_id NOT IN ({_GONE}) UNION ALL SELECT 'taxes', count(*) FROM c_taxes""")
def clear_for_reextraction(spark, c):
    tables = {t: c[t] for t in ("mentions", "events", "taxes")}
    return documents.table_counts(load.cleared(tables, c["documents"].where("id % 10 = 3")))


@query(f"""{ctes('documents')} SELECT file_path, file_name FROM (SELECT file_name AS file_path, file_name, id FROM c_documents) WHERE file_path NOT IN (SELECT file_name FROM c_documents WHERE id % 2 = 0)""")
def skip_processed(spark, c):
    docs = c["documents"].withColumn("file_path", F.col("file_name"))
    return load.unprocessed(docs.select("file_path", "file_name"), docs.where("id % 2 = 0"))


@query(f"""{ctes('documents')} SELECT id, file_name, CASE WHEN id % 4 = 0 THEN concat('updated ', CAST(id AS STRING)) ELSE display_title END AS display_title, summary FROM c_documents""")
def enrichment_update(spark, c):
    docs = c["documents"].select("id", "file_name", "display_title", "summary")
    values = docs.where("id % 4 = 0").select("id", F.concat(F.lit("updated "), F.col("id")).alias("display_title"), F.lit(None).cast("string").alias("summary"))
    return load.set_by_id(docs, values, ["display_title", "summary"])


@query(f"{ctes('documents')} SELECT row_number() OVER (ORDER BY file_name) + 1000 AS id, file_name FROM c_documents")
def id_assignment(spark, c):
    return load.with_ids(c["documents"].select("file_name"), ["file_name"], 1000)


@query(f"""{ctes('events')} SELECT id, CASE WHEN metadata IS NULL THEN 0 WHEN metadata LIKE '[%' THEN 1 ELSE 2 END AS n_entities FROM c_events""")
def event_metadata(spark, c):
    return c["events"].select("id", F.size(load.involved_entities(F.col("metadata"))).alias("n_entities"))


_PATHS = "concat(CASE WHEN doc_id % 4 = 0 THEN '' ELSE concat(source, '/') END, CASE WHEN doc_id % 3 = 0 THEN 'Big Horn County/' ELSE '' END, 'f', CAST(doc_id AS STRING), '.pdf')"


@query(f"""WITH p AS (SELECT doc_id AS id, string_split({_PATHS}, '/') AS p FROM documents)
SELECT id, CASE WHEN len(p) > 1 THEN p[1] ELSE 'Unknown' END AS collection, CASE WHEN len(p) > 2 THEN p[2] END AS subcollection,
  list_filter(p, lambda x: regexp_matches(lower(x), 'county|reservation|agency|district|territory'))[1] AS location, concat(replace(replace('a__b_c', '__', '; '), '_', ' '), '.pdf') AS name FROM p""")
def path_metadata(spark, c):
    path = F.expr(_PATHS.replace("doc_id", "id").replace("source", "collection"))
    return c["texts"].select("id", *[v.alias(k) for k, v in files.path_columns(path).items()], files.name_from_folder(F.lit("a__b_c")).alias("name"))


# --- entity resolution -------------------------------------------------------------------------------------------------

_CANON = "trim(regexp_replace(lower(trim(name)), '^(commissioner|congressman|chairman|senator|general|colonel|captain|chief|miss|mrs?|dr|rev|hon|col|gen|capt|rep)\\.?\\s+', ''))"
_DUP = f"""{ctes('entities', 'mentions')}, counted AS (
  SELECT e.id, e.name, e.type, e.context, {_CANON} AS canonical, coalesce(m.n, 0) AS docs FROM c_entities e LEFT JOIN (SELECT entity_id, count(DISTINCT document_id) AS n FROM c_mentions GROUP BY entity_id) m ON m.entity_id = e.id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY type, canonical ORDER BY docs DESC, (upper(name) <> name OR lower(name) = name) AND (lower(name) <> name OR upper(name) = name) DESC, length(name) DESC, name, id) AS r, count(*) OVER (PARTITION BY type, canonical) AS k FROM counted WHERE canonical <> ''),
grouped AS (SELECT type, canonical, count(*) AS n_variants, CAST(sum(docs) AS BIGINT) AS total_docs, max(CASE WHEN r = 1 THEN id END) AS best_id, max(CASE WHEN r = 1 THEN name END) AS best_name FROM ranked WHERE k > 1 GROUP BY type, canonical),
id_map AS (SELECT c.id AS old_id, g.best_id AS new_id FROM counted c JOIN grouped g ON c.type = g.type AND c.canonical = g.canonical WHERE c.id <> g.best_id)"""


@query(f"{_DUP} SELECT * FROM grouped")
def dedup_groups(spark, c):
    return resolve.duplicate_groups(c["entities"], c["mentions"])


@query(f"{_DUP} SELECT * FROM grouped WHERE type IN ('land_parcel', 'organization')")
def dedup_groups_of_types(spark, c):
    """Of some types only."""
    return resolve.duplicate_groups(c["entities"], c["mentions"], types=["land_parcel", "organization"])


@query(f"{_DUP} SELECT * FROM id_map")
def dedup_id_map(spark, c):
    return resolve.exact_id_map(c["entities"], resolve.duplicate_groups(c["entities"], c["mentions"]))


@query(f"""{_DUP}, moved AS (SELECT coalesce(new_id, entity_id) AS entity_id, document_id, new_id IS NOT NULL AS moved, entity_id AS was, concat('m', CAST(entity_id % 3 AS STRING)) AS context FROM c_mentions LEFT JOIN id_map ON old_id = entity_id)
SELECT entity_id, document_id, string_agg(context, '; ' ORDER BY moved, was) AS context FROM moved GROUP BY entity_id, document_id""")
def dedup_mentions_after(spark, c):
    m = c["mentions"].withColumn("context", F.concat(F.lit("m"), F.col("entity_id") % 3))
    return resolve.merged_mentions(m, resolve.exact_id_map(c["entities"], resolve.duplicate_groups(c["entities"], c["mentions"])))


@query(f"""{_DUP}, gone AS (SELECT new_id, context, old_id FROM id_map JOIN c_entities e ON e.id = old_id), extra AS (
  SELECT new_id, string_agg(context, '; ' ORDER BY old_id) AS added FROM (SELECT g.new_id, g.context, g.old_id FROM gone g JOIN c_entities t ON t.id = g.new_id WHERE NOT contains(t.context, g.context) QUALIFY row_number() OVER (PARTITION BY g.new_id, g.context ORDER BY g.old_id) = 1) GROUP BY new_id)
SELECT e.id, e.name, e.type, CASE WHEN added IS NULL THEN e.context ELSE concat(e.context, '; ', added) END AS context FROM c_entities e LEFT JOIN extra ON extra.new_id = e.id WHERE e.id NOT IN (SELECT old_id FROM id_map)""")
def dedup_entities_after(spark, c):
    e = c["entities"].withColumn("acres", F.lit(None).cast("string")).withColumn("land_type", F.lit(None).cast("string"))
    return resolve.merged_entities(e, resolve.exact_id_map(e, resolve.duplicate_groups(e, c["mentions"]))).select("id", "name", "type", "context")


@query(f"""{ctes('entities')}, n AS (SELECT id, type, trim(regexp_replace(regexp_replace(CASE WHEN type = 'person' THEN regexp_replace(lower(trim(name)), '^(commissioner|congressman|chairman|senator|general|colonel|captain|chief|miss|mrs?|dr|rev|hon|col|gen|capt|rep)\\.?\\s+', '')
  WHEN type = 'land_parcel' THEN regexp_replace(regexp_replace(lower(trim(name)), '\\bno\\.?\\s*', '', 'g'), '#\\s*', '', 'g') ELSE lower(trim(name)) END, '[,.]', '', 'g'), '\\s+', ' ', 'g')) AS norm FROM c_entities)
SELECT id, type, norm, CASE WHEN type = 'person' THEN left(string_split(norm, ' ')[-1], 1) WHEN type = 'organization' THEN left(string_split(norm, ' ')[1], 4) ELSE string_split(norm, ' ')[1] END AS block FROM n""")
def block_keys(spark, c):
    e = c["entities"].select("id", "type", resolve.normalised(F.col("name"), F.col("type")).alias("norm"))
    return e.withColumn("block", resolve.block_key(F.col("norm"), F.col("type")))


_SPELLED = """SELECT 1000000000 + c_custkey * 2 AS id, concat(substring(md5(c_name), 1, 10), ' ', substring(md5(c_name), 11, 10), ' kingsley') AS name, 'person' AS type, CAST(NULL AS STRING) AS context FROM {customer} WHERE c_custkey % 5 = 0
UNION ALL SELECT 1000000001 + c_custkey * 2, concat(substring(md5(c_name), 1, 10), ' ', substring(md5(c_name), 11, 4), substring(md5(c_name), 16, 5), ' kingsley'), 'person', NULL FROM {customer} WHERE c_custkey % 10 = 0"""


def _spelled(spark, c):
    """The entities, and persons of one surname, half of them with a misspelled double."""
    if not getattr(c, "sf_dir", None):
        return c["entities"]
    return c["entities"].unionByName(spark.sql(_SPELLED, customer=spark.read.parquet(f"{c.sf_dir}/customer.parquet")))


@query()
def fuzzy_candidates(spark, c):
    return resolve.fuzzy_candidates(_spelled(spark, c), c["mentions"]).withColumn("score", F.round("score", 6))


@query()
def fuzzy_review(spark, c):
    return resolve.review(resolve.fuzzy_candidates(_spelled(spark, c), c["mentions"]), c["mentions"], c["documents"]).select("type", "id_a", "id_b", "score", "keep", "decision")


def _accepted(old: Column, new: Column) -> list[Column]:
    return [F.lit("person").alias("type"), new.alias("id_a"), F.concat(F.lit("n"), new).alias("name_a"), old.alias("id_b"), F.concat(F.lit("n"), old).alias("name_b"), F.lit(0.9).alias("score"), F.concat(F.lit("n"), new).alias("keep"), F.lit("accept").alias("decision")]


@query("""WITH b AS (SELECT c_custkey AS k, c_custkey // 40 AS b FROM customer), m AS (SELECT b, min(k) AS lo, max(k) AS hi FROM b GROUP BY b)
SELECT k AS old_id, CASE WHEN b % 2 = 0 THEN hi ELSE lo END AS new_id FROM b JOIN m USING (b) WHERE k <> CASE WHEN b % 2 = 0 THEN hi ELSE lo END""")
def merge_chains_and_cycles(spark, c):
    """Each customer goes into the next of its forty, a chain; in each second forty the last goes into the first, a cycle."""
    k = F.col("k")
    own = spark.read.parquet(f"{c.sf_dir}/customer.parquet").select(F.col("c_custkey").alias("k"), F.floor(F.col("c_custkey") / 40).alias("b"))
    ends = own.groupBy("b").agg(F.min("k").alias("lo"), F.max("k").alias("hi"))
    rows = own.join(ends, "b").where("k < hi or b % 2 = 1").withColumn("to", F.when(k < F.col("hi"), k + 1).otherwise(F.col("lo")))
    return resolve.accepted_id_map(rows.select(*_accepted(k, F.col("to"))))


@query(f"""{ctes('entities', 'mentions')}, p AS (SELECT id AS old_id, id - 3 AS new_id FROM c_entities WHERE type = 'person' AND id % 2 = 0),
x AS (SELECT p.old_id, m.document_id, EXISTS (SELECT 1 FROM c_mentions n WHERE n.entity_id = p.new_id AND n.document_id = m.document_id) AS met FROM p JOIN c_mentions m ON m.entity_id = p.old_id)
SELECT p.old_id, a.name AS old_name, p.new_id, b.name AS new_name, count(x.old_id) FILTER (WHERE NOT met) AS moved, count(x.old_id) FILTER (WHERE met) AS combined
FROM p LEFT JOIN c_entities a ON a.id = p.old_id LEFT JOIN c_entities b ON b.id = p.new_id LEFT JOIN x ON x.old_id = p.old_id GROUP BY ALL""")
def merge_dry_run(spark, c):
    """What merging each second customer into the one before it would do."""
    pairs = c["entities"].where("type = 'person' and id % 2 = 0").select(*_accepted(F.col("id"), F.col("id") - 3))
    return resolve.merge_plan(pairs, c["entities"], c["mentions"])


@query("""WITH r AS (SELECT c_custkey AS old_id, c_custkey - c_custkey % 10 AS new_id FROM customer WHERE c_custkey % 10 <> 0 AND c_custkey % 4 <> 3) SELECT old_id, CAST(CASE WHEN new_id % 100 <> 0 AND new_id % 4 <> 3 THEN new_id - new_id % 100 ELSE new_id END AS BIGINT) AS new_id FROM r
UNION ALL SELECT c_custkey, c_custkey - c_custkey % 100 FROM customer WHERE c_custkey % 10 = 0 AND c_custkey % 100 <> 0 AND c_custkey % 4 <> 3""")
def apply_review(spark, c):
    k = (F.col("id") / 3).cast("long")
    own = c["entities"].where("type = 'person'").select(k.alias("k"))
    to = F.when(F.col("k") % 10 != 0, F.col("k") - F.col("k") % 10).otherwise(F.col("k") - F.col("k") % 100)
    rows = own.where("k % 100 <> 0").select(F.lit("person").alias("type"), to.alias("id_a"), F.concat(F.lit("n"), to).alias("name_a"), F.col("k").alias("id_b"), F.concat(F.lit("n"), F.col("k")).alias("name_b"), F.lit(0.9).alias("score"), F.concat(F.lit("n"), to).alias("keep"), F.when(F.col("k") % 4 != 3, F.lit("accept")).otherwise(F.lit("reject")).alias("decision"))
    return resolve.accepted_id_map(rows)


# --- documents, contexts, citations ------------------------------------------------------------------------------------


@query(f"""{ctes('documents', 'entities', 'mentions', 'financial_transactions', 'relationships')}
SELECT d.id, (SELECT count(*) FROM c_mentions m WHERE m.document_id = d.id) AS n_entities, (SELECT count(*) FROM c_financial_transactions f WHERE f.document_id = d.id) AS n_transactions,
  (SELECT count(*) FROM c_relationships r WHERE r.document_id = d.id) AS n_relationships, (SELECT string_agg(concat(e.type, '/', e.name), ';' ORDER BY e.type, e.name, e.context) FROM c_mentions m JOIN c_entities e ON e.id = m.entity_id WHERE m.document_id = d.id) AS names
FROM c_documents d""")
def document_bundles(spark, c):
    b = documents.bundles(c["documents"].select("id"), c["entities"], c["mentions"], {}, numbers={k: c[k] for k in ("financial_transactions", "relationships")})
    names = F.nullif(F.array_join(F.transform("entities", lambda e: F.concat_ws("/", e["type"], e["name"])), ";"), F.lit(""))
    return b.select("id", F.size("entities").cast("long").alias("n_entities"), F.col("financial_transactions").alias("n_transactions"), F.col("relationships").alias("n_relationships"), names.alias("names"))


_NAMES = ["order_7.pdf", "order_3.pdf", "none.pdf", "order_7.pdf"]


@query(f"{ctes('documents')}, a AS (SELECT unnest(range({len(_NAMES)})) AS pos, unnest({_NAMES}) AS file_name) SELECT CAST(a.pos AS INT) AS pos, d.id, d.file_name, d.collection FROM a JOIN c_documents d ON d.file_name = a.file_name")
def documents_by_names(spark, c):
    return documents.documents_by_names(c["documents"], _NAMES).select("pos", "id", "file_name", "collection")


_BUNDLED = {
    "entities": ("SELECT m.document_id, concat_ws('/', e.type, e.name, e.context) AS x, e.type AS k1, e.name AS k2, e.context AS k3 FROM c_mentions m JOIN c_entities e ON e.id = m.entity_id", "k1, k2, k3"),
    "events": ("SELECT document_id, concat_ws('/', date, type, location, description) AS x, date, type, location, description FROM c_events", "date NULLS FIRST, type, location, description"),
    "financial_transactions": ("SELECT document_id, concat_ws('/', date, amount, type, payer, payee, for_what) AS x, date, amount, type, payer, payee, for_what FROM c_financial_transactions", "date NULLS FIRST, amount, type, payer, payee, for_what"),
    "relationships": ("SELECT document_id, concat_ws('/', subject, type, object, context) AS x, subject, type, object, context FROM c_relationships", "subject, type, object, context"),
}


@query(f"{ctes('documents', 'entities', 'mentions', 'events', 'financial_transactions', 'relationships')}, a AS (SELECT unnest(range({len(_NAMES)})) AS pos, unnest({_NAMES}) AS file_name) SELECT CAST(a.pos AS INT) AS pos, d.id, d.collection, " + ", ".join(f"coalesce((SELECT string_agg(x, ';' ORDER BY {order}) FROM ({rows}) WHERE document_id = d.id), '') AS {t}" for t, (rows, order) in _BUNDLED.items()) + " FROM a JOIN c_documents d ON d.file_name = a.file_name")
def bundles_by_names(spark, c):
    """Whole bundles, events too, in the order of asked names, one of which is asked for twice and one isn't there."""
    b = documents.bundles_by_names(c["documents"], c["entities"], c["mentions"], {k: c[k] for k in documents.BUNDLE}, _NAMES)
    told = lambda t: F.array_join(F.transform(t, lambda e: F.concat_ws("/", *[e[f] for f in (documents.BUNDLE.get(t) or ("type", "name", "context"))])), ";")
    return b.select("pos", "id", "collection", *[told(t).alias(t) for t in _BUNDLED])


@query(f"""{ctes('documents')} SELECT CAST(n AS INT) AS n, id, CASE WHEN changed THEN concat('=== ', g, ' ===', chr(10)) ELSE '' END || '[Doc ' || CAST(id AS VARCHAR) || '] ' || coalesce(nullif(display_title, ''), file_name) ||
  CASE WHEN regexp_extract(file_name, '\\b(1[89]\\d\\d)\\b', 1) <> '' THEN ' (c. ' || regexp_extract(file_name, '\\b(1[89]\\d\\d)\\b', 1) || ')' ELSE '' END || chr(10) || summary AS line
FROM (SELECT *, coalesce(collection, 'Unknown') AS g, row_number() OVER w AS n, coalesce(lag(coalesce(collection, 'Unknown')) OVER w <> coalesce(collection, 'Unknown'), true) AS changed FROM c_documents WHERE summary IS NOT NULL WINDOW w AS (ORDER BY collection NULLS LAST, file_name, id))""")
def corpus_context_lines(spark, c):
    return context.corpus_lines(c["documents"])


@query()
def discovery_evidence(spark, c):
    return discovery.evidence_counts(discovery.discover(c, "bolt 000000012"))


def _listed_sql(table: str, line: str, order: str, most: int) -> str:
    rows = f"SELECT * FROM c_{table}" if table != "entities" else "SELECT m.document_id, e.* FROM c_mentions m JOIN c_entities e ON e.id = m.entity_id"
    return f"""l_{table} AS (SELECT document_id, string_agg(line, chr(10) ORDER BY n) AS lines FROM (SELECT document_id, {line} AS line, row_number() OVER (PARTITION BY document_id ORDER BY {order}) AS n FROM ({rows}) WHERE document_id IN (SELECT id FROM chosen)) WHERE n <= {most} GROUP BY document_id)"""


_nz = lambda c: f"coalesce({c}, '')"
_LISTS = {
    "entities": ("ENTITIES", f"'  - [' || {_nz('type')} || '] ' || {_nz('name')}", "type NULLS FIRST, name NULLS FIRST, context NULLS FIRST", 30),
    "events": ("EVENTS", f"'  - ' || {_nz('date')} || ' ' || {_nz('type')} || ': ' || {_nz('description')}", "date NULLS FIRST, type NULLS FIRST, location NULLS FIRST, description NULLS FIRST", 15),
    "financial_transactions": ("TRANSACTIONS", f"'  - ' || {_nz('date')} || ' ' || {_nz('payer')} || ' → ' || {_nz('payee')} || ' ' || {_nz('amount')}", "date NULLS FIRST, amount NULLS FIRST, type NULLS FIRST, payer NULLS FIRST, payee NULLS FIRST, for_what NULLS FIRST", 15),
    "relationships": ("RELATIONSHIPS", f"'  - ' || {_nz('subject')} || ' ' || {_nz('type')} || ' ' || {_nz('object')}", "subject NULLS FIRST, type NULLS FIRST, object NULLS FIRST, context NULLS FIRST", 15),
}
_MOST = int(130_000 // 3 * 3.2)


def _additional_sql(terms: list[str], read: str) -> str:
    """Sections (n, text) of what was found in other documents than those in ``read``; needs c_documents and the tables searched."""
    name = "coalesce(nullif(d.display_title, ''), d.file_name)"
    part = lambda n, title, most, rows: f"""SELECT {n} AS n, '{title} (' || CAST(max(total) AS VARCHAR) || '):' || chr(10) || string_agg(line, chr(10) ORDER BY place) AS text
FROM (SELECT *, count(*) OVER () AS total, row_number() OVER (ORDER BY place) AS k FROM ({rows})) WHERE k <= {most} HAVING count(*) > 0"""  # noqa: E731
    facts = lambda t, line, order: f"""SELECT row_number() OVER (ORDER BY {order}) AS place, {line} AS line, file_name FROM (
  SELECT f.*, {name} AS label, d.file_name FROM c_{t} f JOIN c_documents d ON d.id = f.document_id WHERE {_ilike(['f.' + c for c in search.SEARCHES[t].searched], terms)} ORDER BY {order} LIMIT {search.SEARCHES[t].limit})"""  # noqa: E731
    ranked = f"""SELECT e.id, e.name, e.type, e.context, list_sort(list_distinct(list(coalesce(d.display_title, d.file_name)) FILTER (WHERE d.id IS NOT NULL))) AS files,
  (CASE WHEN {_ilike(['e.name'], terms)} THEN CASE WHEN e.type = 'person' THEN 1000 ELSE 500 END ELSE 0 END) + count(DISTINCT m.document_id) AS score
  FROM c_entities e LEFT JOIN c_mentions m ON m.entity_id = e.id LEFT JOIN c_documents d ON d.id = m.document_id WHERE {_ilike(['e.name', 'e.context'], terms)} GROUP BY e.id, e.name, e.type, e.context ORDER BY score DESC, e.name, e.id LIMIT 200"""
    entities = f"""SELECT row_number() OVER (ORDER BY score DESC, name, id) AS place, '  - ' || name || ' (' || coalesce(type, '') || '): ' || left(coalesce(context, ''), 120) || ' | Sources: ' || array_to_string(files[1:3], ', ') AS line
  FROM ({ranked}) WHERE id IN (SELECT id FROM (SELECT id, unnest(files) AS f FROM ({ranked})) WHERE f NOT IN {read})"""
    sold = facts("financial_transactions", "'  - [' || coalesce(date, 'n/d') || '] ' || coalesce(payer, '?') || ' → ' || coalesce(payee, '?') || ': ' || coalesce(amount, '?') || ' | ' || label", "date NULLS LAST, id")
    tied = facts("relationships", "'  - ' || coalesce(subject, '?') || ' —[' || coalesce(type, '') || ']→ ' || coalesce(object, '?') || ' | ' || label", "subject NULLS LAST, type NULLS LAST, id")
    rest = lambda rows: f"SELECT * FROM ({rows}) WHERE file_name NOT IN {read}"
    return " UNION ALL ".join([part(1, "ADDITIONAL ENTITIES FROM OTHER DOCUMENTS", 40, entities), part(2, "ADDITIONAL TRANSACTIONS FROM OTHER DOCUMENTS", 20, rest(sold)), part(3, "ADDITIONAL RELATIONSHIPS FROM OTHER DOCUMENTS", 20, rest(tied))])


_READ = ["order_1.pdf", "order_2.pdf", "order_32.pdf", "Order 5 of 1915"]


@query(f"""{ctes('documents', 'entities', 'mentions', 'financial_transactions', 'relationships')}, s AS ({_additional_sql(['bolt', 'nation'], '(SELECT unnest(' + str(_READ) + '))')}) SELECT CAST(n AS INT) AS n, md5(text) AS digest, CAST(length(text) AS INT) AS n_chars FROM s""")
def additional_evidence(spark, c):
    """What a search finds in other documents than four that were read."""
    asked = "bolt nation"
    found = {"entities": search.search_entities(c["entities"], c["mentions"], c["documents"], asked)} | {t: search.search_facts(c[t], c["documents"], asked, search.SEARCHES[t]) for t in ("financial_transactions", "relationships")}
    rows = context.additional_sections(found, _READ)
    return rows[0].unionByName(rows[1]).unionByName(rows[2]).select("n", F.md5(F.col("text").cast("binary")).alias("digest"), F.length("text").alias("n_chars"))


@query(f"""{ctes('documents', 'texts', 'entities', 'mentions', 'events', 'financial_transactions', 'relationships')}, chosen AS (SELECT id FROM ({ORACLE_SQL['rank_documents']}) ORDER BY score DESC, id LIMIT 3),
{', '.join(_listed_sql(t, line, order, most) for t, (_, line, order, most) in _LISTS.items())},
each AS (SELECT t.id, 'DOCUMENT: ' || coalesce(nullif(display_title, ''), file_name) || chr(10) || 'Collection: ' || coalesce(collection, 'n/a') || chr(10) || 'Pages (about): ' || CAST(CAST(greatest(1, floor(length(full_text) / 3000)) AS BIGINT) AS VARCHAR) || chr(10) || chr(10)
  || CASE WHEN length(full_text) > {_MOST} THEN left(full_text, {_MOST}) || chr(10) || chr(10) || '[... document truncated ...]' ELSE full_text END
  || {' || '.join(f"coalesce(chr(10) || '{title}:' || chr(10) || l_{t}.lines, '')" for t, (title, *_) in _LISTS.items())} AS context
  FROM c_texts t JOIN chosen ON chosen.id = t.id {' '.join(f'LEFT JOIN l_{t} ON l_{t}.document_id = t.id' for t in _LISTS)} WHERE full_text <> ''),
joined AS (SELECT string_agg(context, chr(10) || chr(10) ORDER BY n, id) AS context FROM (SELECT 0 AS n, id, context FROM each UNION ALL SELECT n, 0, text FROM ({_additional_sql(['tion'], '(SELECT file_name FROM c_texts WHERE id IN (SELECT id FROM chosen))')}))),
capped AS (SELECT CASE WHEN length(context) > 544000 THEN left(context, 544000) || chr(10) || chr(10) || '[... context truncated ...]' ELSE context END AS context FROM joined)
SELECT md5(context) AS digest, CAST(length(context) AS INT) AS n_chars FROM capped""")
def hybrid_context(spark, c):
    return discovery.hybrid(c, "tion", 3).select(F.md5("context").alias("digest"), F.length("context").alias("n_chars"))


_ANSWER = "concat('See [Doc ', CAST(o_orderkey AS STRING), '] and [Doc ', CAST(o_custkey AS STRING), ', 3, 12-', CAST(13 + o_orderkey % 3 AS STRING), '], [Doc 5, the title], [Doc 7,8-9], $1,200.50 for 40 acres on May 4, 1909 under S. ', CAST(o_orderkey % 90 AS STRING), ' (order_', CAST(o_orderkey % 40 AS STRING), '.pdf, 1909). What the documents prove')"


@query(f"""WITH x AS (SELECT o_orderkey AS answer_id, [o_custkey, 5, o_orderkey, 7, 8, 9] AS l FROM orders), u AS (SELECT answer_id, unnest(l) AS doc_id, unnest(range(len(l))) AS i FROM x),
f AS (SELECT answer_id, doc_id, min(i) AS i FROM u GROUP BY answer_id, doc_id) SELECT answer_id, CAST(row_number() OVER (PARTITION BY answer_id ORDER BY i) - 1 AS INT) AS pos, CAST(doc_id AS BIGINT) AS doc_id FROM f""")
def citation_edges(spark, c):
    return citations.citation_edges(_answers(spark, c))


@query("SELECT o_orderkey AS answer_id, concat('order_', CAST(o_orderkey % 40 AS STRING), '.pdf') AS name, o_orderkey % 40 AS doc_id FROM orders WHERE o_orderkey % 40 % 17 <> 0")
def file_name_citations(spark, c):
    return citations.file_name_citations(_answers(spark, c), c["documents"])


_SITE = "https://archive.example/documents/"


def _linked_sql() -> str:
    """The answers' six citations as links, and the list of what is cited: titled ones first, as they are rewritten first."""
    year = r"regexp_extract(file_name, '\b(1[89]\d\d(?:\s*[-–]\s*\d{2,4})?)\b', 1)"
    links = [f"coalesce(max(link) FILTER (WHERE i = {i}), '[Doc ' || CAST(max(n) FILTER (WHERE i = {i}) AS VARCHAR) || ']')" for i in range(6)]
    tail = "' for 40 acres on May 4, 1909 under S. ' || CAST(o_orderkey % 90 AS VARCHAR) || ' (order_' || CAST(o_orderkey % 40 AS VARCHAR) || '.pdf, 1909). What the documents prove'"
    body = f"'See ' || {links[2]} || ' and ' || {links[0]} || ', ' || {links[1]} || ', ' || {links[3]} || ', ' || {links[4]} || ', ' || {links[5]} || ', $1,200.50' || {tail}"
    return f"""{ctes('documents')}, d AS (SELECT id, coalesce(nullif(display_title, ''), file_name) AS name, '{_SITE}' || CAST(id AS VARCHAR) AS url, coalesce(collection, '') AS place, CASE WHEN {year} <> '' THEN ', c. ' || {year} ELSE '' END AS year FROM c_documents),
u AS (SELECT o_orderkey, unnest([o_custkey, 5, o_orderkey, 7, 8, 9]) AS n, unnest(range(6)) AS i FROM orders),
x AS (SELECT u.*, '[Doc ' || CAST(n AS VARCHAR) || ', ' || name || '](' || url || ')' AS link, row_number() OVER (PARTITION BY o_orderkey, n ORDER BY i) = 1 AS is_first,
  '- **[Doc ' || CAST(n AS VARCHAR) || '](' || url || ')** — ' || name || CASE WHEN place <> '' THEN ' (*' || place || '*' || year || ')' ELSE '' END || chr(10) AS source FROM u LEFT JOIN d ON d.id = n)
SELECT o_orderkey AS id, md5({body} || coalesce(chr(10) || chr(10) || '---' || chr(10) || chr(10) || '### Sources Cited' || chr(10) || chr(10) || string_agg(source, '' ORDER BY i) FILTER (WHERE is_first), '')) AS digest FROM x GROUP BY o_orderkey"""


@query(_linked_sql())
def linked_citations(spark, c):
    return citations.linked(_answers(spark, c), c["documents"], "https://archive.example").select("id", F.md5("text").alias("digest"))


@query(f"""SELECT o_orderkey AS id, md5(CASE WHEN o_orderkey % 40 % 17 <> 0 THEN replace(t, '(' || f || ', 1909)', '([' || f || ']({_SITE}' || CAST(o_orderkey % 40 AS VARCHAR) || '), 1909)') ELSE t END) AS digest
FROM (SELECT o_orderkey, {_ANSWER} AS t, concat('order_', CAST(o_orderkey % 40 AS VARCHAR), '.pdf') AS f FROM orders)""")
def linked_file_name_citations(spark, c):
    return citations.linked_file_names(_answers(spark, c), c["documents"], "https://archive.example").select("id", F.md5("text").alias("digest"))


_PAPER = "concat('Letter (', CAST(1890 + k % 30 AS STRING), '), part ', CAST(k AS STRING), '.pdf')"


def _papers(spark, c):
    """File names that hold parentheses and commas, one a customer; and answers that cite two of them, one without .pdf and starred."""
    docs = spark.sql(f"SELECT k AS id, {_PAPER} AS file_name FROM (SELECT c_custkey AS k FROM {{customer}})", customer=spark.read.parquet(f"{c.sf_dir}/customer.parquet"))
    said = F.expr("concat('As (', a, ', May (1909)) and (*', left(b, length(b) - 4), '*) say, not (', left(a, 12), ') nor (', left(a, 6), '), é')")
    name = lambda k: F.expr(_PAPER.replace("k ", f"{k} ").replace("(k", f"({k}"))
    orders = spark.read.parquet(f"{c.sf_dir}/orders.parquet").select("o_orderkey", name("o_custkey").alias("a"), name("(o_custkey + 1)").alias("b"))
    return orders.select(F.col("o_orderkey").alias("id"), said.alias("text")), docs


def _paper_sql(k: str) -> str:
    return f"concat('Letter (', CAST(1890 + {k} % 30 AS VARCHAR), '), part ', CAST({k} AS VARCHAR), '.pdf')"


_CITED = f"(SELECT o_orderkey, o_custkey AS k, {_paper_sql('o_custkey')} AS a, {_paper_sql('(o_custkey + 1)')} AS b, o_custkey + 1 <= (SELECT max(c_custkey) FROM customer) AS both_there FROM orders)"


@query(f"SELECT o_orderkey AS answer_id, a AS name, k AS doc_id FROM {_CITED} UNION ALL SELECT o_orderkey, left(b, length(b) - 4), k + 1 FROM {_CITED} WHERE both_there")
def citations_with_parentheses(spark, c):
    return citations.file_name_citations(*_papers(spark, c))


@query(f"""SELECT o_orderkey AS id, md5(concat('As (', CASE WHEN k % 3 <> 0 THEN '[' || a || '](x-item://' || md5(a) || ')' ELSE a END, ', May (1909)) and (*', CASE WHEN both_there AND (k + 1) % 3 <> 0 THEN '[' || left(b, length(b) - 4) || '](x-item://' || md5(b) || ')' ELSE left(b, length(b) - 4) END,
  '*) say, not (', left(a, 12), ') nor (', left(a, 6), '), é')) AS digest FROM {_CITED}""")
def linked_identifiers(spark, c):
    """Cited names as links to identifiers, where two of three documents have one."""
    answers, docs = _papers(spark, c)
    uuids = docs.where("id % 3 <> 0").select("file_name", F.md5(F.col("file_name").cast("binary")).alias("uuid"))
    return citations.linked_file_names(answers, docs, uuids=uuids).select("id", F.md5(F.col("text").cast("binary")).alias("digest"))


def _answers(spark, c):
    return spark.sql(f"SELECT o_orderkey AS id, {_ANSWER} AS text FROM {{orders}}", orders=spark.read.parquet(f"{c.sf_dir}/orders.parquet"))


@query(f"""SELECT o_orderkey AS id, CAST(len(list_filter(string_split({_ANSWER}, ' '), lambda x: x <> '')) AS INT) AS word_count, CAST(len(list_distinct([o_orderkey, o_custkey, 5, 7])) AS INT) AS doc_citations, 1 AS dollar_amounts, 1 AS acreage_mentions, 1 AS dates, 1 AS bill_numbers, 0 AS allotment_numbers,
  true AS has_prove, false AS has_suggest, false AS has_gaps FROM orders""")
def evidence_metrics(spark, c):
    return export.answer_scores(_answers(spark, c))


# --- export and sampling -----------------------------------------------------------------------------------------------


def _lists_json() -> str:
    """The lists of a completion as JSON, each in the order of ids: keys in their order, no blanks."""
    blank = lambda e: f"coalesce({e}, '')"
    lists = {
        "entities": ("c_mentions m JOIN c_entities e ON e.id = m.entity_id", "m.document_id", "e.id", {"name": "e.name", "type": "e.type", "context": blank("e.context")}),
        "financial_transactions": ("c_financial_transactions f", "f.document_id", "f.id", {k: blank(f"f.{k}") for k in ("type", "amount", "payer", "payee", "date")} | {"description": "coalesce(f.for_what, f.context, '')"}),
        "relationships": ("c_relationships r", "r.document_id", "r.id", {k: blank(f"r.{k}") for k in ("subject", "type", "object", "context")}),
    }
    said = lambda fields: " || ',' || ".join(f"""'"{k}":' || CAST(to_json({e}) AS VARCHAR)""" for k, e in fields.items())
    return " || ',' || ".join(f"""'"{g}":[' || coalesce((SELECT string_agg('{{{{' || {said(fields)} || '}}}}', ',' ORDER BY {key}) FROM {rows} WHERE {doc} = n.id), '') || ']'""".replace("{{", "{").replace("}}", "}") for g, (rows, doc, key, fields) in lists.items())


@query(f"""{ctes('texts', 'entities', 'mentions', 'financial_transactions', 'relationships')}, n AS (
  SELECT t.id, length(t.full_text) AS len, (SELECT count(*) FROM c_mentions m WHERE m.document_id = t.id) + (SELECT count(*) FROM c_financial_transactions f WHERE f.document_id = t.id) + (SELECT count(*) FROM c_relationships r WHERE r.document_id = t.id) AS n_items FROM c_texts t)
SELECT n.id, CAST(n_items AS INT) AS n_items, md5(left(full_text, 40000)) AS prompt, md5('{{' || {_lists_json()} || '}}') AS completion FROM n JOIN c_texts ON c_texts.id = n.id WHERE len > 1000 AND n_items >= 5""")
def training_pairs(spark, c):
    g = export.gathered(c["texts"], c["entities"], c["mentions"], {k: c[k] for k in ("financial_transactions", "relationships")})
    return export.training_pairs(g, F.col("full_text"), min_text=1000).select("id", "n_items", F.md5("prompt").alias("prompt"), F.md5(F.col("completion").cast("binary")).alias("completion"))


@query(f"{ctes('texts')}, s AS (SELECT length(full_text) AS v FROM c_texts) SELECT count(*) AS n, min(v) AS least, max(v) AS most, avg(v) AS mean, list_sort(list(v))[count(*) // 2 + 1] AS median FROM s")
def upper_median(spark, c):
    return export.upper_median(c["texts"].select(F.length("full_text").cast("long").alias("v")), "v")


@query(f"{ctes('documents')} SELECT id, CAST(floor((row_number() OVER (ORDER BY id) - 1) / 25) AS BIGINT) AS batch FROM c_documents")
def title_batches(spark, c):
    return export.batches(c["documents"].select("id"))


@query(f"{ctes('documents')} SELECT 'train' AS part, CAST(floor(count(*) * 0.9) AS BIGINT) AS n FROM c_documents UNION ALL SELECT 'validation', count(*) - CAST(floor(count(*) * 0.9) AS BIGINT) FROM c_documents")
def split_sizes(spark, c):
    return export.split(c["documents"].select("id")).groupBy("part").agg(F.count("*").alias("n"))


@query(f"""{ctes('texts')} SELECT concat('doc-', CAST(id AS STRING)) AS custom_id, id,
  md5('Sum up:' || repeat(chr(10), 2) || CASE WHEN length(full_text) > 572800 THEN left(full_text, 572800) || repeat(chr(10), 2) || '[... text truncated ...]' ELSE full_text END) AS prompt
FROM c_texts WHERE length(regexp_replace(full_text, '^\\s+|\\s+$', '', 'g')) >= 100""")
def summary_requests(spark, c):
    docs = c["texts"].withColumn("summary", F.lit(None).cast("string"))
    return export.summary_requests(docs, "Sum up:").select("custom_id", "id", F.md5("prompt").alias("prompt"))


@query()
def random_sample(spark, c):
    return export.sample(c["documents"].select("id"), 10, 7)
