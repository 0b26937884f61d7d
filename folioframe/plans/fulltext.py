"""Queries of full-text search by stems, with the Snowball rules as SQL over the distinct words."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import stem as rules
from ..operators import fulltext, retrieval
from ..shared import written
from ..sources.corpus_view import ctes
from .queries import _N_ENTITIES, _TOKENS, query


def _stems_sql(words: str) -> str:
    """Tables up to ``stems`` (token, stem) from a table ``words`` (token): a step a table."""
    said = lambda items: "(" + ", ".join(f"'{x}'" for x in items) + ")"
    swap = lambda d: " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in d.items())
    cut = "left(w, length(w) - length(s))"
    keep = "token, p1, p2, fixed"
    after = lambda x: f"CASE WHEN regexp_matches({x}, '{rules.REGION}') THEN length(regexp_extract({x}, '{rules.REGION}')) ELSE length({x}) END"
    short = f"regexp_matches({{}}, '{rules.SHORT}')"
    rule = lambda name, before, table, held: f"""
{name} AS (SELECT {keep}, CASE WHEN s <> '' AND length(w) - length(s) >= p1 AND {held} THEN concat({cut}, CASE s {swap(table)} END) ELSE w END AS w
  FROM (SELECT *, regexp_extract(w, '{rules.any_of(table)}', 1) AS s FROM {before}))"""  # noqa: E731
    return f"""
s0 AS (SELECT token, regexp_replace(regexp_replace(token, '^y', 'Y'), '([aeiouy])y', '\\1Y', 'g') AS w FROM (SELECT DISTINCT token FROM {words})),
s1 AS (SELECT token, w, CASE WHEN regexp_matches(w, '{rules.SPECIAL}') THEN length(regexp_extract(w, '{rules.SPECIAL}')) ELSE {after('w')} END AS p1 FROM s0),
s2 AS (SELECT token, w, p1, p1 + {after('substring(w, p1 + 1)')} AS p2 FROM s1),
s3 AS (SELECT token, p1, p2, CASE WHEN s = 'sses' OR s IN ('ied', 'ies') AND length(w) > 4 THEN left(w, length(w) - 2) WHEN s IN ('ied', 'ies') OR s = 's' AND regexp_matches(left(w, length(w) - 2), '[aeiouy]') THEN left(w, length(w) - 1) ELSE w END AS w
  FROM (SELECT *, regexp_extract(w, '(sses|ied|ies|us|ss|s)$', 1) AS s FROM s2)),
s4 AS (SELECT *, CASE WHEN lower(w) IN {said(rules.INVARIANT)} THEN lower(w) END AS fixed, regexp_extract(w, '(eedly|ingly|edly|eed|ing|ed)$', 1) AS s FROM s3),
s5 AS (SELECT {keep}, s IN ('ed', 'edly', 'ing', 'ingly') AND regexp_matches({cut}, '[aeiouy]') AS gone,
  CASE WHEN s IN ('eed', 'eedly') THEN CASE WHEN length(w) - length(s) >= p1 THEN concat({cut}, 'ee') ELSE w END WHEN s <> '' AND regexp_matches({cut}, '[aeiouy]') THEN {cut} ELSE w END AS w FROM s4),
s6 AS (SELECT {keep}, CASE WHEN NOT gone THEN w WHEN regexp_matches(w, '(at|bl|iz)$') THEN concat(w, 'e') WHEN regexp_matches(w, '{rules.DOUBLED}') THEN left(w, length(w) - 1) WHEN {short.format('w')} AND p1 >= length(w) THEN concat(w, 'e') ELSE w END AS w FROM s5),
s7 AS (SELECT {keep}, CASE WHEN regexp_matches(w, '^.+[^aeiouy][yY]$') THEN concat(left(w, length(w) - 1), 'i') ELSE w END AS w FROM s6),{rule('s8', 's7', rules.STEP2, f"(s <> 'ogi' OR {cut} LIKE '%l') AND (s <> 'li' OR regexp_matches({cut}, '[cdeghkmnrt]$'))")},{rule('s9', 's8', rules.STEP3, "(s <> 'ative' OR length(w) - length(s) >= p2)")},
s10 AS (SELECT {keep}, CASE WHEN s <> '' AND length(w) - length(s) >= p2 AND (s <> 'ion' OR regexp_matches({cut}, '[st]$')) THEN {cut} ELSE w END AS w FROM (SELECT *, regexp_extract(w, '{rules.any_of(rules.STEP4)}', 1) AS s FROM s9)),
stems AS (SELECT token, CASE WHEN length(token) <= 2 THEN token WHEN token IN {said(rules.EXCEPTIONS)} THEN CASE token {swap({k: v or k for k, v in rules.EXCEPTIONS.items()})} END WHEN fixed IS NOT NULL THEN fixed
  WHEN w LIKE '%e' AND (length(w) - 1 >= p2 OR length(w) - 1 >= p1 AND NOT {short.format('left(w, length(w) - 1)')}) OR w LIKE '%ll' AND length(w) - 1 >= p2 THEN lower(left(w, length(w) - 1)) ELSE lower(w) END AS stem FROM s10)"""


_PLACES = f"""{ctes('texts', 'mentions')}, p AS (SELECT id, unnest({_TOKENS}) AS token, unnest(range(len({_TOKENS}))) AS pos FROM c_texts),{_stems_sql('p')},
h AS (SELECT id, pos, stem FROM p JOIN stems USING (token))"""
#: Two words by stems: r is their cover density, as in the query of plain words.
_TWO = """x AS (SELECT *, lag(stem) OVER w AS before, lag(pos) OVER w AS pos_before, min(stem) OVER (PARTITION BY id) <> max(stem) OVER (PARTITION BY id) AS have_both FROM h WHERE stem IN ('one', 'er') WINDOW w AS (PARTITION BY id ORDER BY pos)),
r AS (SELECT id, have_both, sum(CASE WHEN NOT have_both THEN 0.1 WHEN before <> stem THEN 0.1 / (pos - pos_before) ELSE 0 END) AS r FROM x GROUP BY id, have_both)"""


@query(f"{_PLACES} SELECT token, stem FROM stems")
def stem_table(spark, c):
    """The stem of each word of all texts."""
    return fulltext.stem_table(fulltext.occurrences(c["texts"]))


def _with_index(spark, c):
    """The places of all words and their stems, written once as a search would keep them."""
    places = written(fulltext.occurrences(c["texts"]), "places")
    return {"places": places, "stems": fulltext.stem_table(places)}


@query(f"""{_PLACES},
f AS (SELECT id, bool_or(stem = 'one') AS a, bool_or(stem = 'ere') AS b, bool_or(stem = 'hehe') AS c FROM h GROUP BY id)
SELECT id FROM f WHERE a AND b AND NOT c UNION SELECT a.id FROM h a JOIN h b ON a.id = b.id AND b.pos = a.pos + 1 WHERE a.stem = '{rules.stem('thtiedly')}' AND b.stem = 'er'""")
def fts_match_stemmed(spark, c):
    """Two words by any of their forms and not a third, or a phrase."""
    return retrieval.matched(c["texts"], 'oned ering -hehely or "thtied erly"', stemmed=True, **_with_index(spark, c)).select("id")


@query(f"""{_PLACES} SELECT DISTINCT a.id FROM h a JOIN h b ON a.id = b.id AND b.pos = a.pos + 3 WHERE a.stem = '{rules.stem('ates')}' AND b.stem = '{rules.stem('ofannthe')}'""")
def fts_phrase_stemmed(spark, c):
    """A phrase with two stop words inside, which count as places."""
    return retrieval.matched(c["texts"], '"ate of the ofannthes"', stemmed=True).select("id")


@query(f"""{_PLACES}, {_TWO} SELECT t.id, file_name, display_title, collection, round(CAST(coalesce(r / (r + 1), 0) AS DOUBLE), 6) AS rank, coalesce(m.n, 0) AS entity_count FROM c_texts t LEFT JOIN r ON r.id = t.id {_N_ENTITIES}
WHERE r.have_both OR file_name ILIKE '%oning%' OR file_name ILIKE '%erly%' ORDER BY rank DESC, entity_count DESC, t.id LIMIT 30""")
def search_documents_stemmed(spark, c):
    return retrieval.search_documents(c["texts"], c["mentions"], "oning erly", stemmed=True)


@query(f"""{_PLACES}, {_TWO} SELECT t.id, round(CAST(r / (r + 1) AS DOUBLE), 6) AS rank FROM c_texts t JOIN r ON r.id = t.id AND r.have_both""")
def fts_rank_stemmed(spark, c):
    """Cover density of two stems, for all texts that have both."""
    return retrieval.matched(c["texts"], "oned erly", stemmed=True, **_with_index(spark, c)).select("id", F.round("fts", 6).alias("rank"))
