"""Full-text search by stems: a table of the stem of each distinct word, joined with the places of words. No Python runs on executors."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.stem import SEARCH_STOP_WORDS, stem, stemmed
from ..shared import written

#: A query as alternatives of (wanted, [(offset, word), …]): the offsets of a phrase's words count the stop words between them.
Atoms = list[list[tuple[bool, list[tuple[int, str]]]]]
#: Forms of a query's stems that are broadcast; more are joined by a shuffle.
MOST_FORMS = 100_000
NO_HITS = "array<struct<pos:int,term:int>>"


def tokens(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"([\p{L}\p{N}]+)"), 1)


def parse(query: str) -> Atoms:
    """A web-style query: bare words and "phrases" are joined by and, ``or`` separates, ``-`` negates; stop words count for nothing."""
    groups: Atoms = [[]]
    for minus, phrase, word in re.findall(r'(-?)(?:"([^"]*)"|(\S+))', query):
        if word.lower() == "or" and not minus:
            groups.append([])
            continue
        words = [(i, w) for i, w in enumerate(re.findall(r"[^\W_]+", (phrase or word).lower())) if w not in SEARCH_STOP_WORDS]
        if words:
            groups[-1].append((not minus, [(i - words[0][0], w) for i, w in words]))
    return [g for g in groups if g]


def occurrences(texts: DataFrame) -> DataFrame:
    """(document_id, pos, token): each word of each text (id, full_text) in its place."""
    return texts.select(F.col("id").alias("document_id"), F.posexplode(tokens(F.col("full_text"))).alias("pos", "token"))


def stem_table(words: DataFrame) -> DataFrame:
    """(token, stem) of the distinct words of a table, written: a later filter on stems must not be pushed into the steps,
    each of which reads its column several times. To be kept beside an index that is searched often."""
    return written(stemmed(words.select("token").distinct()), "stems")


def stem_hits(places: DataFrame, stems: DataFrame, wanted: list[str]) -> DataFrame:
    """(document_id, hits): where a document has words of the wanted stems, as (pos, number of the stem), by position.

    The stem table is cut to the wanted stems first, so what is joined with the places is a few forms of a few words. They
    are counted and, up to MOST_FORMS, broadcast: places are many more and, for frequent words, in few groups.
    """
    number = F.create_map(*[x for i, s in enumerate(wanted) for x in (F.lit(s), F.lit(i))]) if wanted else F.lit(None).cast("map<string,int>")
    forms = stems.where(F.col("stem").isin(wanted)).select("token", F.element_at(number, F.col("stem")).alias("term"))
    forms = written(forms, "forms")
    if forms.count() <= MOST_FORMS:
        forms = F.broadcast(forms)
    return places.join(forms, "token").groupBy("document_id").agg(F.sort_array(F.collect_list(F.struct("pos", "term"))).alias("hits"))


def query_stems(groups: Atoms) -> list[str]:
    """The distinct stems of a query, those that it wants first."""
    atoms = sorted((a for g in groups for a in g), key=lambda a: not a[0])
    return list(dict.fromkeys(stem(w) for _, words in atoms for _, w in words))


def n_wanted(groups: Atoms) -> int:
    return len({stem(w) for g in groups for wanted, words in g if wanted for _, w in words})


def holds(hits: Column, groups: Atoms) -> Column:
    """Whether hits satisfy the query. A phrase is its words at their distances. A query of stop words alone matches nothing."""
    place = {s: i for i, s in enumerate(query_stems(groups))}

    def atom(wanted: bool, words: list[tuple[int, str]]) -> Column:
        (_, first), *rest = words

        def here(h: Column) -> Column:
            at = lambda off, w: F.array_contains(hits, F.struct((h["pos"] + off).cast("int").alias("pos"), F.lit(place[stem(w)]).alias("term")))
            return reduce(lambda a, b: a & b, [at(off, w) for off, w in rest], h["term"] == place[stem(first)])

        hit = F.exists(hits, here)
        return hit if wanted else ~hit

    found = [reduce(lambda a, b: a & b, [atom(*a) for a in g]) for g in groups]
    return reduce(lambda a, b: a | b, found) if found else F.lit(False)


def every_alternative_wants(groups: Atoms) -> bool:
    """Whether no document without any of the stems can match."""
    return bool(groups) and all(any(wanted for wanted, _ in g) for g in groups)
