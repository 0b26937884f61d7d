import math
import random
import re

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from folioframe.functions import json_text, similarity, text
from folioframe.functions.stem import stem, stemmed


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'string' if isinstance(v, str) or v is None else 'bigint'}" for k, v in values.items()))
    return df.select(column.alias("x")).first()[0]


def test_query_terms():
    assert text.query_terms(" the of Bell land ") == ["the", "Bell", "land"]
    assert text.query_terms(" of ") == ["of"]
    assert text.content_terms("find the land") == ["land"]
    assert text.content_terms("find the") == ["find", "the"]


@pytest.mark.parametrize(
    "value,term,hit",
    [("axb", "a_b", True), ("100 acres", "100%s", True), ("ABC", "bc", True), (None, "x", False), ("", "x", False), ("plain", "zzz", False)],
)
def test_ilike_keeps_wildcards_and_nulls(spark, value, term, hit):
    assert one(spark, text.any_ilike(["t"], [term]), t=value) is hit


def test_strip_takes_unicode_blanks(spark):
    assert one(spark, text.strip(F.col("t")), t=" \t a b \n") == "a b"


@pytest.mark.parametrize("value,term", [("aaaa", "aa"), ("Straße STRASSE", "str"), ("", "x"), ("x𝒳x", "x")])
def test_occurrences(spark, value, term):
    assert one(spark, text.occurrences(F.col("t"), term), t=value) == value.lower().count(term.lower())


@pytest.mark.parametrize("name,date", [("1929-35 Bell.pdf", "c. 1929-35"), ("May3_1947.pdf", ""), ("Bell v. 1972 Mill.pdf", "c. 1972"), ("none.pdf", "")])
def test_doc_date(spark, name, date):
    assert one(spark, text.doc_date(F.col("t")), t=name) == date


def test_centuries(spark):
    assert one(spark, text.centuries(F.col("t")), t="in 2001, 1909 and 1910") == ["19", "20"]


def test_label_and_truncation(spark):
    assert one(spark, text.label(F.col("a"), F.col("b")), a="", b="f") == "f"
    assert one(spark, text.truncated(F.col("t"), 1, "…"), t="abcdef") == "abc…"
    assert one(spark, text.truncated(F.col("t"), 1, "…"), t="abc") == "abc"
    assert text.allowance(0) == 45_000 and text.allowance(10) == 13_000


@pytest.mark.parametrize(
    "reply,style,body",
    [
        ('```json\n{"a":1}\n```', "strict", '{"a":1}'),
        ('```\n{"a":1}\n```', "strict", '{"a":1}'),
        (' {"a":1} ', "strict", '{"a":1}'),
        ('```json\n{"a":1}```', "lines", '{"a":1}'),
        ('```{"a":1}```', "lines", ""),
        ('Sure:\n```json\n{"a":{"b":2}}\n```\nDone', "greedy", '{"a":{"b":2}}'),
    ],
)
def test_unfenced(spark, reply, style, body):
    assert one(spark, json_text.unfenced(F.col("t"), style), t=reply) == body


@pytest.mark.parametrize(
    "reply,valid,n",
    [
        ('{"entities":[{"name":"a"},{"identifier":"b"}]}', True, 2),
        ('{"entities":[{"name":"a"}]} trailing', False, 0),
        ('{"entities":[{"name":"a"', False, 0),
        ('{"entities":"none","other":1}', True, 0),
        ('{"entities":[{"name":"a"}],"entities":[{"name":"b"},{"name":"c"}]}', True, 2),
        ("[1]", False, 0),
        ("", False, 0),
        (None, False, 0),
    ],
)
def test_parsed(spark, reply, valid, n):
    row = json_text.parsed(spark.createDataFrame([(reply,)], "reply string"), groups=["entities", "events"]).first()
    assert (row.valid_json, len(row.result.entities), len(row.result.events)) == (valid, n, 0)
    if n == 2 and "identifier" in reply:
        assert row.result.entities[1].name == "b"


def brute_subsequence(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(new[-1], row[j + 1]))
        row = new
    return row[-1]


@given(st.text("abcde ", max_size=30), st.text("abcde ", max_size=30))
def test_common_subsequence(a, b):
    assert similarity.common_subsequence(a, b) == brute_subsequence(a, b)


def test_similarity_values():
    assert similarity.indel_percent("kitten", "sitting") == 62
    assert similarity.indel_percent("", "") == 100 and similarity.indel_percent("a", "") == 0
    assert similarity.sorted_tokens("Lee, Ann-Mary") == "ann lee mary"
    keys = {"thompson": "0MPSN", "smith": "SM0", "wright": "RT", "phillips": "FLPS", "judge": "JJ", "nation": "NXN", "": ""}
    assert {w: similarity.metaphone(w) for w in keys} == keys


@pytest.mark.parametrize("word,base", [("caresses", "caress"), ("ponies", "poni"), ("hopping", "hop"), ("filing", "file"), ("relational", "relat"), ("agreed", "agre"), ("sky", "sky"), ("controll", "control")])
def test_stem(word, base):
    assert stem(word) == base


#: Words with their stems, from the published description of the rules.
STEMS = {
    "consign": "consign", "consigned": "consign", "consignment": "consign", "consist": "consist", "consistency": "consist", "consolation": "consol", "consolatory": "consolatori", "consoling": "consol",
    "knack": "knack", "knackeries": "knackeri", "knavish": "knavish", "kneaded": "knead", "knightly": "knight", "knocker": "knocker", "knotted": "knot", "luxuriated": "luxuri", "hoping": "hope", "hopping": "hop",
    "generously": "generous", "gas": "gas", "gaps": "gap", "kiwis": "kiwi", "ties": "tie", "cries": "cri", "say": "say", "cry": "cri", "by": "by", "dying": "die", "only": "onli", "news": "news", "herrings": "herring",
    "succeeding": "succeed", "communism": "communism", "sensational": "sensat", "vietnamization": "vietnam", "yielding": "yield", "employees": "employe", "été": "été", "1909s": "1909s", "x": "x", "analogies": "analog",
}


def test_stems_as_columns(spark):
    rnd = random.Random(3)
    parts = ["", "at", "bl", "iz", "tt", "ee", "y", "ay", "yy", "tion", "ational", "ness", "ful", "li", "ogi", "ing", "ed", "edly", "sses", "ies", "s", "e", "ll", "gener", "arsen", "é", "b", "o", "7"]
    words = [*STEMS, *sorted({"".join(rnd.choice(parts) for _ in range(rnd.randrange(1, 6))) for _ in range(4000)} - {""} - set(STEMS))]
    df = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "token string, stem int")
    got = {r.token: r.stem for r in stemmed(df).collect()}
    assert len(got) == len(words) and all(stem(w) == got[w] for w in words)
    assert {w: got[w] for w in STEMS} == STEMS
    assert spark.createDataFrame([(None,)], "token string").transform(stemmed).first().stem is None


def test_evidence(spark):
    t = "On May 4, 1909, [Doc 3] and [Doc 3, 4]: $1,200.50 for 40 acres, H.R. 12, Allotment No. 7. Gaps in the record."
    got = spark.createDataFrame([(t,)], "t string").select(*[c.alias(k) for k, c in text.evidence(F.col("t")).items()]).first()
    assert (got.doc_citations, got.dollar_amounts, got.acreage_mentions, got.dates, got.has_gaps, got.has_prove) == (1, 1, 1, 1, True, False)
    assert got.word_count == len(t.split()) and got.bill_numbers == len(re.findall(text.EVIDENCE["bill_numbers"], t))


def test_token_estimates_differ(spark):
    t = "one two three four"
    assert one(spark, text.tokens_by_chars(F.col("t")), t=t) == math.floor(len(t) / 3.2)
    assert one(spark, text.tokens_by_words(F.col("t")), t=t) == 5
    assert one(spark, text.pages(F.col("t")), t=t) == 1
