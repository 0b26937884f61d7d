"""Queries that write files or tables to the shared folder and read them again, that load documents, and that show evidence as text."""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..operators import context, export, load, merge, resolve
from ..shared import shared_dir, written
from ..schemas import TABLES
from ..sources import catalog, files, manifest
from ..sources.corpus_view import ctes
from . import ingest, ledger, prompts
from .queries import _ITEMS, _MENTIONED, _lines, query


def _place(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _read(spark: SparkSession, c, table: str) -> DataFrame:
    return spark.read.parquet(f"{c.sf_dir}/{table}.parquet")


# --- files -------------------------------------------------------------------------------------------------------------

#: One folder with one file a nation; some names say that the file is a copy or a part.
_FOLDER = "concat('f', CAST(n_nationkey AS STRING), CASE WHEN n_nationkey % 5 = 0 THEN '_Duplicate' WHEN n_nationkey % 7 = 0 THEN '_partial' ELSE '' END)"


def _nation_files(spark: SparkSession, c) -> str:
    path = _place(spark, "files")
    rows = _read(spark, c, "nation").select(F.expr(_FOLDER).alias("folder"), F.concat("n_name", F.lit(' in "'), "n_regionkey", F.lit('"')).alias("value"))
    rows.repartition("folder").write.partitionBy("folder").text(path)
    return path


def _listed(spark: SparkSession, c) -> DataFrame:
    """The files, with the folder's own name as file name: Spark chooses the names of the files themselves."""
    found = files.listing(spark, _nation_files(spark, c), "*.txt")
    return found.withColumn("file_name", F.regexp_extract("path", "folder=([^/]+)/", 1))


@query(f"SELECT {_FOLDER} AS file_name, CAST(strlen(n_name) + 8 AS BIGINT) AS length FROM nation")
def file_listing(spark, c):
    return _listed(spark, c).select("file_name", "length")


@query(f"SELECT file_name FROM (SELECT {_FOLDER} AS file_name, row_number() OVER (ORDER BY concat({_FOLDER}, '/')) AS n FROM nation) WHERE n BETWEEN 8 AND 14")
def file_batch(spark, c):
    return files.batch_window(_listed(spark, c), 2, 7).select("file_name")


@query(f"SELECT {_FOLDER} AS file_name FROM nation WHERE n_nationkey % 5 <> 0 AND n_nationkey % 7 <> 0")
def files_without_copies(spark, c):
    return files.without_copies(_listed(spark, c)).select("file_name")


@query(f"""SELECT concat('folder=', {_FOLDER}) AS folder, concat(n_name, ' in "', n_regionkey, '"', chr(10)) AS reply FROM nation""")
def reply_files(spark, c):
    return files.replies(spark, _nation_files(spark, c) + "/*/*.txt").select("folder", "reply")


_REPLIES = """SELECT s_nationkey AS document_id, s_suppkey AS chunk, CASE WHEN s_suppkey % 6 = 0 THEN concat('{"a": "', s_name) ELSE concat('{"a": "', s_name, '"}') END AS reply, s_suppkey % 6 <> 0 AS valid_json FROM supplier"""


def _written_replies(spark: SparkSession, c, which: str) -> DataFrame:
    path, bad = _place(spark, "replies"), _place(spark, "quarantine")
    rows = spark.sql(_REPLIES.replace("supplier", "{supplier}").replace("{\"a\"", "{{\"a\"").replace("'\"}'", "'\"}}'"), supplier=_read(spark, c, "supplier"))
    files.write_replies(rows.repartition("document_id"), path, bad)
    schema = "document_id long, chunk long, reply string, valid_json boolean"
    return spark.read.schema(schema).json(path if which == "valid" else bad).select("document_id", "chunk", "reply", "valid_json")


@query(f"{_REPLIES} WHERE s_suppkey % 6 <> 0")
def chunk_replies_kept(spark, c):
    return _written_replies(spark, c, "valid")


@query(f"{_REPLIES} WHERE s_suppkey % 6 = 0")
def chunk_replies_quarantined(spark, c):
    return _written_replies(spark, c, "bad")


_REVIEWED = """SELECT 'person' AS type, a.s_suppkey AS id_a, a.s_name AS name_a, b.s_suppkey AS id_b, b.s_name AS name_b, CAST(0.88 + (a.s_suppkey % 10) / 100.0 AS DOUBLE) AS score,
  CASE WHEN a.s_suppkey % 2 = 0 THEN a.s_name ELSE b.s_name END AS keep, CAST(NULL AS STRING) AS decision FROM {0} a JOIN {0} b ON b.s_suppkey = a.s_suppkey + 1"""


@query(_REVIEWED.format("supplier"))
def review_round_trip(spark, c):
    path = _place(spark, "review")
    files.write_review(spark.sql(_REVIEWED.format("{supplier}"), supplier=_read(spark, c, "supplier")), path)
    return files.review_file(spark, path)


@query("SELECT n_name AS file_name, md5(n_name) AS uuid FROM nation")
def uuid_map(spark, c):
    path = _place(spark, "uuids")
    pairs = F.map_from_entries(F.collect_list(F.struct("n_name", F.md5(F.col("n_name").cast("binary")))))
    _read(spark, c, "nation").agg(F.to_json(pairs).alias("value")).write.text(path)
    return files.uuid_map(spark, path)


@query("SELECT 'nations' AS part, n_nationkey AS k, n_name AS name FROM nation UNION ALL SELECT 'regions', r_regionkey, r_name FROM region")
def context_file(spark, c):
    path = _place(spark, "context")
    nations, regions = _read(spark, c, "nation").selectExpr("n_nationkey AS k", "n_name AS name"), _read(spark, c, "region").selectExpr("r_regionkey AS k", "r_name AS name")
    files.dump_context(path, nations=nations, regions=regions)
    read = files.load_context(spark, path)
    kept = [read.select(F.lit(p).alias("part"), F.explode(p).alias("x")).select("part", F.col("x.k").cast("long").alias("k"), "x.name") for p in ("nations", "regions")]
    return kept[0].unionByName(kept[1])


_QUOTED = """SELECT id, name, type, CASE WHEN id % 4 = 0 THEN NULL WHEN id % 4 = 1 THEN '' ELSE concat('said "', context, '",', chr(10), ' then left') END AS context FROM {0}"""


@query(f"{ctes('entities')} SELECT id, name, type, nullif(context, '') AS context FROM ({_QUOTED.format('c_entities')})")
def csv_round_trip(spark, c):
    path = _place(spark, "csv")
    rows = spark.sql(_QUOTED.format("{entities}"), entities=c["entities"])
    files.write_csv(rows, path)
    return files.read_csv(spark, path, rows.schema)


_SAID = """SELECT o_orderkey AS id, concat('Tell "', o_orderpriority, '"', chr(10), 'of ', CAST(o_orderkey AS STRING)) AS prompt, concat('{0}"k":', CAST(o_custkey AS STRING), '{1}') AS completion FROM {2}"""


@query(f"""SELECT concat('{{"messages":[{{"role":"user","content":', CAST(to_json(prompt) AS VARCHAR), '}},{{"role":"assistant","content":', CAST(to_json(completion) AS VARCHAR), '}}]}}') AS value FROM ({_SAID.format('{', '}', 'orders')})""")
def chat_file(spark, c):
    path = _place(spark, "chats")
    files.write_json_lines(export.chat_lines(spark.sql(_SAID.format("{{", "}}", "{orders}"), orders=_read(spark, c, "orders"))), path)
    return spark.read.text(path)


# --- catalog -----------------------------------------------------------------------------------------------------------

_BOTH = "SELECT id, name, type, CASE WHEN id % 2 = 0 THEN NULL ELSE context END AS context, CAST(NULL AS STRING) AS acres FROM {0}"


@query(f"{ctes('entities')} {_BOTH.format('c_entities')}")
def catalog_round_trip(spark, c):
    """Tables are made, rows are appended in two parts, and a new version is swapped in. The database goes once its rows are read."""
    name = f"corpus_{uuid.uuid4().hex}"
    catalog.create(spark, name, "v2")
    own = c["entities"]
    catalog.append(own.where("id % 2 = 0").drop("context"), name, "entities")
    catalog.append(own.where("id % 2 <> 0"), name, "entities")
    catalog.swap(catalog.load_or_empty(spark, name, "entities").withColumn("acres", F.lit(None).cast("string")), name, "entities")
    kept = written(catalog.load(spark, name, "entities").select("id", "name", "type", "context", "acres"), "catalog")
    spark.sql(f"DROP DATABASE `{name}` CASCADE")
    return kept


# --- documents ---------------------------------------------------------------------------------------------------------

_INCOMING = "SELECT id AS k, file_name, concat(collection, '/', file_name) AS file_path, full_text FROM {0}"
_CENTURIES = "concat('[', array_to_string(list_sort(list_distinct(regexp_extract_all(left(coalesce(full_text, ''), 5000), '\\b(19|20)\\d\\d\\b', 1))), ', '), ']')"
_WORDY = "len(list_filter(regexp_split_to_array(coalesce(full_text, ''), '\\s+'), lambda x: x <> '')) >= 50"


def _known(spark: SparkSession, c) -> tuple[DataFrame, DataFrame]:
    incoming = spark.sql(_INCOMING.format("{texts}"), texts=c["texts"])
    return incoming, incoming.where("k % 3 = 0").withColumn("id", F.col("k") + 7)


@query(f"""{ctes('texts')}, i AS ({_INCOMING.format('c_texts')})
SELECT (SELECT max(k) + 7 FROM i WHERE k % 3 = 0) + row_number() OVER (ORDER BY file_path) AS id, file_name, file_path, {_CENTURIES} AS extracted_dates, 'v4' AS pipeline_version
FROM i WHERE {_WORDY} AND file_path NOT IN (SELECT file_path FROM i WHERE k % 3 = 0)""")
def document_insert(spark, c):
    """All texts come in; each third is a document already, and texts of fewer than 50 words stay out."""
    fresh, _ = ingest.new_documents(*_known(spark, c), least_words=50)
    return fresh.select("id", "file_name", "file_path", "extracted_dates", "pipeline_version")


@query(f"""{ctes('texts')}, i AS ({_INCOMING.format('c_texts')}) SELECT k + 7 AS id, file_name, {_CENTURIES} AS extracted_dates FROM i WHERE k % 3 = 0""")
def document_matches(spark, c):
    """With force, what is known comes again under its old id."""
    _, again = ingest.new_documents(*_known(spark, c), force=True)
    return again.select("id", "file_name", "extracted_dates")


@query(f"""{ctes('documents')} SELECT id, CASE WHEN id % 4 = 0 THEN concat('new ', file_name) ELSE file_name END AS file_name, display_title, summary, CASE WHEN id % 4 <> 0 THEN collection END AS collection FROM c_documents""")
def document_update(spark, c):
    """Each fourth document is overwritten, null included; its title and summary stay."""
    docs = c["documents"]
    new = docs.where("id % 4 = 0").select("id", F.concat(F.lit("new "), "file_name").alias("file_name"), F.lit("gone").alias("display_title"), F.lit("gone").alias("summary"), F.lit(None).cast("string").alias("collection"))
    return load.updated_documents(docs, new)


@query(f"{ctes('documents')}, n AS (SELECT id AS k, CASE WHEN id % 3 = 0 THEN concat('other ', file_name) ELSE file_name END AS file_name FROM c_documents) SELECT n.k, n.file_name, coalesce(d.id, -1) AS existing_id FROM n LEFT JOIN c_documents d ON d.file_name = n.file_name")
def document_name_lookup(spark, c):
    name = F.when(F.col("id") % 3 == 0, F.concat(F.lit("other "), "file_name")).otherwise(F.col("file_name"))
    return load.existing_ids(c["documents"].select(F.col("id").alias("k"), name.alias("file_name")), c["documents"]).withColumn("existing_id", F.coalesce("existing_id", F.lit(-1)))


@query(f"""{ctes('documents')} SELECT id, CASE WHEN id % 6 = 0 THEN concat('about ', CAST(id AS STRING)) ELSE summary END AS summary FROM c_documents""")
def summaries_applied(spark, c):
    """Results come for each second document; those of each third of them succeeded with a text."""
    state, said = F.when(F.col("id") % 3 == 0, "succeeded").otherwise("errored"), F.concat(F.lit("about "), "id")
    results = c["documents"].where("id % 2 = 0").select(F.concat(F.lit("doc-"), "id").alias("custom_id"), state.alias("state"), said.alias("summary"), F.current_timestamp().alias("at"))
    return export.apply_summaries(c["documents"].withColumn("summary_date", F.lit(None).cast("timestamp")), results).select("id", "summary")


# --- versions ------------------------------------------------------------------------------------------------------------

_VERSIONED = ["documents", "financial_transactions", "fee_patents", "mortgages"]
_COUNTS = "SELECT {0} AS version, '{1}' AS name, count(*) AS n, CAST(coalesce(sum(id), 0) AS BIGINT) AS ids FROM {2}"


def _counted_versions(store: manifest.Store, versions: list[int]) -> DataFrame:
    """Rows and the sum of ids of each table of each version. Sums are exact: a bigint as long as all fit in one, else decimals."""
    parts = [t.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.col("id").cast("decimal(20,0)")), F.lit(0)).cast("decimal(38,0)").alias("ids")).select(F.lit(v).alias("version"), F.lit(n).alias("name"), "n", "ids") for v in versions for n, t in store.read(v).items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    out = written(out, "counts")
    fits = out.where(F.col("ids").try_cast("bigint").isNull()).isEmpty()
    return out.withColumn("ids", F.col("ids").cast("bigint")) if fits else out


@query(f"{ctes(*_VERSIONED)} " + " UNION ALL ".join(_COUNTS.format(v, t, f"c_{t}" + where) for v, what in ((1, {}), (2, {"documents": " WHERE id % 5 <> 0", **dict.fromkeys(_VERSIONED[1:], " WHERE document_id % 5 <> 0")}), (3, {"documents": " WHERE id % 5 <> 0", "fee_patents": " WHERE document_id % 5 <> 0 AND document_id % 3 <> 0", "mortgages": " WHERE document_id % 5 <> 0", "financial_transactions": " WHERE document_id % 5 <> 0 AND document_id % 3 <> 0"})) for t in _VERSIONED for where in (what.get(t, ""),)))
def version_commits(spark, c):
    """Three versions: all tables; then each fifth document and all that hangs on it gone in one commit; then the facts of each
    third cleared, in a commit that was begun from the first version's documents and finds only other tables changed."""
    store = manifest.Store(spark, _place(spark, "versions"))
    store.commit({t: c[t] for t in _VERSIONED})
    now = store.read()
    store.commit(load.cascaded(now, now["documents"].where("id % 5 = 0").select("id")))
    now = store.read()
    again = now["documents"].where("id % 3 = 0").select("id")
    cleared = load.cleared(now, again)
    store.commit({t: cleared[t] for t in ("financial_transactions", "fee_patents")}, reads=("documents",))
    return _counted_versions(store, store.versions())


# --- model calls ---------------------------------------------------------------------------------------------------------


def _reader():
    """A stand-in for a model: it names a chunk's first word of four letters or more and its first of seven or more, and
    tells its length; one chunk in seven makes it fail, one in eleven of the rest gets no JSON."""

    def ask(prompt: str) -> str:
        said = prompt.split("Return JSON only.\n", 1)[1][1:]
        n = len(said)
        if n % 7 == 0:
            raise ValueError(f"{n} characters")
        if n % 11 == 0:
            return "no json"
        words = [m[0] for p in ("[a-z]{4,}", "[a-z]{7,}") if (m := re.search(p, said))]
        return json.dumps({"entities": [{"name": w, "type": "word", "context": f"of {n}"} for w in words], "events": [{"type": "chunk", "description": f"{n} characters"}]})

    return ask


_ASKED_CHUNKS = f"""{ctes('texts')}, d AS (SELECT row_number() OVER (ORDER BY concat(collection, '/', file_name)) AS document_id, concat(collection, '/', file_name) AS source, full_text FROM c_texts),
k AS (SELECT *, unnest(range(CAST(greatest(1, ceil((length(full_text) - 500) / 3500.0)) AS INT))) AS chunk FROM d WHERE length(full_text) > 0),
t AS (SELECT document_id, source, chunk, substring(full_text, chunk * 3500 + 1, 4000) AS said FROM k),
r AS (SELECT *, length(said) AS n FROM t)"""


_READING = {"size": 4000, "overlap": 500, "model": "reader"}


def _texts_to_read(spark: SparkSession, c) -> DataFrame:
    return spark.sql(_INCOMING.format("{texts}"), texts=c["texts"]).drop("k")


def _ingested(spark: SparkSession, c, path: str) -> dict[str, DataFrame]:
    none = {n: spark.createDataFrame([], s) for n, s in TABLES.items()}
    return ingest.ingest(_texts_to_read(spark, c), none, lambda: _reader(), ledger=path, **_READING)


@query(f"""{_ASKED_CHUNKS}, good AS (SELECT * FROM r WHERE n % 7 <> 0 AND n % 11 <> 0),
e AS (SELECT DISTINCT document_id, chunk, name, concat('of ', CAST(n AS VARCHAR)) AS context FROM (SELECT *, unnest([regexp_extract(said, '[a-z]{{4,}}'), regexp_extract(said, '[a-z]{{7,}}')]) AS name FROM good) WHERE name <> ''),
m AS (SELECT document_id, name, string_agg(context, '; ' ORDER BY chunk) AS told FROM (SELECT document_id, name, context, min(chunk) AS chunk FROM e GROUP BY ALL) GROUP BY ALL)
SELECT 'document' AS kind, document_id, source AS name, '' AS told FROM d UNION ALL SELECT 'entity', -1, name, 'word' FROM (SELECT DISTINCT name FROM e)
UNION ALL SELECT 'mention', document_id, name, told FROM m UNION ALL SELECT DISTINCT 'event', document_id, 'chunk', concat(CAST(n AS VARCHAR), ' characters') FROM good""")
def ingest_tables(spark, c):
    """All texts come into empty tables, by way of a stand-in for the model."""
    out = _ingested(spark, c, _place(spark, "ledger"))
    names = out["entities"].select(F.col("id").alias("entity_id"), "name")
    rows = out["documents"].select(F.lit("document").alias("kind"), F.col("id").alias("document_id"), F.col("file_path").alias("name"), F.lit("").alias("told"))
    rows = rows.unionByName(out["entities"].select(F.lit("entity").alias("kind"), F.lit(-1).cast("long").alias("document_id"), "name", F.col("type").alias("told")))
    rows = rows.unionByName(out["mentions"].join(names, "entity_id").select(F.lit("mention").alias("kind"), "document_id", "name", F.col("context").alias("told")))
    return rows.unionByName(out["events"].select(F.lit("event").alias("kind"), "document_id", F.col("type").alias("name"), F.col("description").alias("told")))


@query(f"""{_ASKED_CHUNKS} SELECT source, chunk, CASE WHEN n % 7 = 0 THEN 'refused' ELSE 'answered' END AS state, CAST(1 AS INT) AS attempts, CASE WHEN n % 7 = 0 THEN concat(CAST(n AS VARCHAR), ' characters') ELSE '' END AS error FROM r""")
def reply_ledger(spark, c):
    """What the ledger holds after two runs over the same files: one call a chunk. No table is asked for, so none is made."""
    path = _place(spark, "ledger")
    for _ in range(2):
        new = ingest.new_documents(_texts_to_read(spark, c), spark.createDataFrame([], TABLES["documents"]))
        ingest.extracted(*new, lambda: _reader(), ledger=path, **_READING)
    return ledger.read(spark, path).select("source", F.col("chunk").cast("long").alias("chunk"), "state", "attempts", "error")


# --- merging -----------------------------------------------------------------------------------------------------------


@query(f"SELECT * FROM ({_MENTIONED.format(lineitem='lineitem')}) QUALIFY row_number() OVER (PARTITION BY document_id, lower(coalesce(name, '')), type ORDER BY chunk, pos) = 1")
def merge_uploaded_entities(spark, c):
    return merge.uploaded_entities(_lines(spark, c.sf_dir, _MENTIONED))


_CHUNKED = "SELECT l_orderkey AS document_id, l_partkey * 100000 + l_suppkey * 10 + l_linenumber AS chunk, concat(l_returnflag, CAST(l_partkey % 3 AS STRING)) AS a, CASE WHEN l_partkey % 4 <> 0 THEN l_linestatus END AS b FROM {lineitem}"


@query(f"""SELECT document_id, string_agg(a || ';' || a, ';' ORDER BY chunk, a, b NULLS FIRST) AS events, coalesce(string_agg(b, ';' ORDER BY chunk, a, b), '') AS taxes FROM ({_CHUNKED.format(lineitem='lineitem')}) GROUP BY document_id""")
def concatenated_lists(spark, c):
    """Each chunk has an event twice, and a tax or none; nothing is merged."""
    rows = _lines(spark, c.sf_dir, _CHUNKED)
    result = F.struct(F.array("a", "a").alias("events"), F.filter(F.array("b"), lambda x: x.isNotNull()).alias("taxes"))
    lists = merge.concatenated(rows.select("document_id", "chunk", result.alias("result")), ["events", "taxes"])
    return lists.select("document_id", F.array_join("events", ";").alias("events"), F.array_join("taxes", ";").alias("taxes"))


@query(" UNION ALL ".join(f"SELECT '{g}' AS group_name, count(*) AS n FROM (SELECT 1 FROM ({_ITEMS[g][0].format(lineitem='lineitem')}) GROUP BY document_id, {', '.join(f'coalesce({k}, chr(0))' if k == 'date' else k for k in _ITEMS[g][1])})" for g in ("fee_patents", "legislative_actions")))
def run_summary(spark, c):
    return ingest.run_summary({g: merge.first_of_equal(_lines(spark, c.sf_dir, _ITEMS[g][0]), g) for g in ("fee_patents", "legislative_actions")})


@query(f"""{ctes('entities')} SELECT concat('{{"id":', CAST(id AS STRING), ',"name":', CAST(to_json(name) AS VARCHAR), ',"type":"', type, '"}}') AS value FROM c_entities""")
def audit_lines(spark, c):
    path = _place(spark, "audit")
    files.write_json_lines(resolve.merge_log(c["entities"].select("id", "name", "type")), path)
    return spark.read.text(path)


# --- evidence as text --------------------------------------------------------------------------------------------------

_SOURCE = "'Source: ' || coalesce(nullif(display_title, ''), file_name)"


def _facts(c, table: str) -> DataFrame:
    return c[table].join(c["documents"].select(F.col("id").alias("document_id"), "file_name", "display_title"), "document_id")


def _lines_sql(table: str, line: str, order: str, most: int) -> str:
    return f"""{ctes('documents', table)}, f AS (SELECT t.*, d.file_name, d.display_title FROM c_{table} t JOIN c_documents d ON d.id = t.document_id)
SELECT CAST(n AS INT) AS n, line FROM (SELECT row_number() OVER (ORDER BY {order}) AS n, {line} AS line FROM f) WHERE n <= {most}"""


@query(_lines_sql("financial_transactions", f"""'  - [' || coalesce(date, 'n/d') || '] ' || coalesce(type, '') || ': ' || coalesce(payer, '?') || ' → ' || coalesce(payee, '?') || ', Amount: ' || coalesce(amount, 'n/a')
  || chr(10) || '    For: ' || coalesce(for_what, 'n/a') || ' | Context: ' || left(coalesce(context, ''), 150) || ' | ' || {_SOURCE}""", "date NULLS LAST, id", 30))
def evidence_transactions(spark, c):
    return context.fact_lines(_facts(c, "financial_transactions"), "financial_transactions")


@query(_lines_sql("relationships", f"""'  - ' || coalesce(subject, '?') || ' —[' || coalesce(type, '?') || ']→ ' || coalesce(object, '?') || chr(10) || '    Context: ' || left(coalesce(context, ''), 150) || ' | ' || {_SOURCE}""", "subject NULLS LAST, type NULLS LAST, id", 40))
def evidence_relationships(spark, c):
    return context.fact_lines(_facts(c, "relationships"), "relationships")


@query(_lines_sql("events", f"""'  - [' || coalesce(date, 'n/d') || '] ' || coalesce(type, '') || ': ' || left(coalesce(description, ''), 200) || chr(10) || '    Location: ' || coalesce(location, 'n/a') || ' | ' || {_SOURCE}""", "date NULLS LAST, id", 40))
def evidence_events(spark, c):
    return context.fact_lines(_facts(c, "events"), "events")


def _parts_sql(table: str) -> str:
    _, most, by, parts = context.PART_SECTIONS[table]
    shown = ", ".join(f"CASE WHEN coalesce({k}, '') <> '' THEN '{p}' || left({k}, 200) END" for k, p in parts.items())
    return _lines_sql(table, f"'  - ' || concat_ws(' | ', {shown}) || chr(10) || '    ' || {_SOURCE}", f"{by} NULLS LAST, id", most)


@query(_parts_sql("fee_patents"))
def evidence_patents(spark, c):
    return context.fact_lines(_facts(c, "fee_patents"), "fee_patents")


@query(_parts_sql("legislative_actions"))
def evidence_bills(spark, c):
    return context.fact_lines(_facts(c, "legislative_actions"), "legislative_actions")


@query(r"SELECT id, replace(t, '$', '\$') AS t FROM (SELECT o_orderkey AS id, concat('cost $', CAST(o_custkey AS STRING), CASE WHEN o_orderkey % 3 = 0 THEN ' or $$5' ELSE '' END) AS t FROM orders)")
def dollars_escaped(spark, c):
    said = F.concat(F.lit("cost $"), "o_custkey", F.when(F.col("o_orderkey") % 3 == 0, " or $$5").otherwise(""))
    return _read(spark, c, "orders").select(F.col("o_orderkey").alias("id"), text.escape_dollars(said).alias("t"))


_RATED = "SELECT id, name, type, context, id % 5 AS relevance_score, id % 9 AS doc_count, concat('f', CAST(id % 4 AS STRING), '.pdf') AS file FROM {0}"


@query(f"""{ctes('entities')}, r AS (SELECT *, row_number() OVER (PARTITION BY type ORDER BY relevance_score DESC, name, id) AS place FROM ({_RATED.format('c_entities')}))
SELECT CAST(row_number() OVER (ORDER BY type, place) AS INT) AS n, '  [' || upper(type) || '] ' || name || ' (in ' || CAST(doc_count AS VARCHAR) || ' docs): ' || left(coalesce(context, ''), 200) || chr(10) || '      Sources: '
  || CASE id % 5 WHEN 0 THEN 'unknown' WHEN 1 THEN file ELSE file || ', b, c' END AS line FROM r WHERE place <= 25""")
def evidence_entities(spark, c):
    rated = spark.sql(_RATED.format("{entities}"), entities=c["entities"])
    k, names = F.col("id") % 5, F.array("file", F.lit("b"), F.lit("c"), F.lit("d"))
    return context.entity_lines(rated.withColumn("source_files", F.slice(names, 1, F.when(k == 0, 0).when(k == 1, 1).otherwise(4))))


_ASKED = "Who sold?"


def _prompt_sql(mode: str) -> str:
    task = prompts.TASKS[mode].replace("'", "''")
    return f"'{task}' || chr(10) || chr(10) || 'QUESTION: {_ASKED}' || chr(10) || chr(10) || 'EVIDENCE:' || chr(10) || summary"


@query(f"""{ctes('documents')}, s AS (SELECT id, summary FROM c_documents WHERE summary IS NOT NULL)
SELECT id, {', '.join(f'md5({_prompt_sql(m)}) AS {m}' for m in prompts.TASKS)}, md5('{prompts.TASKS['corpus']}' || chr(10) || chr(10) || 'EVIDENCE:' || chr(10) || summary || chr(10) || chr(10) || 'CONVERSATION:' || chr(10)
  || 'USER: Who?' || chr(10) || chr(10) || 'ASSISTANT: Ann.' || chr(10) || chr(10) || 'QUESTION: {_ASKED}') AS follow_up FROM s""")
def analysis_prompts(spark, c):
    said = [{"role": "user", "content": "Who?"}, {"role": "assistant", "content": "Ann."}]
    told = {m: prompts.analysis_prompt(m, _ASKED, F.col("summary")) for m in prompts.TASKS} | {"follow_up": prompts.follow_up(_ASKED, said, F.col("summary"))}
    return c["documents"].where("summary is not null").select("id", *[F.md5(p.cast("binary")).alias(m) for m, p in told.items()])


def _prompt_head(version: str) -> str:
    return f"""'Read the document below and return one JSON object. Each key holds an array of flat objects; every value is a string, or null if the document doesn''t say.' || chr(10) || chr(10) || 'Keys and fields:' || chr(10)
  || '{prompts.outline(version)}' || chr(10) || chr(10) || 'Return JSON only.' || chr(10)"""


@query(f"""{ctes('texts')} SELECT id, md5({_prompt_head('v4')} || chr(10) || 'Document: ' || coalesce(display_title, 'untitled') || chr(10) || chr(10) || coalesce(full_text, '')) AS v4, md5({_prompt_head('v2')} || chr(10) || coalesce(full_text, '')) AS v2 FROM c_texts""")
def extraction_prompts(spark, c):
    """Prompts of whole texts, with a title by the latest version, without one by the first."""
    said = F.col("full_text")
    told = {"v4": prompts.extraction_prompt(said, F.col("display_title"), "v4"), "v2": prompts.extraction_prompt(said, None, "v2")}
    return c["texts"].select("id", *[F.md5(p.cast("binary")).alias(v) for v, p in told.items()])
