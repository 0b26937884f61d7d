"""Queries of the training-data operators and, where SQL can express them, the same in DuckDB's SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontaminate, hostrules, lines, lyndon, minhash, packing, pii, quality, repeats, simhash, tokens, vectors


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_edit_aware_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return tokens.counted(docs.withColumn("edits", tokens.sample_edits(F.col("text"), F.col("doc_id"))))


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), percent=85)


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(_table(spark, sf_dir, "documents"))


def op4_host_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hostrules.host_rules(_table(spark, sf_dir, "documents")).drop("host_rate")


def op5_pu_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_pii_anchor_expansion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(_table(spark, sf_dir, "documents"))


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.long_repeats(_table(spark, sf_dir, "documents")).drop("removed")


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).drop("hit_spans")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.repeated_units(_table(spark, sf_dir, "documents"))


def op10_chat_snapshot_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.chat(_table(spark, sf_dir, "conversations"))


def op11_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lyndon.runs(_table(spark, sf_dir, "documents"), repeat_rule=True).drop("runs")


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.compressed(_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_edit_aware_token_counts": op1_edit_aware_token_counts,
    "op2_minhash_near_dedup": op2_minhash_near_dedup,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_host_quality_rules": op4_host_quality_rules,
    "op5_pu_quality_classifier": op5_pu_quality_classifier,
    "op6_pii_anchor_expansion": op6_pii_anchor_expansion,
    "op7_suffix_array_dedup": op7_suffix_array_dedup,
    "op8_benchmark_decontamination": op8_benchmark_decontamination,
    "op9_line_dedup": op9_line_dedup,
    "op10_chat_snapshot_collapse": op10_chat_snapshot_collapse,
    "op11_simhash_near_dedup": op11_simhash_near_dedup,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_vector_codes": op13_vector_codes,
}



def _lloyd_sql(rounds: int) -> str:
    """Lloyd's rounds one after the other: distances through dot products, which doubles hold exactly here."""
    near = lambda r: f"""
a{r} AS MATERIALIZED (
  SELECT row, p, min({{'d': d, 'e': e}}) AS m FROM (
    SELECT row, parts.p, e, list_dot_product(x, x) - 2 * list_dot_product(x, c) + list_dot_product(c, c) AS d FROM parts JOIN b{r} ON parts.p = b{r}.p)
  GROUP BY row, p)"""  # noqa: E731
    move = lambda r: f"""
b{r + 1} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(s.c, b.c) AS c FROM b{r} b LEFT JOIN (
    SELECT p, e, list(s ORDER BY i) AS c FROM (
      SELECT parts.p, m.e AS e, i, floor(sum(x[i]) / count(*)) AS s FROM parts JOIN a{r} ON parts.row = a{r}.row AND parts.p = a{r}.p, (SELECT unnest(range(1, (SELECT max(len(x)) FROM parts) + 1)) AS i)
      GROUP BY parts.p, m.e, i) GROUP BY p, e) s ON b.p = s.p AND b.e = s.e)"""  # noqa: E731
    steps = ",".join(near(r) + "," + move(r) for r in range(rounds))
    return f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS row, vec_id, label, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (SELECT row, p, q[p * len(q) // 4 + 1 : (p + 1) * len(q) // 4] AS x FROM kept, range(4) r(p)),
b0 AS MATERIALIZED (SELECT p, row - 1 AS e, x AS c FROM parts WHERE row <= 256),{steps},{near(rounds)},
coded AS (
  SELECT row, string_agg(lpad(lower(to_hex(m.e)), 2, '0'), '' ORDER BY p) AS code, CAST(sum(m.d) AS BIGINT) AS error FROM a{rounds} GROUP BY row),
digest AS (SELECT sha256(string_agg(array_to_string(list_transform(c, lambda v: CAST(CAST(v AS BIGINT) AS VARCHAR)), ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM kept JOIN coded USING (row), digest"""


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL: dict[str, str] = {
    "op2_minhash_near_dedup": rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce({_LOWER}, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')))
                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM words),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS s FROM sets),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM items a JOIN items b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach AS (SELECT doc_id, doc_id AS r FROM sets UNION SELECT reach.doc_id, links.y FROM reach JOIN links ON reach.r = links.x)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, c.component_id, s.doc_id = c.component_id AS kept
FROM sets s JOIN (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id) c ON s.doc_id = c.doc_id""",
    "op4_host_quality_rules": r"""
WITH words AS (
  SELECT doc_id, source, coalesce(text, '') AS t, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i+4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM words)),
again AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, s) > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM again, range(5) r(k) GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM words),
dup AS (SELECT doc_id, count(*) - count(DISTINCT l) AS n FROM lines WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id),
base AS (
  SELECT doc_id, source AS host, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, coalesce(dup.n, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
    len(w) < 10 OR 100 * coalesce(covered.n, 0) > 20 * len(w) AS base_failed
  FROM words LEFT JOIN dup USING (doc_id) LEFT JOIN covered USING (doc_id)),
hosts AS (SELECT host, CAST(count(*) AS DOUBLE) AS n, CAST(sum(CAST(base_failed AS INT)) AS DOUBLE) AS f FROM base WHERE host IS NOT NULL GROUP BY host),
moments AS (SELECT sum(n) AS n, greatest(least(sum(f) / sum(n), 1 - 1 / (2 * sum(n) + 2)), 1 / (2 * sum(n) + 2)) AS m, sum(f * f / n) AS q, count(*) AS h FROM hosts),
spread AS (SELECT n, m, m * (1 - m) AS noise, (q - n * m * m) / n - m * (1 - m) * h / n AS between_hosts FROM moments),
prior AS (SELECT m, CASE WHEN between_hosts > 0 THEN least(greatest(noise / between_hosts - 1, 1.0), n) ELSE n END AS strength FROM spread),
failed AS (SELECT host FROM hosts, prior WHERE (f + m * strength) / (n + strength) > 0.5)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND failed.host IS NULL AS kept, base.host, failed.host IS NOT NULL AS host_failed
FROM base LEFT JOIN failed ON base.host = failed.host""",
    "op8_benchmark_decontamination": rf"""
WITH items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
windows AS (
  SELECT DISTINCT item, k, array_to_string(w[i:i+k-1], ' ') AS s
  FROM (SELECT item, w, least(13, len(w)) AS k, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM items WHERE len(w) > 0)),
words AS (SELECT doc_id, regexp_extract_all(coalesce({_LOWER}, ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
found AS (
  SELECT d.doc_id, d.i, d.k, windows.item
  FROM (SELECT doc_id, k, i, array_to_string(w[i:i+k-1], ' ') AS s
        FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, (SELECT DISTINCT k FROM windows))) d
  JOIN windows ON d.k = windows.k AND d.s = windows.s),
hit AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM found) GROUP BY doc_id),
which AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(which.n, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(hit.n, 0) > 0 AND 20 * coalesce(hit.n, 0) >= len(w) AS contaminated
FROM words LEFT JOIN hit USING (doc_id) LEFT JOIN which USING (doc_id)""",
    "op9_line_dedup": rf"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
each_line AS (SELECT doc_id, i, l[i] AS line, coalesce(list_sum(list_transform(l[1:i-1], lambda x: length(x) + 1)), 0) AS before FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM split)),
cut AS (SELECT doc_id, i, before, regexp_extract_all(line, '.*?[.!?][\x20\x09-\x0D]+|.+') AS p FROM each_line),
pieces AS (
  SELECT doc_id, i, j, before + coalesce(list_sum(list_transform(p[1:j-1], lambda x: length(x))), 0) AS s, length(p[j]) AS n,
    list_filter(regexp_split_to_array(translate(p[j], 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM (SELECT doc_id, i, before, p, unnest(range(1, len(p) + 1)) AS j FROM cut)),
counted AS (
  SELECT *, sum(CAST(len(w) >= 8 AS INT)) OVER (PARTITION BY doc_id, i) AS whole,
    coalesce(sum(CAST(len(w) >= 8 AS INT)) OVER (PARTITION BY doc_id, i ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier FROM pieces),
units AS (
  SELECT doc_id, min(s) AS s, max(s + n) AS e, flatten(list(w ORDER BY j)) AS w FROM counted
  GROUP BY doc_id, i, least(earlier, greatest(whole - 1, 0)) HAVING sum(len(w)) > 0),
ranked AS (SELECT doc_id, s, e, row_number() OVER (PARTITION BY w ORDER BY doc_id, s) AS r FROM units),
gone AS (SELECT doc_id, count(*) AS n, CAST(sum(e - s) AS BIGINT) AS chars, string_agg(CAST(CAST(s AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(e AS BIGINT) AS VARCHAR), ',' ORDER BY s) AS spans FROM ranked WHERE r > 1 GROUP BY doc_id),
total AS (SELECT doc_id, count(*) AS n FROM units GROUP BY doc_id)
SELECT d.doc_id, coalesce(total.n, 0) AS n_units, coalesce(gone.n, 0) AS n_removed, coalesce(gone.chars, 0) AS chars_removed, coalesce(gone.spans, '') AS removed
FROM documents d LEFT JOIN total USING (doc_id) LEFT JOIN gone USING (doc_id)""",
    "op10_chat_snapshot_collapse": r"""
WITH chats AS (
  SELECT conv_id, list(concat(coalesce('r' || role, 'n'), chr(0), coalesce('t' || text, 'n')) ORDER BY turn, role, text) AS l,
    string_agg('<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10), '' ORDER BY turn, role, text) AS rendered
  FROM conversations GROUP BY conv_id),
keys AS (SELECT l, min(conv_id) AS conv_id, count(*) AS n_copies FROM chats GROUP BY l),
inner_prefixes AS (SELECT DISTINCT l[1:i] AS p FROM (SELECT l, unnest(range(1, len(l))) AS i FROM keys))
SELECT k.conv_id, CAST(len(k.l) AS BIGINT) AS n_turns, k.n_copies, c.rendered AS text
FROM keys k JOIN chats c ON c.conv_id = k.conv_id WHERE NOT EXISTS (SELECT 1 FROM inner_prefixes WHERE p = k.l)""",
    "op13_vector_codes": _lloyd_sql(4),
}
