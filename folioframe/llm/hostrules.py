"""Quality rules per document, and verdicts on whole hosts from their documents' failures."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .kernels import IS_WORD, U64, mix, runs, span_hashes, text_slices, window_hashes
from .work import arrow_map, staged

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_LEADS = (np.arange(256) & 0xC0) != 0x80  # bytes that begin a code point
WINDOW = 5
COUNTERS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _per_row(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def measure(column: pa.Array) -> dict[str, np.ndarray]:
    """The counters of each text of a string column. Nulls count as empty."""
    out: dict[str, list] = {k: [] for k in COUNTERS}
    for first, end, data, offsets in text_slices(column):
        rows = end - first
        word = IS_WORD[data]
        starts, ends = runs(word, offsets)
        bounds = np.searchsorted(starts, offsets)
        out["n_words"].append(np.diff(bounds))
        out["word_chars"].append(_per_row(word & _LEADS[data], offsets))
        out["n_symbols"].append(_per_row(_SYMBOL[data], offsets))
        a, b = runs(data != 10, offsets)  # empty lines have no word
        worded = np.searchsorted(starts, b) > np.searchsorted(starts, a)
        a, b = a[worded], b[worded]
        row = np.searchsorted(offsets, a, "right") - 1
        _, firsts = np.unique(mix(span_hashes(data, a, b) + row.astype(U64) * U64(0x9E3779B97F4A7C15)), return_index=True)
        out["n_dup_lines"].append(np.bincount(row, minlength=rows) - np.bincount(row[firsts], minlength=rows))
        owner = np.searchsorted(offsets, starts, "right") - 1
        windows = window_hashes(span_hashes(data, starts, ends), WINDOW)
        cover = np.zeros(len(starts) + 1, np.int64)
        if len(windows):
            inside = np.flatnonzero(owner[: len(windows)] == owner[WINDOW - 1 :])
            keys = mix(windows[inside] + owner[inside].astype(U64) * U64(0x9E3779B97F4A7C15))
            _, which, times = np.unique(keys, return_inverse=True, return_counts=True)
            again = inside[times[which] > 1]
            np.add.at(cover, again, 1)
            np.add.at(cover, again + WINDOW, -1)
        out["n_repeat_words"].append(_per_row(np.cumsum(cover[:-1]) > 0, bounds))
    return {k: np.concatenate(v).astype(np.int64) if v else np.zeros(0, np.int64) for k, v in out.items()}


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = measure(batch.column("text"))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("host"), *(pa.array(found[k]) for k in COUNTERS)], ["doc_id", "host", *COUNTERS])


def host_of(url: Column) -> Column:
    """The lower-case host of a URL, without user and port; null where there is none."""
    return F.nullif(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))


def host_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host: Column | str = "source", least_words: int = 10, repeat_percent: int = 20, host_limit: float = 0.5, salts: int = 16, broadcast_hosts: int = 100_000) -> DataFrame:
    """Per row: doc_id, host, the counters, base_failed, host_docs, host_rate, host_failed, kept.

    base_failed: fewer than ``least_words`` words, or more than ``repeat_percent`` % of them in repeated five-word windows.
    Failures are counted by host; each host's rate is shrunk towards the corpus by a beta prior fitted to the hosts'
    rates by moments; a host whose shrunk rate exceeds ``host_limit`` fails, with all its documents.

    Null texts count as empty. Rows with a null host belong to no host, and no host verdict touches them. Null and
    repeated ids are kept as rows. An empty table gives an empty result. Only failed hosts are joined back: broadcast
    when they are at most ``broadcast_hosts``, else by host and salt, so that a hot host is dealt over ``salts`` tasks.
    """
    host = F.col(host) if isinstance(host, str) else host
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), host.cast("string").alias("host"), F.col(text_col).alias("text"))
    base = staged(arrow_map(own, _measured, "doc_id long, host string, " + ", ".join(f"{k} long" for k in COUNTERS)), "rules")
    base = base.withColumn("base_failed", (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words")))
    hosts = staged(base.where("host is not null").groupBy("host").agg(F.count("*").alias("n"), F.sum(F.col("base_failed").cast("long")).alias("f")), "hosts")
    n, f, squares, h = hosts.agg(F.sum("n"), F.sum("f"), F.sum(F.col("f") * F.col("f") / F.col("n")), F.count("*")).first()
    alpha, beta = beta_prior(n or 0, f or 0, squares or 0.0, h)
    rate = (F.col("f") + alpha) / (F.col("n") + alpha + beta)
    failed = hosts.select("host", F.col("n").alias("host_docs"), rate.alias("host_rate")).where(F.col("host_rate") > host_limit)
    if failed.count() <= broadcast_hosts:
        out = base.join(F.broadcast(failed), "host", "left")
    else:
        salted = base.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int"))
        out = salted.join(failed.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))), ["host", "salt"], "left")
    out = out.withColumn("host_failed", F.col("host_rate").isNotNull())
    return out.select("doc_id", *COUNTERS, "base_failed", (~F.col("base_failed") & ~F.col("host_failed")).alias("kept"), "host", "host_failed", "host_rate")


def beta_prior(n: int, f: int, squares: float, hosts: int) -> tuple[float, float]:
    """Beta parameters by moments: n documents, f failures, squares = sum of f_i**2 / n_i over the hosts.

    The variance between hosts is what their rates vary beyond binomial noise; without any, the prior is as strong as the corpus.
    """
    if not n or not hosts:
        return 1.0, 1.0
    mean = min(max(f / n, 1 / (2 * n + 2)), 1 - 1 / (2 * n + 2))
    noise = mean * (1 - mean)
    between = (squares - n * mean * mean) / n - noise * hosts / n
    strength = min(max(noise / between - 1, 1.0), float(n)) if between > 0 else float(n)
    return mean * strength, (1 - mean) * strength
