"""A quality classifier from positive and unlabelled texts, by non-negative unbiased risk."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .hostrules import _per_row, measure
from .kernels import IS_WORD, LOWER, U64, mix, runs, span_hashes, text_slices
from .work import arrow_map

FEATURES = ["words", "word_len", "symbols", "root_symbols", "upper", "bangs", "bars", "digits", "twins", "distinct", "repeats", "dup_lines", "stops", "odd_ends", "capitals", "wide", "line_words"]
_FLAGS = {
    "upper": [*range(65, 91)],
    "letters": [*range(65, 91), *range(97, 123)],
    "bangs": list(b"!?"),
    "bars": list(b"|"),
    "digits": list(b"0123456789"),
    "stops": list(b".,;:"),
    "wide": [*range(0xC0, 256)],
    "breaks": [10],
}
_ODD = np.ones(256, bool)
_ODD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256), *b".,;:"]] = False
_CAPITAL = np.zeros(256, bool)
_CAPITAL[65:91] = True


def features(column: pa.Array) -> np.ndarray:
    """A row of features per text; nulls and empty texts have zeros in all that is a share of their words."""
    base = measure(column)
    parts: dict[str, list[np.ndarray]] = {k: [] for k in (*_FLAGS, "twins", "distinct", "odd_ends", "capitals")}
    for first, end, data, offsets in text_slices(column):
        for name, which in _FLAGS.items():
            table = np.zeros(256, bool)
            table[which] = True
            parts[name].append(_per_row(table[data], offsets))
        starts, ends = runs(IS_WORD[data], offsets)
        bounds = np.searchsorted(starts, offsets)
        owner = np.searchsorted(offsets, starts, "right") - 1
        own = mix(span_hashes(LOWER[data], starts, ends) + owner.astype(U64) * U64(0x9E3779B97F4A7C15))
        twin = np.zeros(len(own), bool)
        twin[1:] = own[1:] == own[:-1]
        _, firsts = np.unique(own, return_index=True)
        parts["twins"].append(_per_row(twin, bounds))
        parts["distinct"].append(np.bincount(owner[firsts], minlength=end - first))
        parts["odd_ends"].append(_per_row(_ODD[data[ends - 1]], bounds))
        parts["capitals"].append(_per_row(_CAPITAL[data[starts]], bounds))
    got = {k: np.concatenate(v).astype(float) if v else np.zeros(0) for k, v in parts.items()}
    n = np.maximum(1, base["n_words"]).astype(float)
    lines = got["breaks"] + 1
    share = {k: got[k] / n for k in ("bangs", "bars", "digits", "twins", "distinct", "stops", "odd_ends", "capitals", "wide")}
    share |= {
        "words": np.log1p(base["n_words"]),
        "word_len": base["word_chars"] / n,
        "symbols": base["n_symbols"] / n,
        "root_symbols": np.sqrt(base["n_symbols"] / n),
        "upper": got["upper"] / np.maximum(1, got["letters"]),
        "repeats": base["n_repeat_words"] / n,
        "dup_lines": base["n_dup_lines"] / lines,
        "line_words": np.log1p(base["n_words"] / lines),
    }
    return np.column_stack([share[k] for k in FEATURES]) if len(n) else np.zeros((0, len(FEATURES)))


def risk_parts(w: np.ndarray, p: np.ndarray, u: np.ndarray, prior: float) -> tuple[float, float, np.ndarray, np.ndarray]:
    """prior * E_p[loss(g)], the bracket E_u[loss(-g)] - prior * E_p[loss(-g)], and the gradient of each, for the logistic loss."""
    sp, su = 1 / (1 + np.exp(-p @ w)), 1 / (1 + np.exp(-u @ w))
    loss = lambda s: -np.log(np.maximum(1e-12, s)).mean()
    bracket = loss(1 - su) - prior * loss(1 - sp)
    return prior * loss(sp), bracket, prior * (p.T @ (sp - 1)) / len(p), u.T @ su / len(u) - prior * (p.T @ sp) / len(p)


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, rounds: int = 600, rate: float = 0.05, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and bias on raw features that minimise the non-negative unbiased risk with the logistic loss.

    Risk: prior * E_p[loss(g)] + max(0, E_u[loss(-g)] - prior * E_p[loss(-g)]). Where the bracket is negative the step
    goes up its gradient, as the non-negative estimator asks. Full-batch Adam from zero: the same rows give the same weights.
    """
    both = np.vstack([positive, unlabelled])
    centre, scale = both.mean(0), both.std(0) + 1e-6
    squash = lambda x: np.clip((x - centre) / scale, -6, 6)
    p = np.column_stack([squash(positive), np.ones(len(positive))])
    u = np.column_stack([squash(unlabelled), np.ones(len(unlabelled))])
    w = np.zeros(p.shape[1])
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, rounds + 1):
        _, bracket, up, down = risk_parts(w, p, u, prior)
        g = (up + down if bracket >= 0 else -down) + decay * np.append(w[:-1], 0)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return np.vstack([w[:-1], centre, scale]), float(w[-1])


def score(x: np.ndarray, model: tuple[np.ndarray, float] | float) -> np.ndarray:
    """Scores of feature rows; a model that is only a number scores all alike."""
    if isinstance(model, float):
        return np.full(len(x), model)
    (w, centre, scale), bias = model
    return 1 / (1 + np.exp(-(np.clip((x - centre) / scale, -6, 6) @ w + bias)))


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = 20_000) -> tuple[np.ndarray, float] | float:
    """The model that ``classify`` describes, or the class prior alone where there is no positive.

    The samples are the ids whose hash comes first, at most ``sample`` each; that bound is what makes them fit for a
    broadcast, and texts are read for those ids only.
    """
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where("doc_id is not null").where(~held_out())
    told = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label")).where("doc_id is not null and label is not null").where(~held_out())
    seen = told.agg(F.count("*"), F.sum((F.col("label") == 1).cast("long"))).first()
    prior = ((seen[1] or 0) + 1) / (seen[0] + 2)
    ids = own.select("doc_id").distinct()
    first = lambda df: df.orderBy(F.xxhash64("doc_id", F.lit(11)), "doc_id").limit(sample)
    chosen = first(ids.join(told.where("label = 1").select("doc_id").distinct(), "doc_id", "left_semi")).withColumn("trusted", F.lit(True)).unionByName(first(ids).withColumn("trusted", F.lit(False)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = features(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("trusted"), *(pa.array(x[:, i]) for i in range(len(FEATURES)))], ["doc_id", "trusted", *FEATURES])

    table = arrow_map(own.join(F.broadcast(chosen), "doc_id").select("doc_id", "trusted", "text"), run, "doc_id long, trusted boolean, " + ", ".join(f"{k} double" for k in FEATURES))
    rows = sorted(tuple(r) for r in table.collect())
    of = lambda trusted: np.array([r[2:] for r in rows if r[1] == trusted], float).reshape(-1, len(FEATURES))
    return fit(of(True), of(False), prior) if len(of(True)) else float(prior)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3, **options) -> DataFrame:
    """Per row: doc_id, held_out, score (0 to 1), predicted (1 if score >= ``threshold``).

    Held out are rows whose crc32(doc_id as text) mod 5 is 0; no label of theirs is read. Trusted positives are labelled
    rows of the rest with label 1; unlabelled text is all of the rest. The class prior is estimated as the smoothed
    share of positives among the labelled rows of the rest. The model is fitted on at most ``sample`` positives and
    ``sample`` unlabelled rows (20,000 each), those whose hashed id comes first, and scores every row. Scores see texts only.

    Null texts count as empty; a row with null id is scored and not held out. Without positives all scores are the prior.
    """
    model = train(docs, labels, id_col, text_col, **options)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score(features(batch.column("text")), model))], ["doc_id", "score"])

    own = arrow_map(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), run, "doc_id long, score double")
    return own.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep(docs: DataFrame, labels: DataFrame, text_col: str = "text", threshold: float = 0.3, **options) -> DataFrame:
    """The rows of ``docs`` that ``classify`` predicts 1, with all their columns, in one pass without a join."""
    model = train(docs, labels, text_col=text_col, **options)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(score(features(batch.column(text_col)), model) >= threshold))

    return arrow_map(docs, run, docs.schema)
