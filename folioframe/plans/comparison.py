"""Comparing models: every prompt to every model, scores of the replies, and a report as Markdown."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import tokens_by_four
from ..operators.export import answer_scores, extraction_scores
from ..shared import written
from .ledger import Extractor, asked


def run_matrix(prompts: DataFrame, models: list[str], choose: Callable[[str], Callable[[], Extractor]], **how) -> DataFrame:
    """The prompts' rows for each model, with ``model``, ``state``, ``reply``, ``error`` and ``attempts``. Each model has its
    own client a task; the replies are written, so that all scores of them read the same ones."""
    parts = [written(asked(prompts.withColumn("model", F.lit(m)), choose(m), **how), "compared") for m in models]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def extraction_summary(replies: DataFrame, groups: list[str]) -> DataFrame:
    """(model, n_documents, n_valid, n_items and a sum a group), most items first."""
    scored = extraction_scores(replies, groups)
    sums = [F.sum(c).cast("long").alias(c) for c in (*(f"n_{g}" for g in groups), "n_items")]
    return scored.groupBy("model").agg(F.count("*").alias("n_documents"), F.sum(F.col("valid_json").cast("int")).cast("long").alias("n_valid"), *sums).orderBy(F.desc("n_items"), "model")


def answer_summary(replies: DataFrame) -> DataFrame:
    """(model, question, the scores of the answer, est_tokens of its prompt)."""
    sized = replies.withColumn("est_tokens", tokens_by_four(F.col("prompt")))
    return answer_scores(sized.select("model", "question", "est_tokens", F.col("reply").alias("text"))).orderBy("question", "model")


def markdown_lines(rows: DataFrame, order: list[str]) -> DataFrame:
    """(n, value): a Markdown table, its head first. Bars in values are escaped, nulls are empty."""
    cells = lambda values: F.concat(F.lit("| "), F.concat_ws(" | ", *values), F.lit(" |"))
    head = ["| " + " | ".join(rows.columns) + " |", "|" + "---|" * len(rows.columns)]
    body = rows.select(F.struct(*order).alias("k"), cells([F.coalesce(F.replace(F.col(c).cast("string"), F.lit("|"), F.lit("\\|")), F.lit("")) for c in rows.columns]).alias("value"))
    lines = body.agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "value"))), lambda x: x["value"]).alias("x"))  # a report's rows: one a model and question
    whole = lines.select(F.posexplode(F.concat(F.array(*map(F.lit, head)), F.col("x"))).alias("n", "value"))
    return whole


def report(title: str, notes: list[str], table: DataFrame, order: list[str]) -> str:
    """A report's text: a title, notes, a table."""
    body = "\n".join(r.value for r in markdown_lines(table, order).orderBy("n").collect())
    return "\n".join([f"# {title}", "", *[f"- {n}" for n in notes], "", body, ""])
