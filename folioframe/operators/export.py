"""Training pairs from the tables, sampling, batching, statistics and model-output scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.json_text import item_counts, parsed
from ..functions.text import evidence
from .members import among, words
from .ordering import free_name, numbered, ranged

#: How table columns are named in an exported extraction.
EXPORTED: dict[str, dict[str, str]] = {
    "events": {"type": "type", "date": "date", "location": "location", "description": "description"},
    "financial_transactions": {"type": "type", "amount": "amount", "payer": "payer", "payee": "payee", "date": "date", "description": "coalesce(for_what, context, '')"},
    "relationships": {"subject": "subject", "type": "type", "object": "object", "context": "context"},
    "fee_patents": {"allottee_name": "allottee", "allotment_number": "allotment_number", "acreage": "acreage", "patent_date": "patent_date", "patent_number": "patent_number", "mechanism": "trust_to_fee_mechanism", "buyer": "subsequent_buyer", "sale_price": "sale_price", "attorney": "attorney", "mortgage": "mortgage_amount"},
    "correspondence": {k: k for k in ("sender", "sender_title", "recipient", "recipient_title", "date", "subject", "action_requested", "outcome")},
    "legislative_actions": {"bill_number": "bill_number", "sponsor": "sponsor", "action_type": "action_type", "date": "action_date", "vote_count": "vote_count", "committee": "committee", "outcome": "outcome"},
}


def gathered(documents: DataFrame, entities: DataFrame, mentions: DataFrame, facts: dict[str, DataFrame]) -> DataFrame:
    """Documents with one array a group, as an extraction has them, in the order of ids; a group without rows is empty.

    Mentions and facts are cut to the documents asked for before they meet anything else.
    """
    asked = documents.select("id")
    held = words(asked)
    mentions, facts = among(mentions, "document_id", asked, held), {g: among(t, "document_id", asked, held) for g, t in facts.items()}
    linked = mentions.select("entity_id", "document_id").join(entities.select(F.col("id").alias("entity_id"), "name", "type", "context"), "entity_id")
    children = {"entities": linked.select(F.col("document_id").alias("id"), F.struct(F.col("entity_id").alias("k"), "name", "type", F.coalesce("context", F.lit("")).alias("context")).alias("x"))}
    for g, columns in EXPORTED.items():
        if g in facts:
            children[g] = facts[g].select(F.col("document_id").alias("id"), F.struct(F.col("id").alias("k"), *[F.coalesce(F.expr(e), F.lit("")).alias(k) for k, e in columns.items()]).alias("x"))
    out = documents
    only = lambda fields: lambda i: F.struct(*[i[f].alias(f) for f in fields])
    for g, child in children.items():
        fields = [f.name for f in child.schema["x"].dataType.fields if f.name != "k"]
        per = child.groupBy("id").agg(F.sort_array(F.collect_list("x")).alias("x")).select("id", F.transform("x", only(fields)).alias(g))
        kind = per.schema[g].dataType.simpleString()
        out = out.join(per, "id", "left").withColumn(g, F.coalesce(g, F.array().cast(kind)))
    return out.withColumn("n_items", sum((F.size(g) for g in children), F.lit(0)))


def training_pairs(gathered_docs: DataFrame, prompt: Column, min_items: int = 5, min_text: int = 5_000, max_text: int = 40_000, most_output: int | None = None, top: int | None = None) -> DataFrame:
    """(id, n_items, prompt, completion): a document's prompt and its extraction as JSON; too little text or too few items drop out."""
    groups = [g for g in ("entities", *EXPORTED) if g in gathered_docs.columns]
    own = gathered_docs.where((F.length("full_text") > min_text) & (F.col("n_items") >= min_items)).withColumn("full_text", F.left("full_text", F.lit(max_text)))
    pairs = own.select("id", "n_items", prompt.alias("prompt"), F.to_json(F.struct(*groups), {"ignoreNullFields": "false"}).alias("completion"))
    if most_output:
        pairs = pairs.where(F.length("completion") <= most_output)
    pairs = pairs.orderBy(F.desc("n_items"), "id")
    return pairs.limit(top) if top else pairs


def chat_lines(pairs: DataFrame) -> DataFrame:
    """(value): one JSON chat a pair, to be written as text lines."""
    say = lambda role, c: F.struct(F.lit(role).alias("role"), F.col(c).alias("content"))
    return pairs.select(F.to_json(F.struct(F.array(say("user", "prompt"), say("assistant", "completion")).alias("messages"))).alias("value"))


def split(rows: DataFrame, share: float = 0.1, seed: int = 42, key: str = "id") -> DataFrame:
    """Rows with ``part``: train for the first int(n * (1 - share)) in a seeded hash order, else validation.

    The order's numbers come from range partitions, so no task holds or merges all keys; rows aren't joined.
    """
    place = free_name(rows.columns, "place")
    cut = int(rows.count() * (1 - share))
    placed = numbered(rows, [F.xxhash64(key, F.lit(seed)).asc(), F.asc_nulls_first(key)], place)
    return placed.withColumn("part", F.when(F.col(place) <= cut, F.lit("train")).otherwise(F.lit("validation"))).drop(place)


def sample(rows: DataFrame, n: int, seed: int | None = None) -> DataFrame:
    """n rows at random, a top-k by a random key."""
    return rows.orderBy(F.rand(seed)).limit(n)


def upper_median(rows: DataFrame, column: str) -> DataFrame:
    """(n, least, most, mean, median): the median is the element at n div 2 of the sorted values, from 0.

    Values are counted; sums over range partitions of the values tell the partition of the element, and running sums in
    that one partition find it, so no array of all values is built and no task sees all values.
    """
    counts = rows.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("v")).agg(F.count("*").alias("c"))
    n, least, most, mean = counts.agg(F.sum("c"), F.min("v"), F.max("v"), F.sum(F.col("v") * F.col("c")) / F.sum("c")).first()
    placed, part = ranged(counts, [F.asc("v")])
    at, base, here = (n or 0) // 2, 0, None
    for p, size in sorted(placed.groupBy(part).agg(F.sum("c")).collect()):
        if base + size > at:
            here = p
            break
        base += size
    running = placed.where(F.col(part) == here).withColumn("up", base + F.sum("c").over(Window.partitionBy(part).orderBy("v")))
    middle = running.where(F.col("up") > at).agg(F.min("v").alias("median"))
    return middle.select(F.lit(n).cast("long").alias("n"), F.lit(least).alias("least"), F.lit(most).alias("most"), F.lit(mean).alias("mean"), "median")


def batches(rows: DataFrame, size: int = 25, key: str = "id") -> DataFrame:
    """(batch, ids…): rows in order of their key, ``size`` a batch."""
    place = free_name(rows.columns, "place")
    return numbered(rows, [F.asc_nulls_first(key)], place).withColumn("batch", F.floor((F.col(place) - 1) / size).cast("long")).drop(place)


def extraction_scores(replies: DataFrame, groups: list[str], reply_col: str = "reply") -> DataFrame:
    """The rows with valid_json, a count a group and their sum: what a model's reply holds."""
    read = parsed(replies, reply_col, "split", groups)
    return read.select(*replies.columns, "valid_json", *[c.alias(n) for n, c in item_counts(F.col("result"), groups).items()])


def answer_scores(answers: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows with word count, cited documents, evidence counts and section flags of a written answer."""
    return answers.select(*[c for c in answers.columns if c != text_col], *[c.alias(n) for n, c in evidence(F.col(text_col)).items()])


def summary_requests(documents: DataFrame, prompt: str, max_tokens: int = 180_000, reserve: int = 1_000, force: bool = False, limit: int | None = None) -> DataFrame:
    """(custom_id, id, prompt): a request for each document with at least 100 characters of text and no summary yet."""
    from ..functions.text import strip, truncated

    need = documents if force else documents.where("summary is null")
    need = need.where(F.length(strip(F.coalesce("full_text", F.lit("")))) >= 100).orderBy("id")
    need = need.limit(limit) if limit else need
    text = truncated(F.col("full_text"), max_tokens - reserve, "\n\n[... text truncated ...]")
    return need.select(F.concat(F.lit("doc-"), F.col("id")).alias("custom_id"), "id", F.concat(F.lit(prompt), F.lit("\n\n"), text).alias("prompt"))


def apply_summaries(documents: DataFrame, results: DataFrame) -> DataFrame:
    """Documents with the summaries of results (custom_id, state, summary, at) that succeeded; the rest stays."""
    from .load import set_by_id

    good = results.where("state = 'succeeded' and coalesce(summary, '') <> ''")
    values = good.select(F.regexp_extract("custom_id", r"^doc-(\d+)$", 1).try_cast("bigint").alias("id"), "summary", F.col("at").alias("summary_date"))
    return set_by_id(documents, values, ["summary", "summary_date"])


def summary_statistics(documents: DataFrame) -> DataFrame:
    from ..functions.text import word_count

    words = documents.where("summary is not null").agg(F.count("*").alias("n"), F.coalesce(F.sum(word_count(F.col("summary"))), F.lit(0)).alias("words"))
    return words.withColumn("mean_words", F.when(F.col("n") > 0, F.floor(F.col("words") / F.col("n"))).otherwise(0))
