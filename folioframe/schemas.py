"""Schemas of the corpus tables and of extraction results."""

from __future__ import annotations

from pyspark.sql import types as T

_KINDS = {"s": T.StringType(), "l": T.LongType(), "i": T.IntegerType(), "t": T.TimestampNTZType()}


def _struct(text: str) -> T.StructType:
    """"name kind, ..." with kinds s, l, i, t and ! for not null; the kind is s where none is given."""
    fields = []
    for part in text.split(","):
        name, *kind = part.split()
        k = kind[0] if kind else "s"
        fields.append(T.StructField(name, _KINDS[k[0]], not k.endswith("!")))
    return T.StructType(fields)


TABLES: dict[str, T.StructType] = {
    "documents": _struct("id l!, file_name s!, display_title, summary, summary_date t, file_path, page_count i, file_size l, full_text, collection, subcollection, location, extracted_dates, extraction_model, pipeline_version, processed_date t"),
    "entities": _struct("id l!, name s!, type s!, context, acres, land_type, created_date t"),
    "mentions": _struct("id l!, entity_id l, document_id l, context"),
    "events": _struct("id l!, document_id l, type, date, location, description, metadata"),
    "financial_transactions": _struct("id l!, document_id l, amount, type, payer, payee, for_what, date, context, created_date t"),
    "relationships": _struct("id l!, document_id l, type, subject, object, context, created_date t"),
    "fee_patents": _struct("id l!, document_id l, allottee s!, allotment_number, acreage, land_description, patent_date, patent_number, trust_to_fee_mechanism, subsequent_buyer, sale_price, sale_date, attorney, mortgage_amount, mortgage_holder, context, created_date t"),
    "correspondence": _struct("id l!, document_id l, sender s!, sender_title, recipient s!, recipient_title, date, subject, action_requested, outcome, context, created_date t"),
    "legislative_actions": _struct("id l!, document_id l, bill_number s!, bill_title, sponsor, co_sponsors, action_type s!, action_date, vote_count, committee, outcome, context, created_date t"),
    "testimony": _struct("id l!, document_id l, witness s!, witness_title, hearing, committee, location, date, subject, key_claims, questioner, context, created_date t"),
    "taxes": _struct("id l!, document_id l, taxpayer, land_description, tax_type, amount, year, status, county, context, created_date t"),
    "mortgages": _struct("id l!, document_id l, borrower, lender, amount, land_description, acreage, date, interest_rate, status, context, created_date t"),
}
#: Tables that hang on a document and go with it.
CHILDREN = [t for t in TABLES if t not in ("documents", "entities")]
#: Tables that a corpus of each version has.
VERSIONS = {
    "v2": ["documents", "entities", "mentions", "events", "financial_transactions", "relationships"],
    "v3": [*list(TABLES)[:9]],
    "v4": list(TABLES),
}
#: Tables whose rows a re-extraction clears; later groups are left as they are.
CLEARED = ["mentions", "events", "financial_transactions", "relationships", "fee_patents", "correspondence", "legislative_actions"]

_GROUPS = {
    "entities": "name type context acres land_type",
    "events": "type date location description name",
    "financial_transactions": "type amount payer payee date description for_what context",
    "relationships": "subject type object context",
    "fee_patents": "allottee_name allottee allotment_number acreage land_description patent_date patent_number mechanism trust_to_fee_mechanism buyer subsequent_buyer sale_price sale_date attorney mortgage mortgage_amount mortgage_holder context",
    "correspondence": "sender sender_title recipient recipient_title date subject action_requested outcome context",
    "legislative_actions": "bill_number bill_title sponsor co_sponsors action_type date action_date vote_count committee outcome context",
    "testimony": "witness witness_title hearing committee location date subject key_claims questioner context",
    "taxes": "taxpayer land_description tax_type amount year status county context",
    "mortgages": "borrower lender amount land_description acreage date interest_rate status context",
}
GROUPS = list(_GROUPS)


def group_struct(group: str) -> T.StructType:
    """One item of an extraction group: all strings, both key dialects; events also list entities."""
    fields = [T.StructField(k, T.StringType()) for k in _GROUPS[group].split()]
    if group == "events":
        fields.append(T.StructField("entities_involved", T.ArrayType(T.StringType())))
    return T.StructType(fields)


def extraction_struct(groups: list[str] | None = None) -> T.StructType:
    return T.StructType([T.StructField(g, T.ArrayType(group_struct(g))) for g in groups or GROUPS])


def json_schema(groups: list[str] | None = None) -> dict:
    """The JSON Schema of an extraction, for models that take one: every group a required array, every field of an item a required string."""

    def of(kind: T.DataType) -> dict:
        if isinstance(kind, T.ArrayType):
            return {"type": "array", "items": of(kind.elementType)}
        if isinstance(kind, T.StructType):
            return {"type": "object", "properties": {f.name: of(f.dataType) for f in kind.fields}, "required": kind.fieldNames(), "additionalProperties": False}
        return {"type": "string"}

    return of(extraction_struct(groups))
