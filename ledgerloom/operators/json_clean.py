"""Cleansing of JSON held as text and of typed JSON attributes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import json_values as J
from ledgerloom.operators.dimensions import latest_per_key

# Product types that have no physical weight.
WEIGHTLESS_TYPES = ("financial", "digital", "logistics")

# JSON type each field must have, per category.
NUMERIC_FIELDS = {"television": "screen_size", "refrigerator": "capacity_liters"}
CATEGORY_CONTRACTS = {
    "television": {
        "required": {"screen_size": "number", "resolution": "string", "smart_tv": "boolean"},
        "optional": {},
    },
    "refrigerator": {
        "required": {"capacity_liters": "number", "energy_rating": "string"},
        "optional": {"frost_free": "boolean"},
    },
}

_LOOKS_STRUCTURED = r"^ *[\{\[]"
SAMPLE_LENGTH = 50


def null_inapplicable(rows: DataFrame, column: str, kind: str, without: tuple[str, ...] = WEIGHTLESS_TYPES) -> DataFrame:
    """Clear a measure on the row types it cannot apply to."""
    return rows.withColumn(column, F.when(F.col(kind).isin(*without), F.lit(None)).otherwise(F.col(column)))


def text_to_json(rows: DataFrame, text: str, target: str) -> DataFrame:
    """Fill ``target`` with JSON: parsed when it is, wrapped as raw text when it is not.

    Text opening with a brace or bracket that fails to parse keeps the raw text
    and the reason of failure. Rows whose target is already set are left alone.
    """
    source, parsed = F.col(text), F.col("_parsed")
    wrapped = F.to_json(F.struct(source.alias("raw_text")))
    failed = F.to_json(F.struct(J.reject_reason(source, parsed).alias("parse_error"), source.alias("raw_text")))
    converted = (
        F.when(source.isNull(), F.lit(None))
        .when(~source.rlike(_LOOKS_STRUCTURED), wrapped)
        .when(parsed.isNotNull(), F.to_json(parsed))
        .otherwise(failed)
    )
    if target in rows.columns:
        converted = F.coalesce(target, converted)
    structured = F.when(source.rlike(_LOOKS_STRUCTURED), source)
    return with_document(rows, structured, "_parsed").withColumn(target, converted).drop("_parsed")


def split_profiles(rows: DataFrame, text: str, target: str) -> DataFrame:
    """All rows, with ``target`` holding valid JSON and the text of malformed rows cleared."""
    staged = with_document(rows, F.col(text), "_parsed").withColumn(target, F.to_json("_parsed"))
    return staged.withColumn(text, F.when(F.col("_parsed").isNotNull(), F.col(text))).drop("_parsed")


def dead_letters(rows: DataFrame, key: str, text: str, order: list[str]) -> DataFrame:
    """Malformed payloads with the reason of failure; the last write per key wins."""
    payload = F.col(text)
    bad = rows.filter(payload.isNotNull() & J.parse_strict(payload).isNull())
    latest = latest_per_key(bad.select(*dict.fromkeys([key, text, *order])), key, order)
    # The reason is worked out for the rows that are kept, not for every rejected write.
    reason = J.reject_reason(payload, F.lit(None))
    return latest.select(key, payload.alias("malformed_payload"), reason.alias("failure_reason"))


def with_document(rows: DataFrame, text: Column, name: str = "doc") -> DataFrame:
    """Parse a JSON text once, as a column of its own that later steps read."""
    return rows.withColumn(name, J.parse_strict(text))


def in_category(doc: Column, category: str) -> Column:
    return J.text_of(doc, "category") == category


def attribute_profile(rows: DataFrame, doc: str, key: str, category: str = "television") -> DataFrame:
    """How often each JSON type and value sample occurs under ``key``, most frequent first."""
    document = F.col(doc)
    sample = F.left(J.text_of(document, key), F.lit(SAMPLE_LENGTH))
    return (
        rows.filter(in_category(document, category) & J.has_key(document, key))
        .groupBy(J.type_name(J.member(document, key)).alias("json_type"), sample.alias("sample_value"))
        .agg(F.count("*").alias("occurrences"))
        .orderBy(F.desc("occurrences"), "json_type", "sample_value")
    )


def normalize_numeric(rows: DataFrame, doc: str, key: str, category: str = "television") -> DataFrame:
    """Turn every spelling of a numeric attribute into a JSON number.

    A value no number can be read from becomes JSON null; the rest of the
    document is kept.
    """
    document = F.col(doc)
    value = J.member(document, key)
    applies = in_category(document, category) & J.has_key(document, key) & (J.type_name(value) != "number")
    fixed = J.set_key(document, key, J.numeric_from(value))
    return rows.withColumn(doc, F.when(applies, fixed).otherwise(document))


def merge_alias(rows: DataFrame, doc: str, alias: str, key: str, category: str = "television") -> DataFrame:
    """Move the value of a misnamed attribute to its proper name where that is missing."""
    document = F.col(doc)
    applies = in_category(document, category) & J.has_key(document, alias) & ~J.has_key(document, key)
    moved = J.drop_key(J.set_key(document, key, J.member(document, alias)), alias)
    return rows.withColumn(doc, F.when(applies, moved).otherwise(document))


def contract_holds(doc: Column, numeric_fields: Mapping[str, str] = NUMERIC_FIELDS) -> Column:
    """True unless a category's numeric field is present with another JSON type.

    Unknown categories, absent fields and absent documents satisfy the rule.
    """
    broken = F.lit(False)
    for category, field in numeric_fields.items():
        wrong = J.has_key(doc, field) & (J.type_name(J.member(doc, field)) != "number")
        broken = broken | F.coalesce(in_category(doc, category) & wrong, F.lit(False))
    return ~broken


def contract_check(rows: DataFrame, key: str, doc: str) -> DataFrame:
    return rows.select(key, contract_holds(F.col(doc)).alias("is_valid"))


def contract_table(spark: SparkSession, contracts: Mapping[str, Mapping] = CATEGORY_CONTRACTS) -> DataFrame:
    """Contracts as stored: one row per category with its field-to-type maps."""
    rows = [(category, spec["required"], spec["optional"]) for category, spec in contracts.items()]
    return spark.createDataFrame(
        rows, "category string, required_fields map<string,string>, optional_fields map<string,string>"
    )


def schema_violations(rows: DataFrame, key: str, doc: str, contracts: DataFrame) -> DataFrame:
    """Fields that are missing or mistyped under the contract of the row's category."""
    def entries(fields: str, required: bool) -> Column:
        return F.transform(
            F.map_entries(fields),
            lambda e: F.struct(e["key"].alias("field"), e["value"].alias("expected"), F.lit(required).alias("required")),
        )

    # One row per category, fields as an array: the contract side never multiplies rows in the join.
    per_category = contracts.select(
        "category", F.concat(entries("required_fields", True), entries("optional_fields", False)).alias("_fields")
    )
    document = F.col(doc)
    checked = (
        rows.withColumn("category", J.text_of(document, "category"))
        .join(per_category, "category")
        .select(key, "category", doc, F.explode("_fields").alias("_f"))
        .select(key, "category", F.col("_f.field").alias("field"), F.col("_f.expected").alias("expected"),
                F.col("_f.required").alias("_required"),
                J.type_name(F.try_element_at(J.as_map(document), F.col("_f.field"))).alias("found"))
    )
    problem = F.when(F.col("found").isNull() & F.col("_required"), F.lit("missing")).when(
        F.col("found") != F.col("expected"), F.lit("wrong_type")
    )
    return checked.select(key, "category", "field", "expected", "found", problem.alias("problem")).filter("problem is not null")
