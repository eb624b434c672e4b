"""Strict JSON parsing and typed edits on top of VARIANT.

``try_parse_json`` stops after the first value and ignores what follows, so a
text counts as JSON only if it also parses when wrapped as the single element
of an array and as an object member. Trailing text breaks one of the two.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Reasons recorded for rejected payloads.
REASON_EMPTY = "empty"
REASON_TRAILING = "trailing_text"
REASON_NOT_JSON = "not_json"

_BLANK = r"^[ \t\r\n]*$"


def parse_strict(text: Column) -> Column:
    """The VARIANT value of ``text``, or null unless the whole text is one JSON value."""
    as_array = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    as_member = F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}")))
    single = F.size(F.try_variant_get(as_array, "$", "array<variant>")) == 1
    only_member = F.size(F.try_variant_get(as_member, "$", "map<string,variant>")) == 1
    return F.when(single & only_member, F.try_variant_get(as_array, "$[0]", "variant"))


def reject_reason(text: Column, parsed: Column) -> Column:
    """Why ``parse_strict`` refused a text; null when it gave the value ``parsed``."""
    return (
        F.when(text.isNull() | parsed.isNotNull(), F.lit(None).cast("string"))
        .when(text.rlike(_BLANK), F.lit(REASON_EMPTY))
        .when(F.try_parse_json(text).isNotNull(), F.lit(REASON_TRAILING))
        .otherwise(F.lit(REASON_NOT_JSON))
    )


def type_name(value: Column) -> Column:
    """JSON type: object, array, string, number, boolean, null; SQL null for an absent value."""
    shape = F.schema_of_variant(value)
    return (
        F.when(value.isNull(), F.lit(None).cast("string"))
        .when(shape.startswith("OBJECT"), F.lit("object"))
        .when(shape.startswith("ARRAY"), F.lit("array"))
        .when(shape == "STRING", F.lit("string"))
        .when(shape == "BOOLEAN", F.lit("boolean"))
        .when(shape == "VOID", F.lit("null"))
        .otherwise(F.lit("number"))
    )


def member(doc: Column, key: str) -> Column:
    """The value under ``key`` as VARIANT; SQL null when absent."""
    return F.try_variant_get(doc, f"$.{key}", "variant")


def has_key(doc: Column, key: str) -> Column:
    return F.coalesce(F.array_contains(F.map_keys(as_map(doc)), key), F.lit(False))


def as_map(doc: Column) -> Column:
    return F.try_variant_get(doc, "$", "map<string,variant>")


def text_of(doc: Column, key: str) -> Column:
    """The value under ``key`` as text, objects and arrays as compact JSON."""
    return F.try_variant_get(doc, f"$.{key}", "string")


def numeric_from(value: Column) -> Column:
    """Best-effort JSON number, as VARIANT, from 55, "55 inches", {"size": 55} or [55]; null otherwise.

    Text that is still no number once letters are stripped ("1.2.3", "") gives null.
    """
    kind = type_name(value)
    stripped = F.regexp_replace(F.try_variant_get(value, "$", "string"), "[^0-9.]", "")
    return (
        F.when(kind == "number", value)
        .when(kind == "string", number_of(stripped))
        .when(kind == "object", number_of(F.try_variant_get(value, "$.size", "string")))
        .when(kind == "array", number_of(F.try_variant_get(value, "$[0]", "string")))
    )


_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def number_of(text: Column) -> Column:
    """The number a text spells, as VARIANT with all its digits (a double beyond 38 of them); null if it spells none."""
    plain = F.trim(text)
    # JSON knows no plus sign, no leading zeros, and no point without digits on both sides.
    spelled = F.regexp_replace(plain, r"^\+", "")
    spelled = F.regexp_replace(spelled, r"^(-?)0+(?=[0-9])", "$1")
    spelled = F.regexp_replace(spelled, r"(?<![0-9])\.(?=[0-9])", "0.")
    spelled = F.regexp_replace(spelled, r"\.(?![0-9])", "")
    return F.when(plain.rlike(_NUMBER), F.try_parse_json(spelled))


def set_key(doc: Column, key: str, value: Column) -> Column:
    """``doc`` with ``key`` set to a VARIANT; a null value stores JSON null and keeps the document."""
    kept = F.map_filter(as_map(doc), lambda name, _: name != key)
    stored = F.coalesce(value, F.parse_json(F.lit("null")))
    return F.to_variant_object(F.map_concat(kept, F.create_map(F.lit(key), stored)))


def drop_key(doc: Column, key: str) -> Column:
    return F.to_variant_object(F.map_filter(as_map(doc), lambda name, _: name != key))


def to_variant(value: Column) -> Column:
    """A scalar SQL value as VARIANT; SQL null stays null."""
    return value.cast("variant")
