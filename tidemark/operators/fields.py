"""What is wrong with the fields of records, told apart: absent, NULL, of the wrong type, unknown.

A typed parse gives NULL in all of these cases and passes over unknown fields. Here a payload is parsed
once into a VARIANT, which keeps what was sent, and every field is looked at in it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.schemas import EVENT_FIELDS

# Kinds of errors.
NOT_AN_OBJECT = "not_an_object"
NULL_VALUE = "null"
WRONG_TYPE = "wrong_type"
UNKNOWN_FIELD = "unknown_field"
ABSENT = "absent"

_NUMBER = "(BIGINT|DECIMAL.*|DOUBLE|FLOAT)"
_KINDS = {"string": "STRING", "int": "BIGINT", "bigint": "BIGINT", "double": _NUMBER}
_RANGE = {"int": (-(2**31), 2**31 - 1)}


def parsed(raw: DataFrame) -> DataFrame:
    """``raw_json`` and, as ``fields``, its members as a map of VARIANTs; NULL if it is no object.

    The map goes through ``inline`` so that it is built once, however many fields are looked at.
    """
    text = raw.select(F.col("value").cast("string").alias("raw_json"))
    members = F.try_variant_get(F.try_parse_json("raw_json"), "$", "map<string,variant>")
    return text.select("raw_json", F.inline(F.array(F.struct(members.alias("fields")))))


def _kind(value: Column) -> Column:
    return F.schema_of_variant(value)


def is_of_type(value: Column, dtype: str) -> Column:
    """Whether a VARIANT was sent as the JSON type that a field of ``dtype`` has."""
    fits = _kind(value).rlike(f"^{_KINDS[dtype]}$")
    if dtype in _RANGE:
        fits = fits & F.try_variant_get(value, "$", "bigint").between(*_RANGE[dtype])
    return F.coalesce(fits, F.lit(False))


def field_errors(
    raw: DataFrame,
    fields: Mapping[str, str] = EVENT_FIELDS,
    required: tuple[str, ...] = ("event_type", "event_id", "ts"),
) -> DataFrame:
    """One row per error: ``raw_json``, ``field``, ``error``.

    A payload that is no JSON object, or one that names a field twice, is one error without a field; a
    tombstone (NULL) is none. A field may be absent unless it is ``required``.
    """
    members = F.col("fields")

    def judged(name: str, dtype: str) -> Column:
        value = F.element_at(members, name)
        missing = F.lit(ABSENT if name in required else None)
        error = (
            F.when(~F.map_contains_key(members, name), missing)
            .when(F.is_variant_null(value), NULL_VALUE)
            .when(~is_of_type(value, dtype), WRONG_TYPE)
        )
        return F.struct(F.lit(name).alias("field"), error.alias("error"))

    known = F.array(*[judged(name, dtype) for name, dtype in fields.items()])
    others = F.array_except(F.map_keys(members), F.array(*map(F.lit, fields)))
    unknown = F.transform(
        others, lambda name: F.struct(name.alias("field"), F.lit(UNKNOWN_FIELD).alias("error"))
    )
    no_object = F.array(
        F.struct(F.lit(None).cast("string").alias("field"), F.lit(NOT_AN_OBJECT).alias("error"))
    )
    found = F.when(members.isNull(), no_object).otherwise(F.concat(known, unknown))
    rows = parsed(raw.filter(F.col("value").isNotNull())).select("raw_json", F.inline(found))
    return rows.filter(F.col("error").isNotNull())


def field_error_counts(
    raw: DataFrame,
    fields: Mapping[str, str] = EVENT_FIELDS,
    required: tuple[str, ...] = ("event_type", "event_id", "ts"),
) -> DataFrame:
    """Errors per field and kind."""
    errors = field_errors(raw, fields, required)
    return errors.groupBy("field", "error").agg(F.count("*").alias("records"))
