"""Defensive conversions: what cannot be read without loss becomes null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_WHOLE = r"^\s*[+-]?\d+\s*$"
_NUMBER = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"


def int_from_text(text: Column) -> Column:
    """Whole-number text to long; ``8.0`` and words are null."""
    return F.when(text.rlike(_WHOLE), F.trim(text).try_cast("long"))


def int_from_double(number: Column) -> Column:
    """Doubles without a fraction to long, others null."""
    return F.when(~F.isnan(number) & (number == F.floor(number)), number.try_cast("long"))


def float_from_text(text: Column) -> Column:
    return F.when(text.rlike(_NUMBER), F.trim(text).try_cast("double"))


def nan_to_null(number: Column) -> Column:
    return F.when(~F.isnan(number), number)


def int_from_json(body: Column, path: str) -> Column:
    """A JSON value as a lossless integer: whole numbers, numbers without a fraction, whole-number text."""
    value = F.try_variant_get(F.try_parse_json(body), path, "variant")
    kind = F.schema_of_variant(value)
    as_text = value.try_cast("string")
    return (
        F.when(kind.isin("BIGINT", "INT", "SMALLINT", "TINYINT"), as_text.try_cast("long"))
        .when(kind.startswith("DECIMAL") | kind.isin("DOUBLE", "FLOAT"), int_from_double(as_text.try_cast("double")))
        .when(kind == "STRING", int_from_text(as_text))
    )


def bool_from_text(text: Column) -> Column:
    return F.when(F.lower(F.trim(text)) == "true", True).when(F.lower(F.trim(text)) == "false", False)
