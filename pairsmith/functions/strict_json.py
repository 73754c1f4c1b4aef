"""Strict JSON as VARIANT expressions.

``try_parse_json`` ignores what follows a complete value. Text is accepted here only if nothing
but white space surrounds the value.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pairsmith.functions.binding import let


def parse_strict(text: Column) -> Column:
    """VARIANT of a text that is exactly one JSON value, else null.

    The text must fit both as the only item of an array and as the only value of an object;
    trailing text, a second value or an unbalanced bracket breaks one of the two. JSON ``null``
    gives a VARIANT null, which is not SQL null.
    """
    alone = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    keyed = F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}")))
    return F.when(alone.isNotNull(), F.try_variant_get(keyed, "$.v", "variant"))


def parse_closed(text: Column) -> Column:
    """VARIANT of a text whose only closing bracket is its last character.

    No text can follow the value then, so one parse is enough.
    """
    return F.try_parse_json(text)


def string_field(value: Column, key: str) -> Column:
    """``value[key]`` if it is a JSON string, else null (missing key, other type, not an object)."""
    field = F.try_variant_get(value, f"$['{key}']", "variant")
    return let(field, lambda v: F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string")))


def is_object(value: Column) -> Column:
    return F.schema_of_variant(value).startswith("OBJECT")
