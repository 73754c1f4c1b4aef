"""Small string expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# All Unicode white space. Java's class lacks the four separators U+001C to U+001F.
SPACE = r"[\s\x1c-\x1f]"


def strip(text: Column) -> Column:
    """Remove Unicode white space from both ends (``trim`` removes spaces only)."""
    return F.regexp_replace(F.regexp_replace(text, rf"(?U)\A{SPACE}++", ""), rf"(?U)(?<!{SPACE}){SPACE}++\z", "")


def is_blank(text: Column) -> Column:
    return ~text.rlike(rf"(?U)[^\s\x1c-\x1f]")


def valid_utf8(raw: Column) -> Column:
    """Text of a binary column, with undecodable bytes replaced."""
    return F.make_valid_utf8(raw.cast("string"))
