"""Prompt templates with ``{name}`` fields, compiled to one ``concat`` expression."""

from __future__ import annotations

import string
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def fields(template: str) -> list[str]:
    """Field names in order of appearance; anything beyond plain ``{name}`` is refused."""
    names = []
    for _, name, spec, conversion in string.Formatter().parse(template):
        if name is None:
            continue
        if not name.isidentifier() or spec or conversion:
            raise ValueError(f"only plain {{name}} fields are supported, got {{{name}}} in the template")
        names.append(name)
    return names


def render(template: str, columns: Mapping[str, Column]) -> Column:
    """The template with every field replaced by its column; a null shows as ``None``."""
    missing = [name for name in fields(template) if name not in columns]
    if missing:
        raise KeyError(f"template fields without a value: {missing}")
    parts: list[Column] = []
    for literal, name, _, _ in string.Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if name is not None:
            parts.append(F.coalesce(columns[name].cast("string"), F.lit("None")))
    return F.concat(*parts) if parts else F.lit("")


def render_row(template: str, df_columns: list[str]) -> Column:
    """Render from the columns of a table."""
    return render(template, {name: F.col(f"`{name}`") for name in df_columns})
