"""Use a computed value several times in one expression without computing it several times."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` bound to a lambda variable, so it is computed once per row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def only_if(value: Column, test: Callable[[Column], Column]) -> Column:
    """``value`` if it passes the test, else null."""
    return F.get(F.filter(F.array(value), test), F.lit(0))
