"""Small helpers for columns built of Spark functions alone."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Regular-expression class of what ends a word.
SPACE = r"[\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also where ``body`` uses it inside a lambda."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """Array of the words of a text; empty for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")
