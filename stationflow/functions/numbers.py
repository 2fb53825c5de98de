"""Numeric expressions that never fail on dirty input."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_number(column: str | Column) -> Column:
    """Text as DOUBLE; malformed text is NULL."""
    column = F.col(column) if isinstance(column, str) else column
    return column.try_cast("double")


def pct_change(new: Column, old: Column) -> Column:
    """``(new - old) / old * 100`` as DOUBLE; NULL when ``old`` is 0 or NULL."""
    new, old = new.cast("double"), old.cast("double")
    return F.try_divide(new - old, old) * F.lit(100.0)


def share(part: Column, whole: Column) -> Column:
    """``part / whole * 100`` as DOUBLE."""
    return F.try_divide(part.cast("double"), whole.cast("double")) * F.lit(100.0)
