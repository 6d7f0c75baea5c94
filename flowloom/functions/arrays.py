"""Array expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from flowloom.functions.text import _col


def first_or_blank(c: str | Column) -> Column:
    """First element; the empty string for an empty or NULL array."""
    c = _col(c)
    return F.when(F.size(c) > 0, F.get(c, F.lit(0)).cast("string")).otherwise(F.lit(""))


def add_series(a: str | Column, b: str | Column) -> Column:
    """Element-wise sum of two series; an absent series counts as nothing."""
    a, b = _col(a), _col(b)
    both = F.zip_with(a, b, lambda x, y: F.coalesce(x, F.lit(0)) + F.coalesce(y, F.lit(0)))
    return F.coalesce(both, a, b)


def active_bins(series: str | Column) -> Column:
    """Number of non-zero bins."""
    return F.size(F.filter(_col(series), lambda x: x > 0))
