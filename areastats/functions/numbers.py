"""Arithmetic that never fails on text, blanks or a zero divisor, also under ANSI mode."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, functions as F


def to_double(c: Column) -> Column:
    """Text to double; NULL where the text is blank or not a number."""
    return c.try_cast("double")


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole``; NULL where the divisor is zero or either side is no number."""
    return F.try_divide(to_double(part), to_double(whole))


def total(*columns: Column) -> Column:
    """Sum of columns; NULL as soon as one of them is NULL."""
    return reduce(add, (to_double(c) for c in columns))
