"""Row filters. SQL three-valued logic holds: a comparison with NULL drops the row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, functions as F

from areastats.config import TERRITORY_NAMES
from areastats.operators.skew import join_unique


def nonblank(*columns: str) -> Column:
    """True where every column is neither empty nor NULL."""
    return reduce(and_, (F.col(c) != "" for c in columns))


def present(*columns: str) -> Column:
    """True where no column is NULL; an empty text counts as present."""
    return reduce(and_, (F.col(c).isNotNull() for c in columns))


def checked(df: DataFrame, reasons: Mapping[str, Column], counts: Observation) -> DataFrame:
    """Rows to which none of the reasons applies; the others are counted by the first reason that does.

    The counts are gathered while the rows are read, so there is no second pass. ``counts.get`` has them when an action on
    the result has ended: ``kept`` and a number for every reason. A reason that is NULL does not apply.
    """
    why = "why"
    while why in df.columns:
        why += "_"
    first = F.coalesce(*[F.when(applies, F.lit(name)) for name, applies in reasons.items()])
    found = [F.count_if(F.col(why) == name).alias(name) for name in reasons]
    labelled = df.withColumn(why, first).observe(counts, F.count_if(F.col(why).isNull()).alias("kept"), *found)
    return labelled.where(F.col(why).isNull()).drop(why)


def not_listed(column: str, values: Sequence[str]) -> Column:
    """Deny-list as one predicate, which the scan can take; NULL is dropped as well."""
    return ~F.col(column).isin(list(values))


def listed(column: str, values: Sequence[str]) -> Column:
    """Allow-list for a short fixed list; for a table of values use ``keep_keys``."""
    return F.col(column).isin(list(values))


def keep_keys(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Allow-list given as a table: a semi join, so the list never passes the driver; it may repeat keys."""
    return join_unique(df, keys.select(F.col(f"`{key}`")), key, "left_semi")


def drop_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows with NULL in one of the columns; empty text is kept."""
    return df.na.drop(subset=list(columns))


def without_territories(df: DataFrame, column: str, names: Sequence[str] = TERRITORY_NAMES) -> DataFrame:
    """Drop the rows of territories, which the per-state tables leave out."""
    return df.where(not_listed(column, names))
