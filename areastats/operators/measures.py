"""Counts, means and shares per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from areastats.config import KEY, PRIVATE_SHARE, PUBLIC_SHARE
from areastats.functions.numbers import ratio, total


def count_by_key(df: DataFrame, name: str, key: str = KEY) -> DataFrame:
    """Rows per key; rows without a key form a group of their own."""
    return df.groupBy(key).agg(F.count("*").alias(name))


def mean_by_key(df: DataFrame, value: Column, name: str, key: str = KEY) -> DataFrame:
    """Unweighted mean per key; NULL values do not count."""
    return df.groupBy(key).agg(F.avg(value).alias(name))


def mean_of_parts(df: DataFrame, total: Column, count: Column, name: str, key: str = KEY) -> DataFrame:
    """Unweighted mean per key of values of which rows hold sums and counts."""
    return df.groupBy(key).agg(F.try_divide(F.sum(total).cast("double"), F.sum(count).cast("double")).alias(name))


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    """Distinct combinations of the columns."""
    return df.select(*columns).distinct()


def key_count(df: DataFrame, key: str = KEY) -> DataFrame:
    """One row: rows, rows with a key, and distinct keys."""
    return df.agg(F.count("*").alias("rows"), F.count(key).alias("keyed"), F.countDistinct(key).alias("keys"))


def shares(df: DataFrame, parts: Sequence[str], names: Sequence[str], key: str = KEY) -> DataFrame:
    """Replace part columns by their shares (0 to 1) of the sum of all parts."""
    whole = total(*[F.col(p) for p in parts])
    return df.select(key, *[ratio(F.col(p), whole).alias(n) for p, n in zip(parts, names, strict=True)])


def school_shares(counts: DataFrame, key: str = KEY) -> DataFrame:
    """Shares of private and public schools from a table with both counts."""
    return shares(counts, ["Private", "Public"], [PRIVATE_SHARE, PUBLIC_SHARE], key)
