"""Sums that are added up below a join instead of above it.

A chain of tables, each naming the row of the next one (items, orders, customers, areas), needs no
join of raw rows for sums per area. On every step the rows of the lower table are added up per
key first, next to the rows of the upper one in the same aggregation, which hands down the key of
the next step. A step is one shuffle of partial sums: hot keys are combined on the map side, and
every table is read once, however many sums are asked for.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F


def partial_sums(rows: DataFrame, key: str, sums: Mapping[str, Column]) -> DataFrame:
    """``key`` and the sums of every row: what ``roll_up`` takes as its lower table, row by row."""
    return rows.select(F.col(f"`{key}`"), *[c.alias(n) for n, c in sums.items()])


def roll_up(lower: DataFrame, upper: DataFrame, key: str, to: str) -> DataFrame:
    """The sums of both tables, one row per ``key``, with ``to`` in its place.

    ``lower`` has ``key`` and columns to add up, in any number of rows per key. ``upper`` has one row per
    ``key`` with ``to`` and perhaps more columns to add up; a key that occurs twice there is an error. As
    with an inner join, rows of ``lower`` without a key or whose key ``upper`` lacks are left out; rows of ``upper``
    all stay, with NULL for sums to which nothing was added. Add up by ``to`` with the next ``roll_up`` or with ``totals``.
    """
    sums = [c for c in [*lower.columns, *upper.columns] if c not in (key, to)]
    if len(set(sums)) < len(sums):
        raise ValueError("a sum has the same name in both tables")
    k, t, own = F.col(f"`{key}`"), F.col(f"`{to}`"), F.col("own rows")
    below = lower.where(k.isNotNull()).withColumn("own rows", F.lit(0))
    above = upper.withColumn("own rows", F.lit(1))
    adding = [F.sum(f"`{c}`").alias(c) for c in sums]
    # Rows of ``upper`` without a key stay apart from each other where they lead to different places.
    groups = above.unionByName(below, allowMissingColumns=True).groupBy(k, F.when(k.isNull(), t).alias("keyless"))
    per_key = groups.agg(F.max(t).alias(to), F.sum(own).alias("own rows"), *adding)
    repeated = F.raise_error(F.concat(F.lit(f"{key} repeats: "), k.cast("string")))
    kept = F.when(k.isNotNull() & (own > 1), repeated.cast("boolean")).otherwise(own > 0)
    return per_key.where(kept).drop("own rows", "keyless", key)


def totals(rows: DataFrame, key: str) -> DataFrame:
    """All other columns added up per ``key``; rows without one are a group of their own."""
    return rows.groupBy(F.col(f"`{key}`")).agg(*[F.sum(f"`{c}`").alias(c) for c in rows.columns if c != key])
