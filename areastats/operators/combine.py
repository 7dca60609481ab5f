"""Putting tables together: merge by key, fill missing keys, column pages, unions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame, functions as F

from areastats.config import KEY
from areastats.operators.skew import join_unique
from areastats.session import stage


def join_all(frames: Sequence[DataFrame], key: str = KEY, how: str = "inner") -> DataFrame:
    """Join keyed tables left to right; the key comes out once, first.

    Tables made by a ``groupBy`` on the key are already partitioned by it, so the joins add no
    shuffle. A measure name that occurs twice is an error, not a duplicate column.
    """
    if not frames:
        raise ValueError("nothing to join")
    names = [c.lower() for df in frames for c in df.columns if c != key]
    clash = sorted({c for c in names if names.count(c) > 1})
    if clash:
        raise ValueError(f"columns in more than one table: {clash}")
    return reduce(lambda a, b: a.join(b, key, how), frames)


def fill_missing(
    base: DataFrame, fillers: Sequence[DataFrame], key: str = KEY, *, sequential: bool = False
) -> DataFrame:
    """Append to ``base`` the filler rows of keys that ``base`` does not have.

    Every filler is compared with the original base, so two fillers may both add a key; with
    ``sequential`` each is compared with what has been filled so far. All base rows stay, also
    those without a key; filler rows without a key are left out.

    In turn, a key belongs to the first source that has it: one aggregation over the keys of all
    sources finds that out, combined on the map side, and one join applies it. Else each filler is
    read once, and its rows are not shuffled while there are few enough base keys to broadcast.
    """
    columns = [F.col(f"`{c}`") for c in base.columns]
    k = F.col(f"`{key}`")
    rows = [f.select(*columns).where(k.isNotNull()) for f in fillers]
    if not rows:
        return base
    if sequential:
        return base.unionByName(_in_turn(base, rows, key))
    keys = stage(base.select(k).where(k.isNotNull()).distinct(), "keys")
    return reduce(DataFrame.unionByName, [join_unique(r, keys, key, "left_anti") for r in rows], base)


def _in_turn(base: DataFrame, fillers: Sequence[DataFrame], key: str) -> DataFrame:
    """The filler rows whose source is the first with their key. Nothing runs before the result is asked for."""
    source = "source"
    while source in base.columns:
        source += "_"
    numbered = reduce(DataFrame.unionByName, [f.withColumn(source, F.lit(i)) for i, f in enumerate(fillers, start=1)])
    keys = base.select(F.col(f"`{key}`"), F.lit(0).alias(source)).unionByName(numbered.select(F.col(f"`{key}`"), source))
    first = keys.where(F.col(f"`{key}`").isNotNull()).groupBy(F.col(f"`{key}`")).agg(F.min(source).alias(source))
    return numbered.join(first.where(F.col(source) > 0), [key, source], "left_semi").select(*[F.col(f"`{c}`") for c in base.columns])


def natural_join(left: DataFrame, right: DataFrame) -> DataFrame:
    """Inner join on all shared columns, where NULL equals NULL; shared columns come out once."""
    shared = [c for c in left.columns if c in right.columns]
    if not shared:
        raise ValueError("the tables share no column")
    a, b = left.alias("a"), right.alias("b")
    same = reduce(and_, (F.col(f"a.`{c}`").eqNullSafe(F.col(f"b.`{c}`")) for c in shared))
    keep = [F.col(f"a.`{c}`") for c in left.columns]
    keep += [F.col(f"b.`{c}`") for c in right.columns if c not in shared]
    return a.join(b, same, "inner").select(*keep)


def merge_pages(frames: Sequence[DataFrame]) -> DataFrame:
    """Put column pages back together by what they share, the row key.

    Keys are checked first, in one aggregation over the key columns: a repeated or NULL key would
    pair rows that do not belong together, so it is an error.
    """
    if len(frames) > 1:
        shared = [c for c in frames[0].columns if all(c in f.columns for f in frames)]
        keys = [F.col(f"`{c}`") for c in shared]
        missing = reduce(or_, (k.isNull() for k in keys), F.lit(False))
        if not frames[0].groupBy(*keys).agg(F.count("*").alias("__rows")).where((F.col("__rows") > 1) | missing).isEmpty():
            raise ValueError(f"the row key {shared} repeats or is missing")
    return reduce(natural_join, frames)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Concatenate tables with the same columns, by name."""
    if not frames:
        raise ValueError("nothing to concatenate")
    return reduce(DataFrame.unionByName, frames)


def concat_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Concatenate by name; a column that a table lacks is NULL there."""
    if not frames:
        raise ValueError("nothing to concatenate")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
