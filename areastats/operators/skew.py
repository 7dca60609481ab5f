"""Joins that stay balanced when one key holds a large part of the rows.

Aggregations need nothing of the kind: Spark combines a hot key on the map side. A join of raw
rows does, because all rows of one key go to one task. Two ways avoid that here. If the other
side has been measured and found small, it is broadcast and the rows stay where they are. If not,
the rows of a hot key are cut into pieces by a salt, and the few rows of the other side that have
the key are repeated for every salt: one ordinary join, each side read once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from areastats.session import stage

#: A side is broadcast up to this size.
BROADCAST_BYTES = 64 * 1024 * 1024
#: What a task of a join should get.
TASK_BYTES = 64 * 1024 * 1024
#: Pieces that a task's share is dealt out in; many small pieces fill tasks evenly.
PIECES = 16
#: Bytes of the sample from which hot keys are estimated, if the plan's own estimate of the size holds.
SAMPLE_BYTES = 256 * 1024 * 1024
HOWS = ("inner", "left", "left_semi", "left_anti")


def join_unique(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "inner",
    broadcast_bytes: int = BROADCAST_BYTES,
    task_bytes: int = TASK_BYTES,
) -> DataFrame:
    """Join ``left`` rows to the fewer rows of ``right`` (inner, left, semi or anti).

    The result is the plain join's, whole. ``right`` is broadcast if measured and at most
    ``broadcast_bytes``; else the join is salted.
    """
    if how not in HOWS:
        raise ValueError(f"join_unique cannot do {how!r}")
    if measured(right)[1] <= broadcast_bytes:
        return left.join(F.broadcast(right), key, how)
    return salted_join(left, right, key, how, task_bytes)


def salted_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner", task_bytes: int = TASK_BYTES) -> DataFrame:
    """The plain join with the rows of hot keys of ``left`` dealt out over tasks.

    Keys may repeat on both sides. A salt comes from all columns of a row, so it is the same if the row
    is computed again after an executor is lost; rows that are equal in every column stay together. Rows
    without a key match nothing and are spread in the same way.
    """
    if how not in HOWS:
        raise ValueError(f"salted_join cannot do {how!r}")
    name = "salt"
    while name in left.columns or name in right.columns or f"{name} count" in left.columns:
        name += "_"
    k, count, salt = F.col(f"`{key}`"), f"{name} count", F.col(f"`{name}`")
    # Written down, since both sides must see the same counts.
    hot = F.broadcast(stage(hot_keys(left, key, task_bytes).withColumnRenamed("salts", count), "hot-keys"))
    of_row = F.xxhash64(*[F.col(f"`{c}`") for c in left.columns])
    rows = left.join(hot, key, "left").withColumn(
        name, F.when(k.isNull(), of_row).otherwise(F.pmod(of_row, F.coalesce(F.col(f"`{count}`"), F.lit(1)).cast("long")))
    )
    copies = F.sequence(F.lit(0).cast("long"), F.coalesce(F.col(f"`{count}`"), F.lit(1)).cast("long") - 1)
    others = right.join(hot, key, "left").withColumn(name, F.explode(copies)).drop(count)
    return rows.drop(count).join(others, [key, name], how).drop(name)


def hot_keys(df: DataFrame, key: str, task_bytes: int = TASK_BYTES) -> DataFrame:
    """``key`` and ``salts`` of the keys whose rows take more than a piece of ``task_bytes``.

    Estimated from a sample, which costs one pass and a shuffle of partial counts; the result decides
    only how evenly tasks are filled. There are at most as many keys as pieces in the whole table.
    """
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    share = min(1.0, SAMPLE_BYTES / max(size, 1))
    rows = df if share == 1.0 else df.sample(share, seed=1)
    k, piece = F.col(f"`{key}`"), task_bytes / PIECES
    sizes = rows.where(k.isNotNull()).groupBy(k).agg(F.sum(row_bytes(df)).alias("bytes"))
    salts = F.ceil(F.col("bytes") / (share * piece)).cast("int")
    return sizes.select(k, salts.alias("salts")).where("salts > 1")


def row_bytes(df: DataFrame) -> Column:
    """Approximate bytes of a row."""
    width = F.lit(0)
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            c = F.to_json(F.struct(c))
        text = isinstance(f.dataType, (T.StringType, T.ArrayType, T.MapType, T.StructType, T.BinaryType))
        width = width + 16 + (F.coalesce(F.octet_length(c), F.lit(0)) if text else 0)
    return width


def measured(df: DataFrame) -> tuple[int, int]:
    """Rows and approximate bytes of a table, from one aggregation.

    A ``limit`` would not be cheaper: it sends up to the limit from every partition to one task.
    """
    row = df.agg(F.count("*"), F.sum(row_bytes(df))).first()
    return row[0], row[1] or 0
