"""Weighted rendezvous hashing: every record goes to the shard with its highest score.

The score of a record and a shard depends on nothing else, so adding a shard moves only the
records for which the new shard scores highest, and all of them into it. Native: one projection
for the shards, one narrow shuffle for the slots; texts are never shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from areastats.llm.common import narrow
from areastats.session import stage

#: Bytes a record takes besides its text.
ROW_BYTES = 8
#: Slots are numbered in this many parts of each shard at once.
SLOT_PARTS = 256


def hash32(key: Column, shard: int) -> Column:
    """32 bits of ``md5(key:block)``; one digest serves four shards."""
    digest = F.md5(F.concat(key, F.lit(f":{shard // 4}")).cast("binary"))
    return F.conv(F.substring(digest, 1 + 8 * (shard % 4), 8), 16, 10).cast("long")


def best_shard(key: Column, weights: Sequence[float]) -> Column:
    """The shard with the highest ``-weight / ln(u)``; of equal scores the lower shard."""
    scores = [
        F.struct((F.lit(-float(w)) / F.log((hash32(key, s) + 0.5) / 2.0**32)).alias("score"), F.lit(-s).alias("shard"))
        for s, w in enumerate(weights)
        if w > 0
    ]
    best = F.greatest(*scores) if len(scores) > 1 else scores[0]
    return -best["shard"]


def shard_documents(
    docs: DataFrame,
    weights: Sequence[float] = (1.0,) * 24,
    *,
    grown_weight: float = 1.0,
    id_col: str = "doc_id",
    text_col: str = "text",
    slot_parts: int = SLOT_PARTS,
) -> DataFrame:
    """Shard, size, checksum and slot of every record.

    Law ``key``: the id and the weights decide. ``grown_shard`` is the shard after one more of
    ``grown_weight`` has been added. Slots number the records of a shard from 0 without gaps:
    every shard is cut in ``slot_parts`` parts by id and checksum, which are counted and numbered
    side by side, so no task holds a shard. A shard of weight 0 gets nothing.

    A NULL text has no bytes and the checksum of an empty one; a NULL id hashes as the text
    ``null``. Records with equal ids share a shard; equal rows get different slots. Other
    columns are not looked at. An empty table gives an empty result.
    """
    if not any(w > 0 for w in weights) or min(*weights, grown_weight, 1) < 0:
        raise ValueError("weights must not be negative, and one must be positive")
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = narrow(docs, id_col, text_col).select(
        "doc_id",
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        best_shard(key, weights).alias("shard"),
        best_shard(key, [*weights, grown_weight]).alias("grown_shard"),
        F.spark_partition_id().alias("origin"),
    )
    # Written once: the texts are read a single time, and the origin of a row is fixed, so equal
    # rows from many places fall into many parts.
    rows = stage(rows, "shards").withColumn(
        "part", F.pmod(F.xxhash64("doc_id", "text_crc32", "origin"), F.lit(slot_parts)).cast("int")
    )
    sizes = rows.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("shard", "part").orderBy("doc_id", "text_crc32")
    return (
        rows.withColumn("place", F.row_number().over(within) - 1)
        .join(F.broadcast(starts), ["shard", "part"])  # at most shards x parts rows
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("key").alias("law"),
            "shard",
            (F.col("start") + F.col("place")).alias("slot"),
            "grown_shard",
        )
    )
