"""Small helpers that several operators share."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from contextlib import contextmanager
from types import ModuleType

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Name under which a Python worker keeps what is worth keeping between its tasks.
_STORE = "areastats_worker_store"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def narrow(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the id and the text, under fixed names, so that other columns cannot clash."""
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))


def inner_prefix(df: DataFrame) -> str:
    """How names of helper columns can begin so that none of ``df`` clashes."""
    prefix = "__"
    while any(c.startswith(prefix) for c in df.columns):
        prefix += "_"
    return prefix


def text_hash(text: Column) -> Column:
    """Tells rows with the same id apart: equal texts (or none) give equal values."""
    return F.xxhash64(text, F.octet_length(text))


@contextmanager
def arrow_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Hand Python so many rows at a time in the jobs of this block; wide rows need small batches."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def worker_store() -> dict:
    """A dictionary that lives as long as the Python worker.

    Functions travel by value, so their module-level variables last for one task only; Spark
    reuses workers, and caches of tokenised words pay off over all tasks of a worker.
    """
    module = sys.modules.setdefault(_STORE, ModuleType(_STORE))
    return module.__dict__.setdefault("items", {})


def possible(df: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """Rows of ``df`` whose ``key`` may be among the one column of ``ids``; none that is gets lost.

    A bitmap of fixed size (4 MB) is broadcast whatever the number of ids, so that a join that
    follows shuffles few rows that find no partner. Places come from functions that are never NULL: for others Spark
    infers a filter that repeats the whole expression of the key, which may make a method too long to be compiled.
    """

    def place(c: str) -> Column:
        return F.xxhash64(F.col(c)).bitwiseAND(F.lit((1 << 25) - 1).cast("long"))

    name = ids.columns[0]
    marks = ids.select(place(name).alias("__bit"))
    maps = marks.groupBy(F.shiftright("__bit", 15).alias("__bucket")).agg(F.bitmap_construct_agg(F.col("__bit") % 32768).alias("__map"))
    rows = df.withColumn("__bit", place(key)).withColumn("__bucket", F.shiftright("__bit", 15)).join(F.broadcast(maps), "__bucket")
    byte = F.conv(F.hex(F.expr("substring(__map, cast((__bit % 32768) div 8 + 1 as int), 1)")), 16, 10).cast("int")
    bit = byte.bitwiseAND(F.expr("shiftleft(1, cast(__bit % 8 as int))"))
    return rows.where(bit != 0).select(*[F.col(f"`{c}`") for c in df.columns])
