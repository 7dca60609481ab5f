"""Directories of tables, routing by columns, and queries against a landed table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from areastats.config import KEY
from areastats.functions.text import source_label
from areastats.operators.project import require_columns
from areastats.sources.flat import read_csv


def list_sources(spark: SparkSession, directory: str) -> list[str]:
    """Names directly below ``directory``, sorted: files, or folders of part files.

    One call to the file system, whatever lies below; hidden and marker entries are left out,
    as Spark's readers leave them out.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(directory)
    entries = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    return sorted(n for n in (e.getPath().getName() for e in entries) if not n.startswith(("_", ".")))


def read_each(
    spark: SparkSession, directory: str, names: Sequence[str] | None = None, label: str | None = None
) -> dict[str, DataFrame]:
    """One frame per CSV source of a directory (schemas may differ), in the given order.

    ``label`` names a column for the source of each row, as the scan reports it, so rows can be told
    apart after a union.

    Without ``names`` the sorted listing decides. Naming the inputs is better where the order
    matters, as it does for the base of a fill and the column order of a merge.
    """
    names = list(names) if names is not None else list_sources(spark, directory)
    if not names:
        raise ValueError(f"no data files in {directory}")
    frames = {n: read_csv(spark, f"{directory.rstrip('/')}/{n}") for n in names}
    return frames if label is None else {n: with_source(df, label) for n, df in frames.items()}


def with_source(df: DataFrame, label: str = "source") -> DataFrame:
    """Rows of a file scan with the name of the file or table folder they come from."""
    if label in df.columns:
        raise ValueError(f"there is a column {label!r} already")
    return df.withColumn(label, source_label(F.col("_metadata.file_path")))


def read_together(spark: SparkSession, directory: str, columns: Sequence[str], label: str = "source") -> DataFrame:
    """All CSV sources of a directory that have the same columns, in one scan, with the source of each row."""
    reader = spark.read.option("header", True).option("recursiveFileLookup", True)
    return with_source(reader.schema(", ".join(f"`{c}` string" for c in columns)).csv(directory), label)


@dataclass
class Roles:
    """A base table, further keyed tables and raw tables that still need a key."""

    base: DataFrame
    fillers: list[DataFrame] = field(default_factory=list)
    raw: list[DataFrame] = field(default_factory=list)


def route_by_key(frames: Mapping[str, DataFrame], key: str = KEY, base: str | None = None) -> Roles:
    """Sort frames into roles: no key column means raw, the first keyed one is the base."""
    keyed = [n for n, df in frames.items() if key in df.columns]
    if not keyed:
        raise ValueError(f"no table with a {key!r} column among {list(frames)}")
    first = base if base is not None else keyed[0]
    require_columns(frames[first], [key])
    return Roles(
        base=frames[first],
        fillers=[frames[n] for n in keyed if n != first],
        raw=[df for n, df in frames.items() if n not in keyed],
    )


def table_query(
    df: DataFrame,
    where: Column | str | None = None,
    fields: Sequence[str] | None = None,
    distinct: bool = False,
) -> DataFrame:
    """Filter, project and optionally deduplicate; filter and columns reach the scan."""
    out = df.where(where) if where is not None else df
    out = out.select(*[F.col(f"`{c}`") for c in fields]) if fields is not None else out
    return out.distinct() if distinct else out
