"""Writers. Every one of them is parallel unless the caller asks for a number of parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def write_csv(df: DataFrame, path: str, *, parts: int | None = None, mode: str = "errorifexists") -> None:
    """Write a CSV with header, one part per partition, or exactly ``parts`` parts.

    Each part is written by one task, whatever the size of the table; ``parts=1`` is for results
    that are known to be small. ``repartition`` keeps the work upstream parallel, which ``coalesce``
    would not.
    """
    if parts is not None:
        df = df.repartition(parts)
    df.write.mode(mode).option("header", True).csv(path)


def write_lines(df: DataFrame, line: Column, path: str, *, mode: str = "errorifexists") -> None:
    """Write one text line per row, ended by CR LF; rows whose line is NULL are left out."""
    lines = df.select(line.alias("value")).where(F.col("value").isNotNull())
    lines.write.mode(mode).option("lineSep", "\r\n").text(path)


def write_by_state(df: DataFrame, path: str, state: str = "State", *, mode: str = "errorifexists") -> None:
    """Write one CSV folder per state, without an index column.

    The rebalance hint gathers a state's rows before the write, so there is no file per task
    and state, and splits a state that is larger than one partition should be.
    """
    df.hint("rebalance", F.col(f"`{state}`")).write.mode(mode).option("header", True).partitionBy(state).csv(path)


def rewrite_states(df: DataFrame, path: str, state: str = "State") -> None:
    """``write_by_state`` that replaces the states that ``df`` has rows of and leaves all others as they are.

    So a run that is repeated, or that covers some of the states only, never doubles or loses a state.
    """
    rows = df.hint("rebalance", F.col(f"`{state}`")).write.mode("overwrite")
    rows.option("partitionOverwriteMode", "dynamic").option("header", True).partitionBy(state).csv(path)


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    """The first ``n`` rows, as a DataFrame; nothing runs until the caller asks."""
    return df.limit(n)
