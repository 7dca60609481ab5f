"""CSV tables with a header row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def read_csv(spark: SparkSession, path: str | list[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Read a CSV with header; every column is a nullable string, an empty cell is NULL.

    With ``columns`` the names are declared, which saves the job that reads the header line.
    """
    reader = spark.read.option("header", True)
    if columns is not None:
        reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    return reader.csv(path)


def read_states(
    spark: SparkSession, path: str, columns: Sequence[str], states: Sequence[str] | DataFrame | None = None, state: str = "State"
) -> DataFrame:
    """A table written by state; with ``states`` only the folders of those are listed and read.

    The states are a list, or a table with a column ``state`` and perhaps more columns, which are joined: Spark
    then reads that table first and prunes the folders by what it holds. ``columns`` are those of the files.
    """
    fields = [T.StructField(c, T.StringType()) for c in [*columns, state]]
    rows = spark.read.option("header", True).schema(T.StructType(fields)).csv(path)
    if states is None:
        return rows
    if isinstance(states, DataFrame):
        return rows.join(states, state)
    return rows.where(F.col(f"`{state}`").isin(list(states)))


def typed(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Type string columns at the scan; a value that does not parse becomes NULL."""
    return df.select(
        *[F.col(f"`{c}`").try_cast(types[c]).alias(c) if c in types else F.col(f"`{c}`") for c in df.columns]
    )
