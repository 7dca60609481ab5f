"""Projection: nested fields, renames, tolerant drops, column order and pages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F


def pick(df: DataFrame, fields: Mapping[str, str]) -> DataFrame:
    """Select fields, nested ones by dotted path, under new names: ``{new: path}``."""
    return df.select(*[F.col(path).alias(new) for new, path in fields.items()])


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename columns ``{old: new}``; absent ones are ignored."""
    return df.withColumnsRenamed(dict(names))


def drop_present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop the listed columns that exist (any case); the others are ignored."""
    return df.drop(*columns)


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Return ``df`` unchanged, or raise if a column is missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; there are {df.columns}")
    return df


def inputs_first(df: DataFrame, inputs: Sequence[str]) -> DataFrame:
    """Move the input columns to the front, in the order given."""
    require_columns(df, inputs)
    rest = [c for c in df.columns if c not in inputs]
    return df.select(*[F.col(f"`{c}`") for c in [*inputs, *rest]])


def pages(df: DataFrame, key: str | Sequence[str], size: int = 5) -> list[DataFrame]:
    """Split a table by columns: every page has the row key and up to ``size`` others."""
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    return [
        df.select(*[F.col(f"`{c}`") for c in [*keys, *rest[i : i + size]]]) for i in range(0, len(rest), size)
    ]
