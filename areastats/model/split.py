"""Train and test rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from areastats.config import KEY


def bucket(columns: Sequence[str], seed: int, buckets: int = 100) -> Column:
    """Bucket of a row from a hash of its key: the same in every run and partitioning."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.col(f"`{c}`").cast("string") for c in columns])
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long"), F.lit(buckets))


def in_train(on: str | Sequence[str] = KEY, train: float = 0.8, seed: int = 42) -> Column:
    """True for the rows of the train part."""
    return bucket([on] if isinstance(on, str) else on, seed) < round(train * 100)


def hash_split(
    df: DataFrame, on: str | Sequence[str] = KEY, train: float = 0.8, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Split by key into train and test. Two plain filters: no sort, no draw, repeatable.

    A job that evaluates a stored model can redo the split exactly, so no training row can
    turn up among its test rows.
    """
    train_rows = in_train(on, train, seed)
    return df.where(train_rows), df.where(~train_rows)


def random_split(df: DataFrame, train: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Spark's own random split. It depends on the partitioning of ``df``."""
    a, b = df.randomSplit([train, 1 - train], seed=seed)
    return a, b
