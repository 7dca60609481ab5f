"""Which columns go in, which come out."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from areastats.config import KEY
from areastats.functions.numbers import to_double
from areastats.operators.project import drop_present, require_columns


@dataclass(frozen=True)
class FeatureSpec:
    """Input columns, and output columns: everything else but the key."""

    inputs: tuple[str, ...]
    outputs: tuple[str, ...]

    @classmethod
    def of(cls, df: DataFrame, inputs: Sequence[str] = ("SVI",), key: str = KEY) -> FeatureSpec:
        """Read the specification off a table; a missing input column is an error."""
        require_columns(df, inputs)
        outputs = [c for c in drop_present(df, [key]).columns if c not in inputs]
        if not outputs:
            raise ValueError("no output columns left")
        return cls(tuple(inputs), tuple(outputs))

    @property
    def columns(self) -> tuple[str, ...]:
        return self.inputs + self.outputs

    def select(self, df: DataFrame, *extra: Column) -> DataFrame:
        """The columns as doubles, inputs first, then any extra ones."""
        return df.select(*[to_double(F.col(f"`{c}`")).alias(c) for c in self.columns], *extra)

    def complete(self, df: DataFrame, *extra: Column) -> DataFrame:
        """Typed rows without a NULL or NaN in the columns, which would spoil every mean and weight."""
        return self.select(df, *extra).na.drop(subset=[f"`{c}`" for c in self.columns])

    def incomplete_count(self, df: DataFrame) -> DataFrame:
        """One row: how many rows there are and how many ``complete`` leaves out."""
        bad = F.greatest(*[F.col(f"`{c}`").isNull() | F.isnan(F.col(f"`{c}`")) for c in self.columns], F.lit(False))
        return self.select(df).agg(F.count("*").alias("rows"), F.count_if(bad).alias("incomplete"))
