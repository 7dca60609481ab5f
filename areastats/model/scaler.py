"""Standardisation by mean and population standard deviation."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from areastats.model.spec import FeatureSpec


@dataclass(frozen=True)
class Scaler:
    """Mean and deviation of every column of a specification, in its order."""

    means: np.ndarray
    stds: np.ndarray

    def inputs(self, spec: FeatureSpec) -> tuple[np.ndarray, np.ndarray]:
        n = len(spec.inputs)
        return self.means[:n], self.stds[:n]

    def outputs(self, spec: FeatureSpec) -> tuple[np.ndarray, np.ndarray]:
        n = len(spec.inputs)
        return self.means[n:], self.stds[n:]


def scaler_table(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """``(position, column, mean, std)``: all columns in one aggregation; a constant has std 1."""
    return spec.select(df).agg(_moments(spec).alias("moments")).select(F.inline("moments"))


def _moments(spec: FeatureSpec) -> Column:
    def entry(i: int, name: str) -> Column:
        c = F.col(f"`{name}`")
        return F.struct(
            F.lit(i).alias("position"),
            F.lit(name).alias("column"),
            F.avg(c).alias("mean"),
            # Merging partial moments can leave a constant with a tiny deviation, so it is
            # recognised by its range.
            F.when(F.min(c) == F.max(c), 1.0).otherwise(F.stddev_pop(c)).alias("std"),
        )

    return F.array(*[entry(i, c) for i, c in enumerate(spec.columns)])


def fit_scaler(df: DataFrame, spec: FeatureSpec) -> Scaler:
    """Scaler of the rows given, in one pass; one entry per column comes to the driver."""
    row = spec.select(df).agg(_moments(spec).alias("moments"), F.count("*").alias("rows")).first()
    if not row["rows"]:
        raise ValueError("no rows to fit the scaler on")
    return Scaler(*(np.array([m[k] for m in row["moments"]]) for k in ("mean", "std")))



def standardize(df: DataFrame, spec: FeatureSpec, scaler: Scaler) -> DataFrame:
    """Replace the columns of the specification by their standardised values."""
    scaled = {
        c: (F.col(f"`{c}`") - float(m)) / float(s)
        for c, m, s in zip(spec.columns, scaler.means, scaler.stds, strict=True)
    }
    return df.select(*[scaled[c].alias(c) if c in scaled else F.col(f"`{c}`") for c in df.columns])
