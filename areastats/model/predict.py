"""Predictions as columns next to the rows; nothing is collected."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from areastats.functions.activations import activation
from areastats.functions.numbers import to_double
from areastats.model.batches import passes
from areastats.model.gradient import weighted_sums
from areastats.model.network import Model


def prediction_name(output: str) -> str:
    return f"predicted {output}"


def predict(model: Model, df: DataFrame) -> DataFrame:
    """Add one prediction column per output, in the units of the output.

    An untrained model works on the raw inputs and returns raw outputs. Rows with a NULL input
    get NULL predictions.
    """
    xs = [to_double(F.col(f"`{c}`")) for c in model.spec.inputs]
    if model.trained:
        means, stds = model.scaler.inputs(model.spec)
        xs = [(x - float(m)) / float(s) for x, m, s in zip(xs, means, stds, strict=True)]
    ys = _hidden(model, xs) if model.network.hidden else _plain(model, xs)
    if model.trained:
        means, stds = model.scaler.outputs(model.spec)
        ys = [y * float(s) + float(m) for y, m, s in zip(ys, means, stds, strict=True)]
    known = xs[0].isNotNull()
    for x in xs[1:]:
        known = known & x.isNotNull()
    names = [prediction_name(c) for c in model.spec.outputs]
    return df.withColumns({n: F.when(known, y) for n, y in zip(names, ys, strict=True)})


def _plain(model: Model, xs: list[Column]) -> list[Column]:
    act = activation(model.network.last_activation)
    return [act.value(z) for z in weighted_sums(model.weights[0].tolist(), xs)]


def _hidden(model: Model, xs: list[Column]) -> list[Column]:
    forward, _ = passes(model.network)
    weights = model.weights
    names = [f"y{j}" for j in range(model.network.n_out)]
    schema = T.StructType([T.StructField(n, T.DoubleType()) for n in names])

    @F.pandas_udf(schema)
    def outputs(x: pd.DataFrame) -> pd.DataFrame:
        rows = x.to_numpy(dtype=float, na_value=np.nan)
        return pd.DataFrame(forward(weights, rows)[1][-1], columns=names)

    # Only the input columns travel to Python, whatever else the table holds.
    result = outputs(F.struct(*[x.alias(f"x{i}") for i, x in enumerate(xs)]))
    return [result[n] for n in names]
