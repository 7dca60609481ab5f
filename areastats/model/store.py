"""A model as one row of a Parquet table, so it is stored whole or not at all."""

from __future__ import annotations

import numpy as np
from pyspark.sql import SparkSession

from areastats.model.network import Model, Network
from areastats.model.scaler import Scaler
from areastats.model.spec import FeatureSpec

_MODEL = (
    "inputs array<string>, outputs array<string>, hidden array<int>, activation string, output_activation string, "
    "trained boolean, weights array<double>, means array<double>, stds array<double>, "
    "history array<struct<epoch: int, cost: double, mean_error: array<double>>>"
)


def save_model(spark: SparkSession, model: Model, path: str, mode: str = "errorifexists") -> None:
    """Write weights, scaler, configuration and history to ``path``.

    The file appears when the write is committed; a crash before that leaves no model.
    """
    n, scaler = model.network, model.scaler
    row = (
        list(model.spec.inputs),
        list(model.spec.outputs),
        list(n.hidden),
        n.activation,
        n.output_activation,
        model.trained,
        n.flatten(model.weights).tolist(),
        None if scaler is None else scaler.means.tolist(),
        None if scaler is None else scaler.stds.tolist(),
        [(epoch, cost, list(errors)) for epoch, cost, errors in model.history],
    )
    spark.createDataFrame([row], _MODEL).coalesce(1).write.mode(mode).parquet(path)


def load_model(spark: SparkSession, path: str) -> Model:
    """Read a stored model; a folder without one is an error."""
    row = spark.read.schema(_MODEL).parquet(path).first()
    if row is None:
        raise ValueError(f"{path} holds no complete model")
    spec = FeatureSpec(tuple(row["inputs"]), tuple(row["outputs"]))
    network = Network(
        len(spec.inputs), len(spec.outputs), tuple(row["hidden"]), row["activation"], row["output_activation"]
    )
    scaler = None if row["means"] is None else Scaler(np.array(row["means"]), np.array(row["stds"]))
    history = sorted((r["epoch"], r["cost"], tuple(r["mean_error"])) for r in row["history"])
    return Model(spec, network, network.unflatten(np.array(row["weights"])), scaler, row["trained"], history)
