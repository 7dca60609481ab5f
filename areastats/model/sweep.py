"""Trying out epochs, layers and activations.

All networks of a sweep train side by side: one pass over the rows per epoch serves them all,
and a run over 100 epochs passes through 10 and 50 on its way. The number of jobs is the largest
number of epochs, not the sum over all combinations.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from areastats.model.batches import Block, passes, to_matrix
from areastats.model.gradient import gradient_sums_many
from areastats.model.metrics import error_columns
from areastats.model.network import Network
from areastats.model.scaler import standardize
from areastats.model.spec import FeatureSpec
from areastats.model.train import TrainingRows, step, training_rows

# The grids tried.
EPOCHS = (10, 50, 100)
HIDDEN = ((), (3, 10, 10), (3, 5, 5), (3, 5, 10, 10, 5), (3, 5, 10, 10, 10, 10))
ACTIVATIONS = ("tanh", "sig")

_COLUMNS = (
    "epochs int, hidden string, learning_rate double, activation string, "
    "rmse_train double, abs_mean_residual_train double, rmse_test double, abs_mean_residual_test double"
)


def sweep(
    train_df: DataFrame,
    test_df: DataFrame,
    spec: FeatureSpec,
    epochs: Sequence[int] = EPOCHS,
    hidden: Sequence[Sequence[int]] = HIDDEN,
    activations: Sequence[str] = ACTIVATIONS,
    learning_rate: float = 0.1,
    seed: int = 0,
    group_inputs: bool = False,
) -> DataFrame:
    """One row per combination with its errors on the train and test rows.

    Columns: ``epochs, hidden, learning_rate, activation``, then the root mean squared error and
    the absolute mean residual over all outputs, each for the train and the test rows.
    """
    networks = [Network.of(spec, h, a) for h in hidden for a in activations]
    weights = [n.initial_weights(seed) for n in networks]
    configs, stored = [], []
    with training_rows(train_df, spec, None, group_inputs) as rows:
        for epoch in range(1, max(epochs) + 1):
            sums: list[dict[int, float]] = [{} for _ in networks]
            # One number per weight and network.
            for r in gradient_sums_many(rows.df, networks, weights, rows.grouped).collect():
                sums[r["model"]][r["pos"]] = r["value"]
            for i, network in enumerate(networks):
                vector = np.array([sums[i][p] for p in sorted(sums[i])])
                weights[i] = step(network, weights[i], vector, learning_rate)[0]
                if epoch in epochs:
                    layers = ",".join(str(h) for h in network.hidden)
                    configs.append((epoch, f"[{layers}]", learning_rate, network.activation))
                    stored.append((network, weights[i]))
        train_errors = model_errors(rows, spec, stored)
    test = standardize(spec.complete(test_df), spec, rows.scaler)
    test_errors = model_errors(TrainingRows(test, rows.scaler, grouped=False), spec, stored)
    table = [(*c, *train_errors.get(i, (None, None)), *test_errors.get(i, (None, None))) for i, c in enumerate(configs)]
    return train_df.sparkSession.createDataFrame(table, _COLUMNS)


def model_errors(
    rows: TrainingRows, spec: FeatureSpec, models: Sequence[tuple[Network, list[np.ndarray]]]
) -> dict[int, tuple[float, float]]:
    """``rmse`` and ``abs_mean_residual`` per model, in output units, in one pass over scaled rows."""
    n_in, n_out, grouped = len(spec.inputs), len(spec.outputs), rows.grouped
    forwards = [(passes(network)[0], weights) for network, weights in models]
    stds = rows.scaler.outputs(spec)[1]

    def partials(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(forwards), 3))
        for batch in batches:
            block = Block.of(to_matrix(batch), n_in, n_out, grouped)
            for i, (forward, weights) in enumerate(forwards):
                y = forward(weights, block.x)[1][-1]
                residual = (block.errors(y).sum(axis=0) * stds).sum()
                sums[i] += block.rows * n_out, residual, (block.squared(y) * stds**2).sum()
        model = pa.array(np.arange(len(forwards)), pa.int32())
        columns = [pa.array(c) for c in sums.T]
        yield pa.RecordBatch.from_arrays([model, *columns], names=["model", "n", "sum_r", "sum_r2"])

    sums = rows.df.mapInArrow(partials, "model int, n double, sum_r double, sum_r2 double")
    errors = sums.groupBy("model").agg(*error_columns(F.sum("n"), F.sum("sum_r"), F.sum("sum_r2")))
    return {r["model"]: (r["rmse"], r["abs_mean_residual"]) for r in errors.collect()}
