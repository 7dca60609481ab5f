"""Full-batch gradient descent: the driver holds the weights, Spark the rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, replace

import numpy as np
from pyspark.sql import DataFrame

from areastats.model.gradient import GradientSums, by_inputs
from areastats.model.network import Model, Network
from areastats.model.scaler import Scaler, fit_scaler, standardize
from areastats.model.spec import FeatureSpec
from areastats.session import staged


@dataclass(frozen=True)
class TrainingRows:
    """Standardised rows, one per row of the table or, if ``grouped``, one per distinct input."""

    df: DataFrame
    scaler: Scaler
    grouped: bool


@contextmanager
def training_rows(
    df: DataFrame, spec: FeatureSpec, scaler: Scaler | None, group_inputs: bool = False
) -> Iterator[TrainingRows]:
    """Complete rows, standardised, written once to the shared folder for the block.

    Every epoch reads these rows, so losing an executor costs a re-read of its part of the files.
    With ``group_inputs`` the rows are added up per distinct input before they are written, which
    changes no sum that training uses and pays off where inputs repeat often. The table itself is read twice, for its summary and
    for the rows; one that is expensive to make should be stored first.
    """
    complete = spec.complete(df)
    scaler = scaler or fit_scaler(complete, spec)
    rows = standardize(complete, spec, scaler)
    if group_inputs:
        rows = by_inputs(rows, Network.of(spec, ()))
    with staged(rows, "training-rows") as stored:
        yield TrainingRows(stored, scaler, group_inputs)


def step(
    network: Network, weights: list[np.ndarray], sums: np.ndarray, learning_rate: float
) -> tuple[list[np.ndarray], float, tuple[float, ...]]:
    """One descent step from gradient sums: new weights, cost and mean error per output."""
    means = sums / sums[0]
    flat = network.flatten(weights) - learning_rate * means[2 + network.n_out :]
    return network.unflatten(flat), float(means[1]), tuple(means[2 : 2 + network.n_out].tolist())


def train(
    model: Model,
    df: DataFrame,
    epochs: int = 50,
    learning_rate: float = 0.1,
    after_epoch: Callable[[int, Model], None] | None = None,
    group_inputs: bool = False,
) -> Model:
    """Train on the complete rows of ``df``; one aggregation job per epoch.

    A model that already has a scaler keeps it, and one that has a history goes on counting
    epochs where it stopped. ``after_epoch`` gets the epoch number and the
    model so far, e.g. to store it from time to time.
    """
    done = max((epoch for epoch, _, _ in model.history), default=0)
    with training_rows(df, model.spec, model.scaler, group_inputs) as rows:
        current = replace(model, scaler=rows.scaler)
        sums_of = GradientSums(rows.df, model.network, rows.grouped)
        for epoch in range(done + 1, done + epochs + 1):
            sums = sums_of.collect(current.weights)
            weights, cost, errors = step(current.network, current.weights, sums, learning_rate)
            current = replace(current, weights=weights, history=[*current.history, (epoch, cost, errors)])
            if after_epoch is not None:
                after_epoch(epoch, replace(current, trained=True))
    return replace(current, trained=True)
