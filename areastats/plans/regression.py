"""Train a model on the merged table, evaluate a stored one or predict with it, and try out a grid."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F

from areastats.config import KEY
from areastats.model.metrics import evaluate
from areastats.model.network import Model, Network
from areastats.model.predict import predict
from areastats.model.spec import FeatureSpec
from areastats.model.split import hash_split, in_train
from areastats.model.sweep import ACTIVATIONS, EPOCHS, HIDDEN, sweep
from areastats.model.train import train


def train_on_merged(
    merged: DataFrame,
    inputs: Sequence[str] = ("SVI",),
    hidden: Sequence[int] = (),
    epochs: int = 150,
    learning_rate: float = 0.1,
    activation: str = "tanh",
    seed: int = 0,
    key: str = KEY,
    start: Model | None = None,
    after_epoch: Callable[[int, Model], None] | None = None,
    group_inputs: bool = False,
) -> Model:
    """Train on the train part of a merged table. The defaults are the shipped run: no hidden layer.

    ``start`` goes on with a stored model instead of a new one; ``after_epoch`` sees the model
    after each epoch, e.g. to store it. ``group_inputs`` adds rows up per distinct input first.
    """
    if start is None:
        spec = FeatureSpec.of(merged, inputs, key)
        start = Model.new(spec, Network.of(spec, hidden, activation), seed)
    return train(start, hash_split(merged, key)[0], epochs, learning_rate, after_epoch, group_inputs)


def evaluate_on_merged(model: Model, merged: DataFrame, key: str = KEY) -> DataFrame:
    """Errors on the train and the test part, split exactly as for training, in one pass."""
    return evaluate(model, merged, F.when(in_train(key), "train").otherwise("test"))


def predict_on_merged(model: Model, merged: DataFrame, key: str = KEY) -> DataFrame:
    """``part`` (train or test) and the predictions beside all columns of the merged table.

    Rows with a missing input keep their place, with NULL predictions.
    """
    return predict(model, merged).withColumn("part", F.when(in_train(key), "train").otherwise("test"))


def sweep_on_merged(
    merged: DataFrame,
    inputs: Sequence[str] = ("SVI",),
    epochs: Sequence[int] = EPOCHS,
    hidden: Sequence[Sequence[int]] = HIDDEN,
    activations: Sequence[str] = ACTIVATIONS,
    learning_rate: float = 0.1,
    seed: int = 0,
    key: str = KEY,
    group_inputs: bool = False,
) -> DataFrame:
    """Errors of every combination, trained on the train part and measured on both."""
    spec = FeatureSpec.of(merged, inputs, key)
    return sweep(*hash_split(merged, key), spec, epochs, hidden, activations, learning_rate, seed, group_inputs)
