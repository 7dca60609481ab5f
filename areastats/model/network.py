"""Shape and weights of a fully connected network."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from areastats.functions.activations import activation
from areastats.model.scaler import Scaler
from areastats.model.spec import FeatureSpec

#: Layer sizes used when none are given.
DEFAULT_HIDDEN = (3, 10, 10)


@dataclass(frozen=True)
class Network:
    """Layer sizes and activations. ``hidden`` of 0, [] or [0] means no hidden layer.

    The output layer is activated as well, by the same function unless another is named: with
    ``tanh`` on standardised targets nothing beyond one deviation can be reached.
    """

    n_in: int
    n_out: int
    hidden: tuple[int, ...] = DEFAULT_HIDDEN
    activation: str = "tanh"
    output_activation: str | None = None

    @classmethod
    def of(
        cls,
        spec: FeatureSpec,
        hidden: Sequence[int] | int = DEFAULT_HIDDEN,
        activation: str = "tanh",
        output_activation: str | None = None,
    ) -> Network:
        layers = (hidden,) if isinstance(hidden, int) else tuple(hidden)
        layers = () if layers == (0,) else layers
        return cls(len(spec.inputs), len(spec.outputs), layers, activation, output_activation)

    def __post_init__(self) -> None:
        activation(self.activation)
        activation(self.last_activation)
        if min((self.n_in, self.n_out, *self.hidden)) < 1:
            raise ValueError("every layer needs at least one unit")

    @property
    def last_activation(self) -> str:
        return self.output_activation or self.activation

    @property
    def shapes(self) -> list[tuple[int, int]]:
        """Weight matrix shapes; row 0 of each matrix is the bias."""
        sizes = [self.n_in, *self.hidden, self.n_out]
        return [(a + 1, b) for a, b in zip(sizes[:-1], sizes[1:], strict=True)]

    def initial_weights(self, seed: int = 0) -> list[np.ndarray]:
        """Uniform in [0, 1), divided by the root of the rows of the matrix."""
        rng = np.random.default_rng(seed)
        return [rng.uniform(size=shape) / np.sqrt(shape[0]) for shape in self.shapes]

    def flatten(self, matrices: Sequence[np.ndarray]) -> np.ndarray:
        return np.concatenate([m.ravel() for m in matrices])

    def unflatten(self, vector: np.ndarray) -> list[np.ndarray]:
        cuts = np.cumsum([a * b for a, b in self.shapes])[:-1]
        return [part.reshape(shape) for part, shape in zip(np.split(vector, cuts), self.shapes, strict=True)]


@dataclass
class Model:
    """A network with its weights, and the scaler and history once it is trained."""

    spec: FeatureSpec
    network: Network
    weights: list[np.ndarray]
    scaler: Scaler | None = None
    trained: bool = False
    history: list[tuple[int, float, tuple[float, ...]]] = field(default_factory=list)

    @classmethod
    def new(cls, spec: FeatureSpec, network: Network, seed: int = 0) -> Model:
        return cls(spec, network, network.initial_weights(seed))

    def weight_rows(self) -> list[tuple[int, int, int, float]]:
        return [
            (layer, row, col, float(w))
            for layer, matrix in enumerate(self.weights)
            for (row, col), w in np.ndenumerate(matrix)
        ]

    def weight_table(self, spark: SparkSession) -> DataFrame:
        """``(layer, row, col, w)``; row 0 is the bias."""
        return spark.createDataFrame(self.weight_rows(), "layer int, row int, col int, w double")

    def history_table(self, spark: SparkSession) -> DataFrame:
        """``(epoch, cost, mean_error)``: half the squared error per row, and the mean signed error per output."""
        rows = [(e, c, list(m)) for e, c, m in self.history]
        return spark.createDataFrame(rows, "epoch int, cost double, mean_error array<double>")
