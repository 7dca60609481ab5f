"""Gradient sums of a network over a table, as one Spark aggregation."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from areastats.functions.activations import activation
from areastats.model.batches import gradient_partials
from areastats.model.network import Network


def weighted_sums(weights: Sequence[Sequence[Column | float]], xs: Sequence[Column]) -> list[Column]:
    """``x . W + bias`` for every output, as column expressions; row 0 of ``weights`` is the bias."""
    out = []
    for j in range(len(weights[0])):
        z = F.lit(weights[0][j])
        for i, x in enumerate(xs):
            z = z + x * weights[i + 1][j]
        out.append(z)
    return out


def weights_as_data(spark: SparkSession, vector: np.ndarray) -> Column:
    """Weights as the value of a one-row table.

    As literals they would be part of the generated code, which would be compiled anew every epoch.
    """
    values = ", ".join(f"double('{w!r}')" for w in vector.tolist())
    return spark.sql(f"SELECT array({values}) AS weights FROM VALUES (1) AS one(x)").scalar()


def positions(network: Network, outputs: Sequence[str]) -> list[str]:
    """Names of the entries of a gradient vector, in order."""
    names = ["rows", "half_squared_error", *[f"error:{c}" for c in outputs]]
    for layer, (rows, cols) in enumerate(network.shapes):
        names += [f"layer{layer}:{i}:{j}" for i in range(rows) for j in range(cols)]
    return names


def by_inputs(df: DataFrame, network: Network) -> DataFrame:
    """One row per distinct input: inputs, number of rows, sums of the targets and of their squared deviations.

    A network answers equal inputs equally, so these sums are all that its errors and gradients
    depend on. An index with four decimals has ten thousand values, however many rows carry it.
    """
    xs, ts = _columns(df, 0, network.n_in), _columns(df, network.n_in, network.n_in + network.n_out)
    sums = [F.sum(t).alias(f"t{j}") for j, t in enumerate(ts)] + [
        # Deviations from the mean of the input: no difference of large sums, never negative.
        (F.var_pop(t) * F.count(t)).alias(f"q{j}")
        for j, t in enumerate(ts)
    ]
    keys = [x.alias(f"x{i}") for i, x in enumerate(xs)]
    return df.groupBy(*keys).agg(F.count("*").cast("double").alias("n"), *sums)


def _columns(df: DataFrame, start: int, end: int) -> list[Column]:
    return [F.col(f"`{c}`") for c in df.columns[start:end]]


class GradientSums:
    """``(pos, value)`` sums of a network over standardised rows (inputs first, then targets), given its weights.

    Without a hidden layer everything is a built-in aggregate inside generated code; its expressions
    are built once and look the weights up in a column, so every epoch runs the same code. With
    hidden layers each partition is reduced in Arrow batches and the partials are added up by
    a ``groupBy``. Either way the rows stay on the executors. ``grouped`` rows come from
    ``by_inputs``.
    """

    def __init__(self, df: DataFrame, network: Network, grouped: bool = False):
        self.df, self.network, self.grouped = df, network, grouped
        self.weights = "weights"
        while self.weights in df.columns:
            self.weights += "_"
        if not network.hidden:
            self.sums = self._sums()

    def _sums(self) -> Column:
        df, network = self.df, self.network
        xs = _columns(df, 0, network.n_in)
        first = network.n_in + self.grouped
        ts = _columns(df, first, first + network.n_out)
        act = activation(network.last_activation)
        rows, cols = network.shapes[0]
        zs = weighted_sums([[F.get(self.weights, F.lit(i * cols + j)) for j in range(cols)] for i in range(rows)], xs)
        ys = [act.value(z) for z in zs]
        if self.grouped:
            n, squares = F.col("n"), _columns(df, first + network.n_out, first + 2 * network.n_out)
            errors = [n * y - t for y, t in zip(ys, ts, strict=True)]
            squared = [n * (y - t / n) * (y - t / n) + q for y, t, q in zip(ys, ts, squares, strict=True)]
            count = F.sum(n)
        else:
            errors = [y - t for y, t in zip(ys, ts, strict=True)]
            squared = [e * e for e in errors]
            count = F.count("*").cast("double")
        deltas = [e * act.slope(z, y) for e, z, y in zip(errors, zs, ys, strict=True)]
        sums = [count, F.sum(0.5 * reduce(add, squared)), *[F.sum(e) for e in errors], *[F.sum(d) for d in deltas]]
        return F.array(*sums, *[F.sum(d * x) for x in xs for d in deltas])

    def _row(self, weights: list[np.ndarray]) -> DataFrame:
        row = weights_as_data(self.df.sparkSession, self.network.flatten(weights))
        return self.df.withColumn(self.weights, row).agg(self.sums.alias("sums"))

    def __call__(self, weights: list[np.ndarray]) -> DataFrame:
        if self.network.hidden:
            return gradient_sums_many(self.df, [self.network], [weights], self.grouped).drop("model")
        return self._row(weights).select(F.posexplode("sums").alias("pos", "value"))

    def collect(self, weights: list[np.ndarray]) -> np.ndarray:
        """The sums on the driver: one number per weight."""
        if self.network.hidden:
            return collect_sums(self(weights))
        return np.array(self._row(weights).collect()[0][0], dtype=float)


def collect_sums(sums: DataFrame) -> np.ndarray:
    """Bring ``(pos, value)`` sums to the driver: one number per weight."""
    return np.array([r["value"] for r in sorted(sums.collect(), key=lambda r: r["pos"])], dtype=float)


def gradient_sums(df: DataFrame, network: Network, weights: list[np.ndarray], grouped: bool = False) -> DataFrame:
    """``(pos, value)`` sums for one set of weights; ``GradientSums`` is for many."""
    return GradientSums(df, network, grouped)(weights)


def gradient_sums_many(
    df: DataFrame, networks: Sequence[Network], weights: Sequence[list[np.ndarray]], grouped: bool = False
) -> DataFrame:
    """``(model, pos, value)``: the sums of several networks in one pass over the rows.

    A task returns one vector with the sums of all networks, one after the other.
    """
    partials = df.mapInArrow(gradient_partials(networks, weights, grouped), "sums array<double>")
    totals = partials.select(F.posexplode("sums").alias("at", "value")).groupBy("at").agg(F.sum("value").alias("value"))
    ends = np.cumsum([len(positions(n, range(n.n_out))) for n in networks]).tolist()
    model = reduce(add, [(F.col("at") >= end).cast("int") for end in ends])
    start = F.get(F.lit([0, *ends]), F.col("model"))
    return totals.withColumn("model", model).select("model", (F.col("at") - start).alias("pos"), "value")
