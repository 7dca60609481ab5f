"""Activation functions, once as Column expressions and once for numpy batches."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, functions as F


@dataclass(frozen=True)
class Activation:
    """``value(z)``, and ``slope(z, a)``, its derivative given z and ``a = value(z)``."""

    value: Callable[[Column], Column]
    slope: Callable[[Column, Column], Column]
    value_np: Callable[[np.ndarray], np.ndarray]
    slope_np: Callable[[np.ndarray, np.ndarray], np.ndarray]


ACTIVATIONS = {
    "tanh": Activation(
        F.tanh,
        lambda z, a: 1.0 - a * a,
        np.tanh,
        lambda z, a: 1.0 - a * a,
    ),
    "sig": Activation(
        lambda z: 1.0 / (1.0 + F.exp(-z)),
        lambda z, a: a * (1.0 - a),
        lambda z: 1.0 / (1.0 + np.exp(-z)),
        lambda z, a: a * (1.0 - a),
    ),
    "relu": Activation(
        lambda z: F.greatest(z, F.lit(0.0)),
        lambda z, a: F.when(z > 0, 1.0).otherwise(0.0),
        lambda z: np.maximum(z, 0.0),
        lambda z, a: (z > 0).astype(float),
    ),
    "identity": Activation(
        lambda z: z,
        lambda z, a: F.lit(1.0),
        lambda z: z,
        lambda z, a: np.ones_like(z),
    ),
}


def activation(name: str) -> Activation:
    """Look up an activation; an unknown name is an error, never a silent default."""
    if name not in ACTIVATIONS:
        raise ValueError(f"unknown activation {name!r}; choose from {sorted(ACTIVATIONS)}")
    return ACTIVATIONS[name]
