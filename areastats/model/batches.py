"""What a task does with one Arrow batch: forward and backward pass in numpy."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from areastats.functions.activations import activation
from areastats.model.network import Network


#: Rows that go through the layers together.
BLOCK_ROWS = 1000


@dataclass(frozen=True)
class Block:
    """Rows as matrices: inputs and targets, or per distinct input the sums of its targets.

    In the second case ``n`` holds the rows behind each input and ``squares`` the sums of the
    squared deviations of the targets from their mean.
    """

    x: np.ndarray
    t: np.ndarray
    n: np.ndarray | None = None
    squares: np.ndarray | None = None

    @classmethod
    def of(cls, data: np.ndarray, n_in: int, n_out: int, grouped: bool) -> Block:
        x = data[:, :n_in]
        if not grouped:
            return cls(x, data[:, n_in:])
        t = n_in + 1
        return cls(x, data[:, t : t + n_out], data[:, n_in], data[:, t + n_out :])

    def blocks(self, size: int) -> Iterator[Block]:
        for i in range(0, len(self.x), size):
            parts = (None if a is None else a[i : i + size] for a in (self.x, self.t, self.n, self.squares))
            yield Block(*parts)

    @property
    def rows(self) -> float:
        return len(self.x) if self.n is None else self.n.sum()

    def errors(self, y: np.ndarray) -> np.ndarray:
        """``y - t``, added up over the rows behind each input."""
        return y - self.t if self.n is None else y * self.n[:, None] - self.t

    def squared(self, y: np.ndarray) -> np.ndarray:
        """Sum of ``(y - t)^2`` per output."""
        if self.n is None:
            return np.square(y - self.t).sum(axis=0)
        n = self.n[:, None]
        return (n * np.square(y - self.t / n) + self.squares).sum(axis=0)


def passes(network: Network) -> tuple[Callable, Callable]:
    """Forward and gradient functions of a network, free of references to the driver."""
    inner, last = activation(network.activation), activation(network.last_activation)
    acts = [(inner.value_np, inner.slope_np)] * len(network.hidden) + [(last.value_np, last.slope_np)]

    def forward(weights: Sequence[np.ndarray], x: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        zs, outs = [], [x]
        for w, (value, _) in zip(weights, acts, strict=True):
            zs.append(outs[-1] @ w[1:] + w[0])
            outs.append(value(zs[-1]))
        return zs, outs

    def gradient(weights: Sequence[np.ndarray], data: Block) -> np.ndarray:
        """Sums over the rows: count, half squared error, error per output, weight gradients."""
        # Blocks whose layers fit the processor cache take about half the time of large ones.
        return sum(block_gradient(weights, block) for block in data.blocks(BLOCK_ROWS))

    def block_gradient(weights: Sequence[np.ndarray], block: Block) -> np.ndarray:
        zs, outs = forward(weights, block.x)
        error = block.errors(outs[-1])
        # All rows behind an input share its slopes, and the way back is linear in the error.
        delta = error * acts[-1][1](zs[-1], outs[-1])
        grads = []
        for layer in range(len(weights) - 1, -1, -1):
            grads.insert(0, np.vstack([delta.sum(axis=0), outs[layer].T @ delta]).ravel())
            if layer:
                delta = (delta @ weights[layer][1:].T) * acts[layer - 1][1](zs[layer - 1], outs[layer])
        return np.concatenate([[block.rows, 0.5 * block.squared(outs[-1]).sum()], error.sum(axis=0), *grads])

    return forward, gradient


def to_matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])


def gradient_partials(networks: Sequence[Network], weights: Sequence[list[np.ndarray]], grouped: bool) -> Callable:
    """Function for ``mapInArrow``: the gradient sums of every network over one partition.

    A task returns one vector, however many rows it has read.
    """
    n_in, n_out = networks[0].n_in, networks[0].n_out
    gradients = [passes(n)[1] for n in networks]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            block = Block.of(to_matrix(batch), n_in, n_out, grouped)
            sums = [g(w, block) for g, w in zip(gradients, weights, strict=True)]
            totals = sums if totals is None else [a + b for a, b in zip(totals, sums, strict=True)]
        if totals:
            yield pa.RecordBatch.from_arrays([pa.array([np.concatenate(totals)], pa.list_(pa.float64()))], names=["sums"])

    return run
