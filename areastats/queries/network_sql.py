"""SQL for a network: the forward pass, the gradient and some epochs of training.

A second, independent formulation of the regression, one CTE per epoch, to compare with.
"""

from __future__ import annotations

from collections.abc import Sequence

from areastats.model.network import Network

_VALUE = {
    "tanh": "tanh({z})",
    "sig": "1 / (1 + exp(-({z})))",
    "relu": "greatest({z}, 0.0::DOUBLE)",
    "identity": "{z}",
}
_SLOPE = {
    "tanh": "(1 - {a} * {a})",
    "sig": "({a} * (1 - {a}))",
    "relu": "CASE WHEN {z} > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END",
    "identity": "1.0::DOUBLE",
}


def weight_names(network: Network) -> list[str]:
    return [f"w{l}_{i}_{j}" for l, (rows, cols) in enumerate(network.shapes) for i in range(rows) for j in range(cols)]


def scaled(source: str, inputs: Sequence[str], outputs: Sequence[str], where: str = "TRUE") -> str:
    """CTEs ``stats`` and ``scaled``, with columns ``a0_0..`` (inputs) and ``t0..`` (targets)."""
    names = [*inputs, *outputs]
    new = [f"a0_{i}" for i in range(len(inputs))] + [f"t{j}" for j in range(len(outputs))]
    where = " AND ".join([where, *[f"{c} IS NOT NULL" for c in names]])
    stats = ", ".join(
        f"avg({c}) AS m{i}, CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END AS s{i}"
        for i, c in enumerate(names)
    )
    columns = ", ".join(f"({c} - m{i}) / s{i} AS {n}" for i, (c, n) in enumerate(zip(names, new, strict=True)))
    return (
        f"stats AS MATERIALIZED (SELECT {stats} FROM {source} WHERE {where}),\n"
        f"scaled AS MATERIALIZED (SELECT {columns} FROM {source}, stats WHERE {where})"
    )


def forward(network: Network, rows: str) -> str:
    """Query that adds ``z<l>_<j>`` and ``a<l>_<j>`` for every layer to ``rows``, which holds the weights."""
    last = len(network.shapes) - 1
    q = rows
    for l, (n_rows, n_cols) in enumerate(network.shapes):
        zs = [
            " + ".join([f"w{l}_0_{j}", *[f"a{l}_{i} * w{l}_{i + 1}_{j}" for i in range(n_rows - 1)]])
            for j in range(n_cols)
        ]
        q = f"SELECT *, {', '.join(f'{z} AS z{l}_{j}' for j, z in enumerate(zs))} FROM ({q})"
        value = _VALUE[network.last_activation if l == last else network.activation]
        acts = ", ".join(f"{value.format(z=f'z{l}_{j}')} AS a{l + 1}_{j}" for j in range(n_cols))
        q = f"SELECT *, {acts} FROM ({q})"
    return q


def backward(network: Network, q: str) -> str:
    """Query that adds errors ``e<j>`` and deltas ``d<l>_<j>`` to the result of ``forward``."""
    last = len(network.shapes) - 1
    q = f"SELECT *, {', '.join(f'a{last + 1}_{j} - t{j} AS e{j}' for j in range(network.n_out))} FROM ({q})"
    for l in range(last, -1, -1):
        n_cols = network.shapes[l][1]
        slope = _SLOPE[network.last_activation if l == last else network.activation]
        deltas = []
        for j in range(n_cols):
            if l == last:
                back = f"e{j}"
            else:
                ahead = range(network.shapes[l + 1][1])
                back = "(" + " + ".join(f"d{l + 1}_{k} * w{l + 1}_{j + 1}_{k}" for k in ahead) + ")"
            deltas.append(f"{back} * {slope.format(z=f'z{l}_{j}', a=f'a{l + 1}_{j}')} AS d{l}_{j}")
        q = f"SELECT *, {', '.join(deltas)} FROM ({q})"
    return q


def gradient_entries(network: Network) -> list[str]:
    """Per-row terms whose sums make the gradient, in the order of the weights."""
    return [
        f"d{l}_{j}" if i == 0 else f"d{l}_{j} * a{l}_{i - 1}"
        for l, (rows, cols) in enumerate(network.shapes)
        for i in range(rows)
        for j in range(cols)
    ]


def initial(network: Network, seed: int, name: str) -> str:
    values = network.flatten(network.initial_weights(seed)).tolist()
    columns = ", ".join(f"{v!r}::DOUBLE AS {w}" for v, w in zip(values, weight_names(network), strict=True))
    return f"{name} AS MATERIALIZED (SELECT {columns})"


def training(network: Network, seed: int, epochs: int, rate: float, prefix: str = "n") -> str:
    """CTEs ``<prefix>_w0 .. <prefix>_w<epochs>`` (one row of weights) and ``<prefix>_h<k>`` (history)."""
    half = "0.5 * (" + " + ".join(f"e{j} * e{j}" for j in range(network.n_out)) + ")"
    errors = ", ".join(f"avg(e{j}) AS e{j}" for j in range(network.n_out))
    ctes = [initial(network, seed, f"{prefix}_w0")]
    for k in range(epochs):
        rows = backward(network, forward(network, f"SELECT * FROM scaled, {prefix}_w{k}"))
        updates = ", ".join(
            f"any_value({w}) - {rate} * avg({term}) AS {w}"
            for w, term in zip(weight_names(network), gradient_entries(network), strict=True)
        )
        ctes.append(f"{prefix}_p{k} AS MATERIALIZED (SELECT {updates}, avg({half}) AS cost, {errors} FROM ({rows}))")
        ctes.append(f"{prefix}_w{k + 1} AS (SELECT {', '.join(weight_names(network))} FROM {prefix}_p{k})")
    return ",\n".join(ctes)


def long_training(network: Network, seed: int, epochs: int, rate: float, prefix: str = "n") -> str:
    """CTE ``<prefix>_all``: the weights after ``epoch`` 0 to ``epochs``, by a recursive CTE (needs WITH RECURSIVE)."""
    names = ", ".join(weight_names(network))
    rows = backward(network, forward(network, f"SELECT * FROM scaled, {prefix}_run WHERE epoch < {epochs}"))
    updates = ", ".join(
        f"any_value({w}) - {rate} * avg({term}) AS {w}"
        for w, term in zip(weight_names(network), gradient_entries(network), strict=True)
    )
    return f"""{initial(network, seed, f"{prefix}_w0")},
{prefix}_run AS (SELECT 0 AS epoch, {names} FROM {prefix}_w0 UNION ALL SELECT epoch + 1 AS epoch, {updates} FROM ({rows}) GROUP BY epoch),
{prefix}_all AS MATERIALIZED (SELECT * FROM {prefix}_run)"""


def weight_rows(network: Network, source: str) -> str:
    """The one row of weights as ``(layer, row, col, w)`` rows."""
    parts = []
    for name in weight_names(network):
        l, i, j = name[1:].split("_")
        parts.append(f"SELECT {l} AS layer, {i} AS row, {j} AS col, {name} AS w FROM {source}")
    return " UNION ALL ".join(parts)
