"""The regression: split, scaler, gradient, training, prediction, errors and sweep.

Rows are customers: balance in; number, sum and mean of their orders out.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from areastats.model.gradient import gradient_sums, positions
from areastats.model.metrics import residual_metrics
from areastats.model.network import Model, Network
from areastats.model.predict import predict, prediction_name
from areastats.model.scaler import Scaler, fit_scaler, scaler_table, standardize
from areastats.model.spec import FeatureSpec
from areastats.model.split import hash_split, random_split
from areastats.model.store import load_model, save_model
from areastats.model.sweep import ACTIVATIONS, EPOCHS as GRID_EPOCHS, HIDDEN, sweep
from areastats.model.train import train
from areastats.plans.regression import evaluate_on_merged, train_on_merged
from areastats.queries.inputs import FEATURES, features, table
from areastats.queries.network_sql import (
    backward,
    forward,
    gradient_entries,
    initial,
    long_training,
    scaled,
    training,
    weight_rows,
)
from areastats.queries.rates import rounded
from areastats.queries.registry import query
from areastats.session import shared_folder, staged
from areastats.sources.flat import read_csv, typed
from areastats.sources.sinks import write_csv

SPEC = FeatureSpec(("SVI",), ("orders", "spent", "mean_order"))
KEY_COLUMN = "c_custkey"
SEED = 7
EPOCHS = 4
RATE = 0.1

PLAIN = Network.of(SPEC, ())
DEEP = Network.of(SPEC, (3, 2))
LINEAR = Network.of(SPEC, (2,), "sig", "identity")

_SCALED = scaled("features", ['"SVI"'], SPEC.outputs)


def _unpivot(entries: list[tuple[str, str]], source: str, places: int = 6) -> str:
    return " UNION ALL ".join(f"SELECT '{name}' AS name, round({term}, {places}) AS value FROM {source}" for name, term in entries)


@query(f"""WITH {FEATURES}
{" UNION ALL ".join(
    f"SELECT {i} AS position, '{c}' AS column, round(avg({n}), 4) AS mean, round(stddev_pop({n}), 4) AS std FROM features"
    for i, (c, n) in enumerate(zip(SPEC.columns, ['"SVI"', *SPEC.outputs], strict=True)))}
UNION ALL SELECT 4, 'constant', 1.0, 1.0""")
def scaler_fit(spark: SparkSession, sf: str) -> DataFrame:
    rows = features(spark, sf).withColumn("constant", F.lit(1.0))
    spec = FeatureSpec.of(rows, ["SVI"], KEY_COLUMN)
    return rounded(scaler_table(rows, spec), 4)


@query(f"""WITH {FEATURES}, {scaled("features", ['"SVI"'], SPEC.outputs)}
SELECT round(a0_0, 6) AS "SVI", round(t0, 6) AS orders, round(t1, 6) AS spent, round(t2, 6) AS mean_order FROM scaled""")
def scaler_apply(spark: SparkSession, sf: str) -> DataFrame:
    rows = SPEC.complete(features(spark, sf))
    return rounded(standardize(rows, SPEC, fit_scaler(rows, SPEC)))


_BUCKET = "(CAST('0x' || substr(md5('{seed}:' || {c}), 1, 8) AS BIGINT) % 100)"
_IN_TRAIN = _BUCKET.format(seed=42, c=KEY_COLUMN) + " < 80"


@query(f"SELECT c_custkey, CASE WHEN {_IN_TRAIN} THEN 'train' ELSE 'test' END AS part FROM customer", name="hash_split")
def split_by_key(spark: SparkSession, sf: str) -> DataFrame:
    parts = hash_split(table(spark, sf, "customer").select("c_custkey"), "c_custkey")
    train_rows, test_rows = (df.withColumn("part", F.lit(p)) for df, p in zip(parts, ("train", "test"), strict=True))
    return train_rows.unionByName(test_rows)


@query(f"SELECT c_custkey, c_acctbal FROM customer WHERE NOT ({_IN_TRAIN})")
def export_test_rows(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_folder(spark, "test-rows")
    write_csv(hash_split(table(spark, sf, "customer").select("c_custkey", "c_acctbal"), "c_custkey")[1], path)
    return typed(read_csv(spark, path), {"c_custkey": "long", "c_acctbal": "double"})


@query("SELECT c_custkey FROM customer")
def random_split_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Both parts of the random split together are the whole table."""
    train_rows, test_rows = random_split(table(spark, sf, "customer").select("c_custkey"))
    return train_rows.unionByName(test_rows)


@query("""SELECT count(*) AS rows, count(*) FILTER (WHERE (c_acctbal >= 0 AND c_mktsegment <> 'MACHINERY') IS NOT TRUE) AS incomplete
FROM customer""")
def incomplete_rows(spark: SparkSession, sf: str) -> DataFrame:
    balance = F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_acctbal"))
    rows = table(spark, sf, "customer").select(
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("SVI"), balance.alias("balance")
    )
    return FeatureSpec.of(rows).incomplete_count(rows)


def _gradient(spark: SparkSession, sf: str, network: Network) -> DataFrame:
    rows = SPEC.complete(features(spark, sf))
    ready = standardize(rows, SPEC, fit_scaler(rows, SPEC))
    sums = gradient_sums(ready, network, network.initial_weights(SEED))
    names = F.array(*[F.lit(n) for n in positions(network, SPEC.outputs)])
    return sums.select(names[F.col("pos")].alias("name"), F.round("value", 4).alias("value"))


def _gradient_sql(network: Network) -> str:
    rows = backward(network, forward(network, "SELECT * FROM scaled, w"))
    terms = ["1.0::DOUBLE", "0.5 * (e0 * e0 + e1 * e1 + e2 * e2)", "e0", "e1", "e2", *gradient_entries(network)]
    sums = ", ".join(f"sum({t}) AS g{i}" for i, t in enumerate(terms))
    entries = [(n, f"g{i}") for i, n in enumerate(positions(network, SPEC.outputs))]
    return f"""WITH {FEATURES}, {_SCALED}, {initial(network, SEED, "w")},
g AS MATERIALIZED (SELECT {sums} FROM ({rows}))
{_unpivot(entries, "g", 4)}"""


@query(_gradient_sql(PLAIN))
def gradient_step(spark: SparkSession, sf: str) -> DataFrame:
    return _gradient(spark, sf, PLAIN)


@query(_gradient_sql(DEEP))
def gradient_step_hidden(spark: SparkSession, sf: str) -> DataFrame:
    return _gradient(spark, sf, DEEP)


def _train(spark: SparkSession, sf: str, network: Network) -> Model:
    """Train on the features, stored first because making them takes a join."""
    with staged(features(spark, sf), "features") as rows:
        return train(Model.new(SPEC, network, SEED), rows, EPOCHS, RATE)


def _history_sql(network: Network) -> str:
    rows = " UNION ALL ".join(
        f"SELECT {k + 1} AS epoch, round(cost, 6) AS cost, round(e0, 6) AS e0, round(e1, 6) AS e1, round(e2, 6) AS e2 FROM n_p{k}"
        for k in range(EPOCHS)
    )
    return f"WITH {FEATURES}, {_SCALED}, {training(network, SEED, EPOCHS, RATE)}\n{rows}"


@query(_history_sql(PLAIN))
def train_history(spark: SparkSession, sf: str) -> DataFrame:
    model = _train(spark, sf, PLAIN)
    errors = [F.col("mean_error")[j].alias(f"e{j}") for j in range(3)]
    return rounded(model.history_table(spark).select("epoch", "cost", *errors))


def _weights_sql(network: Network) -> str:
    rows = weight_rows(network, f"n_w{EPOCHS}")
    return f"""WITH {FEATURES}, {_SCALED}, {training(network, SEED, EPOCHS, RATE)}
SELECT layer, row, col, round(w, 6) AS w FROM ({rows})"""


@query(_weights_sql(DEEP))
def mlp_train(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_train(spark, sf, DEEP).weight_table(spark))


@query(_weights_sql(LINEAR))
def mlp_train_linear_output(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_train(spark, sf, LINEAR).weight_table(spark))


@query(f"""WITH {FEATURES}, {scaled("features", ['"SVI"'], SPEC.outputs, _IN_TRAIN)}, {training(PLAIN, SEED, EPOCHS, RATE)}
SELECT layer, row, col, round(w, 6) AS w FROM ({weight_rows(PLAIN, f"n_w{EPOCHS}")})""")
def train_model(spark: SparkSession, sf: str) -> DataFrame:
    with staged(features(spark, sf), "features") as rows:
        model = train_on_merged(rows, epochs=EPOCHS, learning_rate=RATE, seed=SEED, key=KEY_COLUMN)
    return rounded(model.weight_table(spark))


#: Epochs of the training run that the reference ships.
SHIPPED_EPOCHS = 150


@query(f"""WITH RECURSIVE {FEATURES}, {scaled("features", ['"SVI"'], SPEC.outputs, _IN_TRAIN)}, {long_training(PLAIN, SEED, SHIPPED_EPOCHS, RATE)}
SELECT layer, row, col, round(w, 6) AS w FROM ({weight_rows(PLAIN, f"(SELECT * FROM n_all WHERE epoch = {SHIPPED_EPOCHS})")})""")
def train_shipped_run(spark: SparkSession, sf: str) -> DataFrame:
    """The whole shipped run: 150 epochs without a hidden layer."""
    with staged(features(spark, sf), "features") as rows:
        model = train_on_merged(rows, epochs=SHIPPED_EPOCHS, learning_rate=RATE, seed=SEED, key=KEY_COLUMN)
    return rounded(model.weight_table(spark))


# Lineitems as rows: discount in, quantity and price out; the network has the default layers.
ITEM_SPEC = FeatureSpec(("l_discount",), ("l_quantity", "l_extendedprice"))
ITEM_NETWORK = Network.of(ITEM_SPEC)
ITEM_EPOCHS = 2


@query(f"""WITH {scaled("lineitem", ITEM_SPEC.inputs, ITEM_SPEC.outputs)}, {training(ITEM_NETWORK, SEED, ITEM_EPOCHS, RATE)}
SELECT layer, row, col, round(w, 6) AS w FROM ({weight_rows(ITEM_NETWORK, f"n_w{ITEM_EPOCHS}")})""")
def mlp_train_default_layers(spark: SparkSession, sf: str) -> DataFrame:
    model = train(Model.new(ITEM_SPEC, ITEM_NETWORK, SEED), table(spark, sf, "lineitem"), ITEM_EPOCHS, RATE)
    return rounded(model.weight_table(spark))


@query(f"""WITH {scaled("lineitem", ITEM_SPEC.inputs, ITEM_SPEC.outputs)}, {training(Network.of(ITEM_SPEC, ()), SEED, EPOCHS, RATE)}
SELECT layer, row, col, round(w, 6) AS w FROM ({weight_rows(Network.of(ITEM_SPEC, ()), f"n_w{EPOCHS}")})""")
def train_on_lineitems(spark: SparkSession, sf: str) -> DataFrame:
    model = Model.new(ITEM_SPEC, Network.of(ITEM_SPEC, ()), SEED)
    return rounded(train(model, table(spark, sf, "lineitem"), EPOCHS, RATE).weight_table(spark))


# Fixed scaler and weights for the queries that apply a model.
FIXED = Scaler(np.array([4500.0, 10.0, 2500000.0, 250000.0]), np.array([3000.0, 3.0, 900000.0, 50000.0]))


def fixed_model(network: Network) -> Model:
    return Model(SPEC, network, network.initial_weights(SEED), FIXED, trained=True)


def _predicted(network: Network) -> str:
    inputs = f'SELECT *, ("SVI" - {FIXED.means[0]}) / {FIXED.stds[0]} AS a0_0 FROM features, w'
    last = len(network.shapes)
    outputs = ", ".join(
        f"a{last}_{j} * {s} + {m} AS p{j}"
        for j, (m, s) in enumerate(zip(FIXED.means[1:].tolist(), FIXED.stds[1:].tolist(), strict=True))
    )
    return f"""{FEATURES}, {initial(network, SEED, "w")},
predicted AS MATERIALIZED (SELECT c_custkey, orders, spent, mean_order, {outputs} FROM ({forward(network, inputs)}))"""


def _prediction_columns() -> str:
    return ", ".join(f'round(p{j}, 4) AS "{prediction_name(c)}"' for j, c in enumerate(SPEC.outputs))


def _predict(spark: SparkSession, sf: str, network: Network) -> DataFrame:
    rows = predict(fixed_model(network), features(spark, sf))
    return rounded(rows.select(KEY_COLUMN, *[prediction_name(c) for c in SPEC.outputs]), 4)


@query(f"WITH {_predicted(PLAIN)} SELECT c_custkey, {_prediction_columns()} FROM predicted")
def predict_linear_tanh(spark: SparkSession, sf: str) -> DataFrame:
    return _predict(spark, sf, PLAIN)


@query(f"WITH {_predicted(DEEP)} SELECT c_custkey, {_prediction_columns()} FROM predicted")
def predict_hidden(spark: SparkSession, sf: str) -> DataFrame:
    return _predict(spark, sf, DEEP)


@query(f"""WITH {FEATURES}, {initial(PLAIN, SEED, "w")}
SELECT c_custkey, round(tanh(w0_0_0 + x * w0_1_0), 6) AS "predicted orders", round(tanh(w0_0_1 + x * w0_1_1), 6) AS "predicted spent",
       round(tanh(w0_0_2 + x * w0_1_2), 6) AS "predicted mean_order"
FROM (SELECT c_custkey, "SVI" AS x FROM features), w""")
def predict_untrained(spark: SparkSession, sf: str) -> DataFrame:
    rows = predict(Model.new(SPEC, PLAIN, SEED), features(spark, sf))
    return rounded(rows.select(KEY_COLUMN, *[prediction_name(c) for c in SPEC.outputs]))


def _error_rows(source: str) -> str:
    """Residual metrics per output and overall, as SQL over residuals ``(output, r)``."""
    return f"""SELECT coalesce(output, '(all)') AS output, count(*) AS n, 0.5 * sum(r * r) AS sse, avg(r * r) AS mse,
       sqrt(avg(r * r)) AS rmse, abs(avg(r)) AS abs_mean_residual FROM ({source}) GROUP BY ROLLUP (output)"""


def _residuals(source: str, extra: str = "") -> str:
    return " UNION ALL ".join(f"SELECT {extra} '{c}' AS output, p{j} - {c} AS r FROM {source}" for j, c in enumerate(SPEC.outputs))


def _significant(c: str) -> str:
    """Ten significant digits, as sums of squares are too large to round to decimals."""
    return f"CASE WHEN {c} = 0 THEN 0.0::DOUBLE ELSE round({c} / power(10, floor(log10(abs({c})))), 6) END AS {c}"


def significant(c: str) -> Column:
    digits = F.round(F.col(c) / F.pow(F.lit(10.0), F.floor(F.log10(F.abs(c)))), 6)
    return F.when(F.col(c) == 0, F.lit(0.0)).otherwise(digits).alias(c)


ERRORS = ["sse", "mse", "rmse", "abs_mean_residual"]


@query(f"""WITH {_predicted(PLAIN)}
SELECT output, n, {", ".join(_significant(c) for c in ERRORS)} FROM ({_error_rows(_residuals("predicted"))})""", name="residual_metrics")
def residual_errors(spark: SparkSession, sf: str) -> DataFrame:
    rows = predict(fixed_model(PLAIN), features(spark, sf))
    metrics = residual_metrics(rows, [(c, prediction_name(c)) for c in SPEC.outputs])
    return metrics.select("output", "n", *[significant(c) for c in ERRORS])


_PART = f"CASE WHEN {_IN_TRAIN} THEN 'train' ELSE 'test' END"


@query(f"""WITH {_predicted(DEEP)}
SELECT part, output, n, {", ".join(_significant(c) for c in ERRORS)} FROM (
    SELECT part, coalesce(output, '(all)') AS output, count(*) AS n, 0.5 * sum(r * r) AS sse, avg(r * r) AS mse,
           sqrt(avg(r * r)) AS rmse, abs(avg(r)) AS abs_mean_residual
    FROM ({_residuals("predicted", f"{_PART} AS part,")}) GROUP BY GROUPING SETS ((part, output), (part)))""")
def evaluate_model(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_folder(spark, "model")
    save_model(spark, fixed_model(DEEP), path)
    metrics = evaluate_on_merged(load_model(spark, path), features(spark, sf), KEY_COLUMN)
    return metrics.select("part", "output", "n", *[significant(c) for c in ERRORS])


SWEEP_EPOCHS, SWEEP_HIDDEN, SWEEP_ACTIVATIONS = (1, 3), ((), (2,)), ("tanh", "sig")


def _sweep_sql() -> str:
    ctes, rows = [], []
    for h in SWEEP_HIDDEN:
        for act in SWEEP_ACTIVATIONS:
            network = Network.of(SPEC, h, act)
            prefix = f"n{len(ctes)}"
            ctes.append(training(network, SEED, max(SWEEP_EPOCHS), RATE, prefix))
            for k in SWEEP_EPOCHS:
                inputs = f'SELECT f.*, m0, m1, m2, m3, s0, s1, s2, s3, ("SVI" - m0) / s0 AS a0_0, w.* FROM features f, stats, {prefix}_w{k} w'
                last = len(network.shapes)
                outs = ", ".join(f"a{last}_{j} * s{j + 1} + m{j + 1} AS p{j}" for j in range(3))
                residuals = _residuals(f"(SELECT *, {outs} FROM ({forward(network, inputs)}))", f"{_IN_TRAIN} AS in_train,")
                layers = ",".join(str(n) for n in h)
                rows.append(f"""SELECT {k} AS epochs, '[{layers}]' AS hidden, {RATE}::DOUBLE AS learning_rate, '{act}' AS activation,
       sqrt(avg(r * r) FILTER (WHERE in_train)) AS rmse_train, abs(avg(r) FILTER (WHERE in_train)) AS abs_mean_residual_train,
       sqrt(avg(r * r) FILTER (WHERE NOT in_train)) AS rmse_test, abs(avg(r) FILTER (WHERE NOT in_train)) AS abs_mean_residual_test
FROM ({residuals})""")
    base = scaled("features", ['"SVI"'], SPEC.outputs, _IN_TRAIN)
    errors = ["rmse_train", "abs_mean_residual_train", "rmse_test", "abs_mean_residual_test"]
    return f"""WITH {FEATURES}, {base}, {", ".join(ctes)}
SELECT epochs, hidden, learning_rate, activation, {", ".join(f"round({c}, 3) AS {c}" for c in errors)}
FROM ({" UNION ALL ".join(rows)})"""


@query(_sweep_sql(), name="sweep")
def sweep_grid(spark: SparkSession, sf: str) -> DataFrame:
    with staged(features(spark, sf), "features") as rows:
        train_rows, test_rows = hash_split(rows, KEY_COLUMN)
        table_of_errors = sweep(
            train_rows, test_rows, SPEC, SWEEP_EPOCHS, SWEEP_HIDDEN, SWEEP_ACTIVATIONS, RATE, SEED
        )
    return rounded(table_of_errors, 3, learning_rate=6)


def _full_sweep_sql() -> str:
    ctes, rows = [], []
    for h in HIDDEN:
        for act in ACTIVATIONS:
            network = Network.of(SPEC, h, act)
            prefix = f"n{len(ctes)}"
            ctes.append(long_training(network, SEED, max(GRID_EPOCHS), RATE, prefix))
            epochs = ", ".join(map(str, GRID_EPOCHS))
            inputs = f'SELECT f.*, m0, m1, m2, m3, s0, s1, s2, s3, ("SVI" - m0) / s0 AS a0_0, w.* FROM features f, stats, {prefix}_all w WHERE epoch IN ({epochs})'
            last = len(network.shapes)
            outs = ", ".join(f"a{last}_{j} * s{j + 1} + m{j + 1} AS p{j}" for j in range(3))
            residuals = _residuals(f"(SELECT *, {outs} FROM ({forward(network, inputs)}))", f"epoch, {_IN_TRAIN} AS in_train,")
            layers = ",".join(str(n) for n in h)
            rows.append(f"""SELECT epoch AS epochs, '[{layers}]' AS hidden, {RATE}::DOUBLE AS learning_rate, '{act}' AS activation,
       sqrt(avg(r * r) FILTER (WHERE in_train)) AS rmse_train, abs(avg(r) FILTER (WHERE in_train)) AS abs_mean_residual_train,
       sqrt(avg(r * r) FILTER (WHERE NOT in_train)) AS rmse_test, abs(avg(r) FILTER (WHERE NOT in_train)) AS abs_mean_residual_test
FROM ({residuals}) GROUP BY epoch""")
    base = scaled("features", ['"SVI"'], SPEC.outputs, _IN_TRAIN)
    errors = ["rmse_train", "abs_mean_residual_train", "rmse_test", "abs_mean_residual_test"]
    return f"""WITH RECURSIVE {FEATURES}, {base}, {", ".join(ctes)}
SELECT epochs, hidden, learning_rate, activation, {", ".join(f"round({c}, 3) AS {c}" for c in errors)}
FROM ({" UNION ALL ".join(rows)})"""


@query(_full_sweep_sql())
def sweep_whole_grid(spark: SparkSession, sf: str) -> DataFrame:
    """The whole grid of the reference: 3 numbers of epochs, 5 layer lists, 2 activations."""
    with staged(features(spark, sf), "features") as rows:
        train_rows, test_rows = hash_split(rows, KEY_COLUMN)
        table_of_errors = sweep(train_rows, test_rows, SPEC, learning_rate=RATE, seed=SEED)
    return rounded(table_of_errors, 3, learning_rate=6)


@query(f"""WITH {FEATURES}, {_SCALED}, {training(PLAIN, SEED, 2, RATE)},
before AS (SELECT avg(0.5 * (e0 * e0 + e1 * e1 + e2 * e2)) AS cost
           FROM ({backward(PLAIN, forward(PLAIN, "SELECT * FROM scaled, n_w1"))}))
SELECT layer, row, col, round(w, 6) AS w, round(cost, 6) AS cost FROM ({weight_rows(PLAIN, "n_w2")}), before""")
def model_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Train one epoch, store, load, train another: the scaler and weights carry on."""
    path = shared_folder(spark, "model")
    with staged(features(spark, sf), "features") as rows:
        save_model(spark, train(Model.new(SPEC, PLAIN, SEED), rows, 1, RATE), path)
        model = train(load_model(spark, path), rows, 1, RATE)
    return rounded(model.weight_table(spark).withColumn("cost", F.lit(model.history[-1][1])))


