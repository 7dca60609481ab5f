import numpy as np
import pytest
from conftest import collected
from pyspark.sql import functions as F

from areastats.config import KEY
from areastats.model.batches import Block, passes
from areastats.model.gradient import by_inputs, collect_sums, gradient_sums, gradient_sums_many, positions
from areastats.model.metrics import OVERALL, evaluate, residual_metrics
from areastats.model.network import Model, Network
from areastats.model.predict import predict, prediction_name
from areastats.model.scaler import fit_scaler, scaler_table, standardize
from areastats.model.spec import FeatureSpec
from areastats.model.split import hash_split, random_split
from areastats.model.store import load_model, save_model
from areastats.model.sweep import sweep
from areastats.model.train import train
from areastats.plans.regression import evaluate_on_merged, train_on_merged

N = 200


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(3)
    x = rng.uniform(size=(N, 2))
    t = np.column_stack([np.tanh(x[:, 0] - x[:, 1]), 5 * x[:, 1] + 100, rng.normal(size=N)])
    return x, t


@pytest.fixture(scope="module")
def table(spark, data):
    x, t = data
    rows = [(f"K{i}-AL", *map(float, a), *map(float, b)) for i, (a, b) in enumerate(zip(x, t, strict=True))]
    return spark.createDataFrame(rows, f"`{KEY}` string, SVI double, `Second In` double, a double, b double, `c-d` double").repartition(3)


@pytest.fixture(scope="module")
def spec(table):
    return FeatureSpec.of(table, ["SVI", "Second In"])


def standardised(data):
    x, t = data
    return (x - x.mean(0)) / x.std(0), (t - t.mean(0)) / t.std(0)


def test_spec(table, rows):
    spec = FeatureSpec.of(table)
    assert spec.inputs == ("SVI",) and spec.outputs == ("Second In", "a", "b", "c-d")
    with pytest.raises(ValueError, match="SVI"):
        FeatureSpec.of(table.drop("SVI"))
    with pytest.raises(ValueError, match="no output"):
        FeatureSpec.of(rows(f"`{KEY}` string, SVI double", [("a", 1.0)]))


def test_rows_with_missing_values_are_left_out_and_counted(rows):
    df = rows("SVI string, y string", [("1", "2"), ("", "2"), (None, "1"), ("3", "NaN"), ("x", "1")])
    spec = FeatureSpec.of(df)
    assert collected(spec.complete(df)) == [(1.0, 2.0)]
    assert collected(spec.incomplete_count(df)) == [(5, 4)]


def test_network_shapes():
    assert Network(2, 3).hidden == (3, 10, 10)
    spec = FeatureSpec(("x",), ("y", "z"))
    assert {Network.of(spec, h).hidden for h in (0, [], [0])} == {()}
    assert Network.of(spec, [3, 2]).shapes == [(2, 3), (4, 2), (3, 2)]
    with pytest.raises(ValueError, match="softmax"):
        Network.of(spec, [], "softmax")
    with pytest.raises(ValueError, match="one unit"):
        Network.of(spec, [3, 0])


def test_initial_weights():
    n = Network(4, 2, (3,))
    a, b = n.initial_weights(1), n.initial_weights(1)
    assert all((p == q).all() for p, q in zip(a, b, strict=True))
    assert all((m >= 0).all() and (m < 1 / np.sqrt(m.shape[0])).all() for m in a)
    assert all((p == q).all() for p, q in zip(a, n.unflatten(n.flatten(a)), strict=True))


def test_scaler_is_population_and_never_zero(rows):
    df = rows("SVI double, c double", [(1.0, 7.0), (2.0, 7.0), (6.0, 7.0)])
    spec = FeatureSpec.of(df)
    assert collected(scaler_table(df, spec)) == [(0, "SVI", 3.0, np.std([1, 2, 6])), (1, "c", 7.0, 1.0)]
    scaled = standardize(df, spec, fit_scaler(df, spec))
    assert [r["c"] for r in scaled.collect()] == [0.0, 0.0, 0.0]
    with pytest.raises(ValueError, match="no rows"):
        fit_scaler(df.limit(0), spec)


def test_constant_over_many_partitions(spark):
    df = spark.range(4900).selectExpr("CAST(id AS DOUBLE) AS SVI", "1.0D AS c", "id").repartition(100, "id").where("id % 7 <> 3")
    stds = {r["column"]: r["std"] for r in scaler_table(df, FeatureSpec(("SVI",), ("c",))).collect()}
    assert stds["c"] == 1.0 and stds["SVI"] > 1000


@pytest.mark.parametrize("name", ["tanh", "sig", "relu"])
@pytest.mark.parametrize("hidden", [(), (3,), (3, 4)])
def test_gradient_against_finite_differences(data, name, hidden):
    x, t = standardised(data)
    network = Network(2, 3, hidden, name)
    weights = network.initial_weights(5)
    _, gradient = passes(network)
    flat = network.flatten(weights)
    exact = gradient(weights, Block(x, t))
    assert exact[0] == N and len(exact) == len(positions(network, "abc"))
    for i in range(len(flat)):
        d = np.zeros_like(flat)
        d[i] = 1e-6
        up, down = (gradient(network.unflatten(flat + s * d), Block(x, t))[1] for s in (1, -1))
        assert exact[5 + i] == pytest.approx((up - down) / 2e-6, rel=1e-3, abs=1e-3)


@pytest.mark.parametrize("name", ["tanh", "sig", "relu", "identity"])
def test_column_gradient_equals_batch_gradient(table, spec, data, name):
    network = Network.of(spec, (), name)
    weights = network.initial_weights(2)
    rows = spec.complete(table)
    scaled = standardize(rows, spec, fit_scaler(rows, spec))
    x, t = standardised(data)
    expected = passes(network)[1](weights, Block(x, t))
    assert np.allclose(collect_sums(gradient_sums(scaled, network, weights)), expected)
    assert np.allclose(collect_sums(gradient_sums_many(scaled, [network], [weights])), expected)


def descend(network, weights, x, t, epochs, rate):
    """Plain gradient descent in memory, to compare with."""
    _, gradient = passes(network)
    costs = []
    for _ in range(epochs):
        means = gradient(weights, Block(x, t)) / len(x)
        costs.append(means[1])
        weights = network.unflatten(network.flatten(weights) - rate * means[2 + network.n_out :])
    return weights, costs


@pytest.fixture(scope="module")
def repeated(spark):
    """Inputs with a few values, one of which has a third of all rows."""
    x = "CASE WHEN id % 3 = 0 THEN 0.5D ELSE (id % 5) / 5D END"
    return spark.range(900).selectExpr(f"CONCAT('K', id) AS `{KEY}`", f"{x} AS SVI", "SIN(id) AS a", "100 + id % 11 AS b")


@pytest.mark.parametrize("hidden", [(), (3, 2)])
@pytest.mark.parametrize("name", ["tanh", "sig", "relu"])
def test_grouping_by_input_changes_no_sum(repeated, hidden, name):
    spec = FeatureSpec.of(repeated)
    network = Network.of(spec, hidden, name)
    weights = network.initial_weights(3)
    rows = spec.complete(repeated)
    scaled = standardize(rows, spec, fit_scaler(rows, spec))
    grouped = by_inputs(scaled, network)
    assert grouped.count() == 6
    plain = collect_sums(gradient_sums(scaled, network, weights))
    assert np.allclose(collect_sums(gradient_sums(grouped, network, weights, grouped=True)), plain)


def test_perfectly_fitted_repeats_have_no_negative_error(spark):
    """Large targets, each input many times and always with one target: the error sums are exact zeros or more."""
    spec = FeatureSpec(("x",), ("t",))
    rows = spark.range(2000).selectExpr("double(id % 7) / 3 AS x", "1e6 + double(id % 7) / 3 AS t")
    network = Network.of(spec, ())
    grouped = by_inputs(rows, network)
    assert grouped.where("q0 < 0").count() == 0 and grouped.agg(F.sum("q0")).first()[0] < 1e-6
    for hidden in ((), (3,)):
        network = Network.of(spec, hidden)
        weights = network.initial_weights(1)
        plain = collect_sums(gradient_sums(rows, network, weights))
        assert np.allclose(collect_sums(gradient_sums(grouped, network, weights, grouped=True)), plain, rtol=1e-9)
        assert plain[1] >= 0


def test_sweep_on_repeated_inputs(repeated):
    spec = FeatureSpec.of(repeated)
    out = sweep(repeated, repeated, spec, (2,), ((2,),), ("tanh",), group_inputs=True).first()
    plain = sweep(repeated, repeated, spec, (2,), ((2,),), ("tanh",)).first()
    assert all(a == pytest.approx(b) for a, b in zip(out, plain, strict=True) if isinstance(a, float))
    assert out["rmse_train"] == pytest.approx(out["rmse_test"])
    assert out["abs_mean_residual_train"] == pytest.approx(out["abs_mean_residual_test"])
    errors = evaluate(train(Model.new(spec, Network.of(spec, (2,))), repeated, 2), repeated)
    assert errors.where(F.col("output") == OVERALL).first()["rmse"] == pytest.approx(out["rmse_train"])


@pytest.mark.parametrize("hidden", [(), (3, 2)])
def test_training_equals_descent_in_memory(table, spec, data, hidden):
    network = Network.of(spec, hidden)
    model = train(Model.new(spec, network, 4), table, 3, 0.2)
    weights, costs = descend(network, network.initial_weights(4), *standardised(data), 3, 0.2)
    assert all(np.allclose(a, b) for a, b in zip(model.weights, weights, strict=True))
    assert np.allclose([h[1] for h in model.history], costs) and costs[-1] < costs[0]
    assert model.trained and [h[0] for h in model.history] == [1, 2, 3]


def test_training_goes_on_with_the_stored_scaler(spark, table, spec, tmp_path):
    network = Network.of(spec, (2,))
    seen = []
    once = train(Model.new(spec, network, 1), table, 4, after_epoch=lambda e, m: seen.append((e, m.weights)))
    half = train(Model.new(spec, network, 1), table, 2)
    save_model(spark, half, str(tmp_path / "m"))
    loaded = load_model(spark, str(tmp_path / "m"))
    assert (loaded.spec, loaded.network, loaded.trained) == (half.spec, half.network, True)
    assert len(loaded.history) == 2
    rest = train(loaded, table, 2)
    assert all(np.allclose(a, b) for a, b in zip(rest.weights, once.weights, strict=True))
    assert [e for e, _ in seen] == [1, 2, 3, 4]
    assert [h[0] for h in rest.history] == [1, 2, 3, 4] and np.allclose([h[1] for h in rest.history], [h[1] for h in once.history])
    assert all(np.allclose(a, b) for a, b in zip(seen[1][1], half.weights, strict=True))


def test_untrained_model_is_stored_without_scaler(spark, spec, tmp_path):
    save_model(spark, Model.new(spec, Network.of(spec, ())), str(tmp_path / "m"))
    loaded = load_model(spark, str(tmp_path / "m"))
    assert loaded.scaler is None and not loaded.trained and loaded.history == []


@pytest.mark.parametrize("hidden", [(), (3,)])
@pytest.mark.parametrize("trained", [True, False])
def test_predictions(table, spec, data, hidden, trained):
    network = Network.of(spec, hidden)
    model = Model.new(spec, network, 6)
    if trained:
        model = train(model, table, 1)
    out = predict(model, table)
    assert out.columns == table.columns + [prediction_name(c) for c in spec.outputs]
    got = np.array([[r[prediction_name(c)] for c in spec.outputs] for r in sorted(out.collect(), key=lambda r: int(r[KEY][1:-3]))])
    x, t = data
    inputs = (x - x.mean(0)) / x.std(0) if trained else x
    expected = passes(network)[0](model.weights, inputs)[1][-1]
    expected = expected * t.std(0) + t.mean(0) if trained else expected
    assert np.allclose(got, expected)


@pytest.mark.parametrize("hidden", [(), (3,)])
def test_missing_input_gives_missing_prediction(spark, hidden):
    spec = FeatureSpec(("SVI",), ("y",))
    df = spark.createDataFrame([("0.5",), (None,), ("",)], "SVI string")
    out = predict(Model.new(spec, Network.of(spec, hidden)), df).collect()
    assert [r["predicted y"] is None for r in out] == [False, True, True]


def test_metrics(rows):
    df = rows("y double, p double, z double, q double", [(1.0, 2.0, 0.0, 3.0), (1.0, 0.0, 0.0, 4.0), (None, 1.0, 0.0, 0.0)])
    out = {r["output"]: r for r in residual_metrics(df, [("y", "p"), ("z", "q")]).collect()}
    assert (out["y"]["n"], out["y"]["sse"], out["y"]["mse"], out["y"]["rmse"]) == (2, 1.0, 1.0, 1.0)
    assert out["y"]["abs_mean_residual"] == 0.0
    assert out["z"]["rmse"] == pytest.approx(np.sqrt(25 / 3)) and out["z"]["abs_mean_residual"] == pytest.approx(7 / 3)
    assert out[OVERALL]["n"] == 5 and out[OVERALL]["rmse"] == pytest.approx(np.sqrt(27 / 5))
    assert out[OVERALL]["abs_mean_residual"] == pytest.approx(7 / 5)


def test_split_is_by_key(table):
    train_rows, test_rows = hash_split(table)
    keys = [{r[KEY] for r in df.collect()} for df in (train_rows, test_rows)]
    assert not keys[0] & keys[1] and len(keys[0] | keys[1]) == N
    assert 0.6 < len(keys[0]) / N < 0.95
    again = hash_split(table.repartition(7).where("SVI > 0.5"))[0]
    assert {r[KEY] for r in again.collect()} <= keys[0]
    assert {r[KEY] for r in hash_split(table, seed=1)[0].collect()} != keys[0]
    assert sum(df.count() for df in random_split(table)) == N


def test_sweep_equals_separate_runs(table, spec, data):
    parts = hash_split(table)
    out = {
        (r["epochs"], r["hidden"], r["activation"]): r
        for r in sweep(*parts, spec, (1, 3), ((), (2,)), ("tanh", "sig"), 0.1, seed=8).collect()
    }
    assert len(out) == 8
    model = train(Model.new(spec, Network.of(spec, (2,), "sig"), 8), parts[0], 3)
    for part, name in zip(parts, ("train", "test"), strict=True):
        errors = evaluate(model, part).where(F.col("output") == OVERALL).first()
        row = out[3, "[2]", "sig"]
        assert row[f"rmse_{name}"] == pytest.approx(errors["rmse"])
        assert row[f"abs_mean_residual_{name}"] == pytest.approx(errors["abs_mean_residual"])


def test_linear_output_fits_beyond_one_deviation(table, spec):
    rows = table.select(KEY, "SVI", (F.col("SVI") * 3 + 2).alias("y"))
    one = FeatureSpec.of(rows)
    errors = []
    for output in (None, "identity"):
        model = train(Model.new(one, Network.of(one, (), "tanh", output)), rows, 60, 0.3)
        errors.append(evaluate(model, rows).first()["rmse"])
    assert errors[1] < 1e-3 < errors[0]


def test_train_and_evaluate_on_merged(spark, table, tmp_path):
    merged = table.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in table.columns])
    model = train_on_merged(merged, epochs=2, seed=1)
    assert model.network.hidden == () and model.spec.inputs == ("SVI",)
    save_model(spark, model, str(tmp_path / "m"))
    errors = evaluate_on_merged(load_model(spark, str(tmp_path / "m")), merged)
    assert errors.count() == 10
    n = {(r["part"], r["output"]): r["n"] for r in errors.collect()}
    assert n["train", "a"] + n["test", "a"] == N


def compilations(spark):
    return spark._jvm.org.apache.spark.metrics.source.CodegenMetrics.METRIC_COMPILATION_TIME().getCount()


@pytest.mark.parametrize("hidden", [(), (3, 2)])
def test_no_code_is_compiled_after_the_second_epoch(spark, hidden):
    rows = spark.range(500).selectExpr("rand(1) AS weights", "rand(2) AS b", "rand(3) AS t", "rand(4) AS u")
    spec = FeatureSpec(("weights", "b"), ("t", "u"))
    seen = []
    train(Model.new(spec, Network.of(spec, hidden), 3), rows, 5, 0.1, after_epoch=lambda epoch, model: seen.append(compilations(spark)))
    assert seen[1] == seen[-1]
