"""What the physical plans must and must not contain."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from areastats.config import KEY
from areastats.model.gradient import gradient_sums
from areastats.model.network import Model, Network
from areastats.model.predict import predict
from areastats.model.spec import FeatureSpec
from areastats.operators.combine import join_all
from areastats.operators.measures import count_by_key
from areastats.plans.schools import site_counts
from areastats.queries import QUERIES
from areastats.queries.inputs import nation_facts
from areastats.sources.catalog import table_query
from areastats.sources.nested import SITE_SCHEMA, read_json
from areastats.sources.positional import read_positions

FOLDER = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


PYTHON = {"gradient_step_hidden", "predict_hidden"}
# Results of training are small tables that the driver makes from the weights.
TRAINING = {n for n in QUERIES if "train" in n} | {"model_roundtrip", "sweep", "sweep_whole_grid", "evaluate_model"}


@needs_tables
@pytest.mark.parametrize("name", sorted(set(QUERIES) - PYTHON - TRAINING))
def test_no_python_and_no_rdd_in_data_plans(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    assert not re.search("BatchEvalPython|ArrowEvalPython|MapInPandas|MapInArrow|ExistingRDD|CartesianProduct|NestedLoop", text)


@needs_tables
def test_filter_and_columns_reach_the_scan(spark):
    orders = spark.read.parquet(f"{FOLDER}/orders.parquet")
    text = plan(table_query(orders, F.col("o_orderstatus") == "F", ["o_custkey"], distinct=True))
    assert "EqualTo(o_orderstatus,F)" in text
    assert re.search(r"ReadSchema: struct<o_custkey:bigint,o_orderstatus:string>", text)


def test_deny_list_is_one_pushed_predicate(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b,c\n")
    df = read_positions(spark, str(tmp_path / "t.csv"), {"x": 0, "y": 2}).where(~F.col("x").isin("a", "b", ""))
    text = plan(df)
    assert "Not(In(_c0, [" in text and "ReadSchema: struct<_c0:string,_c2:string>" in text


def test_state_files_are_chosen_by_path(spark, tmp_path):
    for state in ("Alabama", "Ohio", "Utah"):
        (tmp_path / f"s.{state}.json").write_text('[{"properties": {"COUNTY": "x"}}]')
    df = read_json(spark, str(tmp_path), SITE_SCHEMA, states=["Ohio"])
    assert df.count() == 1
    node = df._jdf.queryExecution().executedPlan()
    df.collect()
    while not node.children().isEmpty():
        node = node.children().head()
    assert node.metrics().apply("numFiles").value() == 1


def keyed(spark, name):
    return count_by_key(spark.range(1000).selectExpr(f"CONCAT('k', id % 7) AS `{KEY}`"), name)


def test_joins_of_grouped_tables_add_no_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        text = plan(join_all([keyed(spark, n) for n in ("a", "b", "c")]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange hashpartitioning") == 3 and text.count("SortMergeJoin") == 2


def test_site_counts_are_one_aggregation(spark):
    rows = spark.range(100).selectExpr(f"CONCAT('k', id % 7) AS `{KEY}`", "'x' AS Name")
    raw = spark.range(100).selectExpr("CONCAT('k', id % 9) AS COUNTY", "'AL' AS STATE", "'x' AS NAME")
    text = plan(site_counts(rows, [rows], [raw], "Public"))
    assert text.count("Exchange") == 1 and "Join" not in text


def test_plain_network_stays_in_the_engine(spark):
    spec = FeatureSpec(("x",), ("y",))
    df = spark.range(10).selectExpr("CAST(id AS DOUBLE) AS x", "CAST(id AS DOUBLE) AS y")
    network = Network.of(spec, ())
    text = plan(gradient_sums(df, network, network.initial_weights()))
    assert "Python" not in text and "MapInArrow" not in text and text.count("Exchange") == 1
    assert "Python" not in plan(predict(Model.new(spec, network), df))


def test_only_inputs_go_to_python(spark):
    spec = FeatureSpec(("x",), ("y", "z"))
    df = spark.range(10).selectExpr("CAST(id AS DOUBLE) AS x", "'text' AS other")
    text = plan(predict(Model.new(spec, Network.of(spec, (2,))), df))
    assert text.count("ArrowEvalPython") == 1
    assert "other" not in re.search(r"ArrowEvalPython \[(.*?)\]", text).group(1)


@needs_tables
def test_merged_table_reads_each_fact_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        facts, merged = plan(nation_facts(spark, FOLDER)), plan(QUERIES["merged_table"](spark, FOLDER))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    tables = ("lineitem", "orders", "customer", "supplier", "nation", "region")
    assert [facts.count(f"{FOLDER}/{t}.parquet") for t in tables] == [1] * 6 and not any(f"/{t}.parquet" in merged for t in tables)
    assert facts.count("Exchange hashpartitioning") + merged.count("Exchange hashpartitioning") < 15
