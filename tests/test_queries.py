"""Every registered query against its SQL on the small tables."""

from pathlib import Path

import pytest

import __spark_entry__ as contract
from areastats.queries import QUERIES, SQL
from check import difference, oracle

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    result = contract.entry(spark)
    assert result.columns[0] == "County-State" and result.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, name):
    result = QUERIES[name](spark, FOLDER).toPandas()
    assert len(result) > 0
    if name in SQL:
        assert difference(result, oracle(FOLDER, SQL[name])) is None


def test_the_whole_training_run_and_grid_are_among_the_queries(spark):
    shipped = QUERIES["train_shipped_run"](spark, FOLDER)
    assert "epoch < 150" in SQL["train_shipped_run"] and shipped.count() == 6
    grid = QUERIES["sweep_whole_grid"](spark, FOLDER).collect()
    assert len({(r.epochs, r.hidden, r.activation) for r in grid}) == len(grid) == 3 * 5 * 2
