import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from areastats.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, partitions=4, memory="4g")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """``rows(schema, [tuples])`` makes a DataFrame."""
    return lambda schema, data: spark.createDataFrame(data, schema)


def collected(df):
    """Rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
