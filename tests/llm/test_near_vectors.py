import math

import numpy as np
import pytest

from areastats.llm.near_vectors import near_duplicates
from brute import components

SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], schema)


def unlike(v):
    return v is None or len(v) == 0 or any(x is None or not math.isfinite(x) for x in v) or not any(v)


def wanted(rows):
    unit = {}
    for i, v in rows:
        if not unlike(v):
            a = np.array(v, np.float32).astype(float)
            unit[i] = a / np.linalg.norm(a)
    test = lambda i, j: len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.95
    found = components(unit, test)
    return {
        i: (sum(i in unit and j != i and test(i, j) for j in unit), found.get(i, i)) for i, _ in rows
    }


@pytest.mark.parametrize("piece", [8192, 40])
def test_against_all_pairs(spark, piece):
    rng = np.random.default_rng(4)
    rows = []
    for center in rng.standard_normal((40, 24)):
        for _ in range(rng.integers(1, 9)):
            rows.append((center + rng.standard_normal(24) * rng.choice([0.05, 0.2, 0.3])).tolist())
    rows += [rows[0]] * 30 + [(np.array(rows[1]) * 1e-30).tolist()]
    rows += [None, [], [0.0] * 24, [float("nan")] + [1.0] * 23, [float("inf")] * 24, [None] + [1.0] * 23, [1.0, 2.0]]
    rows = list(zip(rng.permutation(5000)[: len(rows)].tolist(), rows, strict=True))
    out = near_duplicates(vectors(spark, rows), piece=piece).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in out} == wanted(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in out) and len(out) == len(rows)


def test_few_dimensions_doubles_and_empty_tables(spark):
    rows = [(1, [1.0]), (2, [2.0]), (3, [-1.0]), (None, [1.0])]
    out = near_duplicates(vectors(spark, rows, "vec_id long, embedding array<double>, label int")).collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in out} == {
        1: (1, 1, True), 2: (1, 1, False), 3: (0, 3, True), None: (0, None, True)
    }
    assert near_duplicates(vectors(spark, [])).collect() == []
    assert near_duplicates(vectors(spark, [(1, None)])).collect()[0].component_id == 1
