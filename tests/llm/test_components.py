import random

from areastats.llm.components import connected_components
from brute import components


def test_against_union_find(spark):
    random.seed(5)
    edges = [(random.randrange(300), random.randrange(300)) for _ in range(180)]
    edges += [(i, i + 1) for i in range(1000, 1040)] + [(2000, i) for i in range(2001, 2100)] + [(7, 7)]
    pairs = {frozenset(e) for e in edges}
    nodes = {i for a, b in edges if a != b for i in (a, b)}
    out = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.id: r.component for r in out} == components(nodes, lambda i, j: frozenset((i, j)) in pairs)
    assert len(out) == len(nodes)
    assert connected_components(spark.createDataFrame([(1, 1)], "a long, b long")).collect() == []
