import random

import pytest

from tableflow.llm.graph import components
from tests.llm.helpers import Union


def _roots(spark, edges):
    return {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}


@pytest.mark.parametrize("edges", [
    [(k, k + 1) for k in range(60)], [(0, k) for k in range(1, 80)], [(99, k) for k in range(40)],
    [(k, (k * 7) % 61) for k in range(61)], [(5, 5)], [(1, 2), (2, 1), (1, 2)], [(-3, 4), (4, 9), (10, 11)], []])
def test_shapes(spark, edges):
    union = Union()
    for a, b in edges:
        if a != b:
            union.join(a, b)
    assert _roots(spark, edges) == {x: union.find(x) for x in list(union.parent)}


def test_random_graph(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(500), rng.randrange(500)) for _ in range(330)]
    union = Union()
    for a, b in edges:
        if a != b:
            union.join(a, b)
    assert _roots(spark, edges) == {x: union.find(x) for x in list(union.parent)}
