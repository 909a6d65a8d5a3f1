import random

import pytest

from kerbside.llm.components import components
from tests.llm.helpers import union_find


@pytest.mark.parametrize("nodes, edges", [(60, 40), (200, 260), (50, 49)])
def test_random_graphs(spark, nodes, edges):
    rng = random.Random(nodes)
    links = [(rng.randrange(nodes), rng.randrange(nodes)) for _ in range(edges)]
    if edges == nodes - 1:
        links = [(at, at + 1) for at in range(edges)]  # one long path
    got = {row.node: row.component for row in components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    touched = {node for link in links for node in link}
    assert got == {node: root for node, root in union_find(touched, links).items()}


def test_text_nodes_loops_nulls_and_repeats(spark):
    links = [("b", "a"), ("b", "a"), ("c", "c"), (None, "a"), ("d", None), ("e", "b"), ("a", "a")]
    got = {row.node: row.component for row in components(spark.createDataFrame(links, "x string, y string"), "x", "y").collect()}
    assert got == {"a": "a", "b": "a", "e": "a", "c": "c"}


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "x long, y long"), "x", "y").count() == 0
