import math

import numpy as np
import pytest

from kerbside.llm.ball_tree import BallTree, top_k
from tests.llm.helpers import SMALL


def brute(rows, k=10, every=100):
    """Every row but the query's own is a candidate, also rows of the same id."""
    usable = []
    for vec_id, vector in rows:
        if vec_id is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            usable.append((vec_id, [math.floor(1024 * x) for x in vector]))
    out = []
    for at, (query_id, query) in enumerate(usable):
        if query_id % every == 0:
            scores = [
                (-sum(a * b for a, b in zip(query, vector)), vec_id)
                for other, (vec_id, vector) in enumerate(usable)
                if other != at
            ]
            top = 2**63 - 1
            ranked = enumerate(sorted(scores)[:k], 1)
            out += [(query_id, rank, vec_id, max(-top, min(top, -minus))) for rank, (minus, vec_id) in ranked]
    return sorted(out)


def test_table_against_brute_force(spark):
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    got = sorted(tuple(row) for row in top_k(rows, every=10).collect())
    assert got == brute([(row.vec_id, row.embedding) for row in rows.collect()], every=10)


def test_edges(spark):
    vectors = [[1.0, 0.5], [1.0, 0.5], None, [float("nan"), 1.0], [None, 1.0], [float("inf"), 0.0], [], [2.0], [-1.0, 3.0, 4.0]]
    rows = list(enumerate(vectors)) + [(100, [1.0, 1.0]), (200, [0.0]), (None, [9.0]), (1, [1.0, 0.5]), (300, [1.0, 1.0])]
    rows += [(1000 + at, [1.0, 1.0]) for at in range(1, 40)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    table = table.selectExpr("*", "1 as VEC_ID", "2 as shard", "3 as vector")
    got = sorted(tuple(row) for row in top_k(table).collect())
    assert got == brute(rows)
    assert top_k(table.limit(0)).count() == 0


def test_large_components_are_exact(spark):
    """Beyond 16384, where scaled components leave 2^24; and scores that no long holds."""
    rows = [(100, [1.0, 0.5]), (1, [20000.0, 0.0]), (2, [30000.0, 1.0]), (3, [30000.0, 1.0 + 2**-10]), (200, [-20000.0, 3.0])]
    rows += [(10 + at, [2.0**at, -(3.0**at)]) for at in range(45)] + [(300, [2.0**40, 2.0**41]), (100, [1.0, 0.25]), (100, [1.0, 0.5])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(tuple(row) for row in top_k(table).collect()) == brute(rows)


def test_bounds_prune():
    """Grouped vectors: a search with a known k-th score opens few leaves."""
    rng = np.random.default_rng(8)
    centres = rng.normal(0, 300, (40, 16))
    vectors = (centres[rng.integers(0, 40, 8000)] + rng.normal(0, 10, (8000, 16))).astype(np.int64)
    tree = BallTree(np.arange(8000), np.arange(8000), vectors, 11)
    leaves = sum(children is None for *_, children in tree.nodes)
    for at in range(50):
        tree.search(at, vectors[at], 10, None)
    assert tree.opened / 50 < leaves / 4


@pytest.mark.parametrize("kind", ["spread", "equal", "line"])
def test_bound_is_never_too_small(kind):
    rng = np.random.default_rng(3)
    vectors = {
        "spread": rng.integers(-2000, 2000, (500, 8)),
        "equal": np.full((500, 8), 7),
        "line": np.arange(500)[:, None] * np.ones((1, 8), int),
    }[kind]
    tree = BallTree(np.arange(500), np.arange(500), vectors.astype(np.int64), 11)
    for query_id in (0, 100, 499):
        scores = sorted(((int(vectors[at] @ vectors[query_id]), -at, -at) for at in range(500) if at != query_id), reverse=True)
        assert tree.search(query_id, vectors[query_id].astype(np.int64), 10, None) == scores[:10]
        assert tree.search(query_id, vectors[query_id].astype(np.int64), 10, scores[9][0]) == scores[:10]
