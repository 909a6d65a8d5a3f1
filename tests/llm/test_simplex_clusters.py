import hashlib
import math

import numpy as np
import pytest

from kerbside.llm.queries import op11_centroids
from kerbside.llm.simplex_clusters import Simplex, cluster, nearest, possible, whole
from tests.llm.helpers import MIDDLE


def brute(rows, dimensions=64, clusters=40, rounds=5, scale=256):
    def usable(vector):
        return vector is not None and len(vector) == dimensions and all(x is not None and math.isfinite(x) for x in vector)

    def floor(x):
        y = x * scale
        return math.floor(y) if math.isfinite(y) else int(x) * scale

    kept = [(vec_id, [floor(x) for x in vector]) for vec_id, vector in rows if usable(vector)]
    starts = sorted((hashlib.sha256(f"2:{vec_id}".encode()).hexdigest(), q) for vec_id, q in kept if vec_id is not None)
    centroids = [q for _, q in starts[:clusters]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(q, c)), at) for at, c in enumerate(centroids)) for _, q in kept]

    for _ in range(rounds):
        members = [[] for _ in centroids]
        for (_, q), (_, at) in zip(kept, assign()):
            members[at].append(q)
        centroids = [[sum(x) // len(m) for x in zip(*m)] if m else c for m, c in zip(members, centroids)]
    found = assign() if centroids else []
    top = 2**63 - 1
    inertia = [0] * len(centroids)
    for distance, at in found:
        inertia[at] += min(distance, top)
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    total = min(sum(inertia), top)
    out = [
        (vec_id, at, min(distance, top), min(inertia[at], top), total, digests[at])
        for (vec_id, _), (distance, at) in zip(kept, found)
    ]
    return sorted(out, key=str)


def write(spark, tmp_path, rows, kind="float"):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")
    df = df.selectExpr("*", "1 as cluster", "2 as distance", "'x' as apex")
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    return sorted((tuple(row) for row in op11_centroids(spark, str(tmp_path)).collect()), key=str)


def test_table_against_brute_force(spark):
    rows = [(row.vec_id, row.embedding) for row in spark.read.parquet(f"{MIDDLE}/embeddings.parquet").collect()]
    assert sorted((tuple(row) for row in op11_centroids(spark, MIDDLE).collect()), key=str) == brute(rows)


def test_edges(spark, tmp_path):
    rng = np.random.default_rng(5)
    vectors = [(rng.integers(-3, 4, 64) / 256).tolist() for _ in range(60)]
    odd = [None, [], [1.0] * 63, [1.0] * 65, [float("nan")] + [0.0] * 63, [float("inf")] + [0.0] * 63, [None] + [0.0] * 63]
    rows = list(enumerate(vectors * 3 + odd)) + [(None, vectors[0]), (0, vectors[1]), (0, vectors[0]), (7, vectors[7])]
    assert write(spark, tmp_path, rows) == brute(rows)


def test_fewer_rows_than_clusters_and_equal_rows(spark, tmp_path):
    rows = [(at, [float(at // 3)] * 64) for at in range(9)]
    assert write(spark, tmp_path, rows) == brute(rows)


@pytest.mark.parametrize("kind", ["float", "double"])
def test_large_components_are_exact(spark, tmp_path, kind):
    top = 3e38 if kind == "float" else 1.7e308
    large = [(1000 + at, [float(2.0 ** (3 * at + 5))] * 32 + [-float(at)] * 32) for at in range(30)]
    rows = [(at, [at / 7] * 64) for at in range(60)] + large + [(5000, [top] * 64), (5001, [-top] * 64)]
    rows = [(vec_id, [float(np.float32(x)) if kind == "float" else x for x in vector]) for vec_id, vector in rows]
    assert write(spark, tmp_path, rows, kind) == brute(rows)


def test_empty_table(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assigned, centroids = cluster(none)
    assert assigned.count() == 0 and centroids.count() == 0


@pytest.mark.parametrize("kind", ["spread", "grouped", "flat", "equal", "shifted"])
def test_bounds_keep_the_nearest_and_leave_others_out(kind):
    rng = np.random.default_rng(11)
    centres = rng.normal(0, 300, (10, 64))
    points = {
        "spread": rng.normal(0, 100, (2000, 64)),
        "grouped": centres[rng.integers(0, 10, 2000)] + rng.normal(0, 20, (2000, 64)),
        "flat": rng.normal(0, 100, (2000, 2)) @ rng.normal(0, 1, (2, 64)),
        "equal": np.full((2000, 64), 3.0),
        "shifted": rng.normal(1e6, 5, (2000, 64)),
    }[kind]
    vectors = whole(points / 256, 256)
    centroids = vectors[:40] + rng.integers(-2, 3, (40, 64))
    simplex = Simplex(vectors[:40].astype(float))
    allowed = possible(simplex.apexes(vectors.astype(float)), simplex.apexes(centroids.astype(float)))
    got = nearest(vectors, centroids, allowed)
    want = nearest(vectors, centroids, np.ones_like(allowed))
    assert (got[0] == want[0]).all() and (got[1] == want[1]).all()
    if kind in ("grouped", "flat"):
        assert allowed.mean() < 0.25
