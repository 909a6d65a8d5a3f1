"""Centroid clustering on integers, with n-simplex projection to leave centroids out.

A few pivots span a simplex. The distances of a vector to the pivots make it the apex of a simplex over
that base: its foot has coordinates in the base, its height is the last one. For two apexes the Euclidean
distance is at most that of the vectors, and with one height turned over it is at least that. So a
centroid whose lower bound lies above another one's upper bound cannot be the nearest; those that remain
are compared exactly, in integers. Apexes of vectors are computed once and kept beside the vectors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import limit_batches, pick, stored

CLUSTERS, ROUNDS, SCALE, DIMENSIONS, SEED = 40, 5, 256, 64, "2"
#: At most so many pivots, taken from the first centroids; each must rise above the base by this share of the first edge.
PIVOTS, RISE = 24, 0.1
#: Rounding of the bounds, as a share of the distances they come from.
SLACK = 1e-5
#: Differences of components below this are squared and summed in 64 bits; beyond, as Python integers.
LIMIT = 1 << 26
LONG = (1 << 63) - 1
LIMB = 60

_SUMS = "cluster int, place int, limb int, value long"


def _scaled(vectors: np.ndarray, scale: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.floor(vectors * float(scale))


def _as_doubles(values: np.ndarray) -> np.ndarray:
    """Integers as doubles; those that no double can hold as infinite."""
    if values.dtype != object:
        return values.astype(np.float64)
    rows = [[float(x) if abs(x) < 1 << 1023 else math.inf if x > 0 else -math.inf for x in row] for row in values.tolist()]
    return np.array(rows, np.float64)


def whole(vectors: np.ndarray, scale: int, limit: int = LIMIT) -> np.ndarray:
    """floor(scale * x), exactly: 64-bit integers, or Python integers where a component is large."""
    floats = _scaled(vectors, scale)
    if not floats.size or np.abs(floats).max() < limit:
        return floats.astype(np.int64)
    rows = [
        [int(y) if np.isfinite(y) else int(x) * scale for x, y in zip(*pair)]
        for pair in zip(vectors.tolist(), floats.tolist())
    ]
    return np.array(rows, dtype=object)


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of the rows of ``a`` to those of ``b``, as doubles."""
    with np.errstate(over="ignore", invalid="ignore"):
        out = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T)
        return np.where(out < 0, 0.0, out)


class Simplex:
    """The simplex of the pivots, by their distances to each other."""

    def __init__(self, points: np.ndarray, pivots: int = PIVOTS, rise: float = RISE):
        """Pivots are points: the first one, then always the one highest above those before."""
        inner = points - points[0]
        rest, chosen, rows = (inner * inner).sum(axis=1), [], []
        first = np.sqrt(rest.max(initial=0))
        while len(chosen) + 1 < pivots and np.sqrt(rest.max(initial=0)) > rise * first:
            at = int(rest.argmax())
            column = inner @ inner[at] - sum((row * row[at] for row in rows), np.zeros(len(points)))
            rows.append(column / np.sqrt(rest[at]))
            rest = np.maximum(rest - rows[-1] ** 2, 0)
            chosen.append(at)
        self.pivots = points[[0, *chosen]]
        self.edges = ((self.pivots[1:] - self.pivots[0]) ** 2).sum(axis=1)
        #: Lower triangular: row j has the coordinates of pivot j + 1, pivot 0 being the origin.
        self.base = np.array([[row[at] for row in rows] for at in chosen]).reshape(len(chosen), len(chosen))

    def apexes(self, vectors: np.ndarray) -> np.ndarray:
        """Coordinates of the foot, then the height."""
        squares = np.stack([((vectors - pivot) ** 2).sum(axis=1) for pivot in self.pivots], axis=1)
        feet = np.zeros((len(vectors), len(self.edges)))
        for at in range(len(self.edges)):
            # From |x - p0|^2 and |x - p(at + 1)|^2 by the law of cosines, then forward substitution.
            inner = (squares[:, 0] + self.edges[at] - squares[:, at + 1]) / 2
            feet[:, at] = (inner - feet[:, :at] @ self.base[at, :at]) / self.base[at, at]
        height = np.sqrt(np.maximum(squares[:, 0] - (feet * feet).sum(axis=1), 0))
        return np.concatenate((feet, height[:, None]), axis=1)


def possible(apexes: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """True where a centroid may be the nearest of a vector. What cannot be computed stays possible."""
    with np.errstate(over="ignore", invalid="ignore"):
        lower = _squares(apexes, centres)
        upper = np.sqrt(lower + 4 * apexes[:, -1:] * centres[None, :, -1])
        size = np.sqrt((apexes * apexes).sum(axis=1)) + np.sqrt((centres * centres).sum(axis=1).max())
        return ~(np.sqrt(lower) > (upper.min(axis=1) + SLACK * size)[:, None])


def nearest(vectors: np.ndarray, centroids: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of the nearest allowed centroid; ties go to the smaller number."""
    row, number = np.nonzero(allowed)
    exact = vectors.dtype == np.int64 and centroids.dtype == np.int64
    distance = np.zeros(len(row), np.int64 if exact else object)
    for at in range(0, len(row), 1 << 14):
        part = slice(at, at + (1 << 14))
        apart = vectors[row[part]] - centroids[number[part]]
        distance[part] = (apart * apart).sum(axis=1)
    first = np.searchsorted(row, np.arange(len(vectors)))
    least = np.minimum.reduceat(distance, first)
    at = np.flatnonzero(distance == least[row])
    at = at[np.searchsorted(row[at], np.arange(len(vectors)))]
    return number[at], distance[at]


def _doubles(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _limbs(value: int) -> Iterator[tuple[int, int]]:
    """The value in base 2^60; only the last limb has a sign."""
    limb = 0
    while not -(1 << LIMB) <= value < 1 << LIMB:
        yield limb, value & ((1 << LIMB) - 1)
        value, limb = value >> LIMB, limb + 1
    yield limb, value


def usable(vector: Column, dimensions: int = DIMENSIONS) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return vector.isNotNull() & (F.size(vector) == dimensions) & finite


def cluster(
    rows: DataFrame,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    dimensions: int = DIMENSIONS,
    seed: str = SEED,
    pivots: int = PIVOTS,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
) -> tuple[DataFrame, DataFrame]:
    """(vec_id, cluster, distance) per vector, and (cluster, centroid, n, inertia, total) per centroid.

    Components are floor(scale * x). The first centroids are the vectors with the smallest sha256 of
    ``seed:vec_id``; each round gives every vector to the nearest centroid (squared Euclidean distance,
    ties to the smaller number) and moves each centroid that has vectors to the floor of their mean.
    ``distance`` is to the last centroids; ``inertia`` sums it over a cluster and ``total`` over all;
    ``centroid`` lists the components as decimal text.

    Vectors of another length, null ones and those with a null, NaN or infinite component take no part. Rows
    that repeat an id or a vector are rows of their own; of equal ids the smaller vector starts first. A row
    with a null id is clustered but never starts a cluster. With fewer rows than clusters there are as many
    clusters as rows; an empty table gives no rows. Integers are exact at any size; distances and inertias
    beyond a long are shown as the largest long. Other columns are not looked at.

    What the driver holds is bounded by the parameters: centroids, and their sums in parts of 60 bits.
    """
    spark = rows.sparkSession
    kept = pick(rows, vec_id=vec_id, vector=embedding).where(usable(F.col("vector"), dimensions))
    limit_batches(spark)
    kind = kept.schema["vec_id"].dataType.simpleString()
    element = kept.schema["vector"].dataType.simpleString()
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    starts = kept.where("vec_id is not null").select(digest.alias("digest"), "vector")
    starts = [row.vector for row in starts.orderBy("digest", "vector").limit(clusters).collect()]
    floats = np.array(starts, np.float64).reshape(len(starts), dimensions)
    centroids = whole(floats, scale)
    if not starts:
        assigned = kept.limit(0).select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
        return assigned, _centroid_table(spark, centroids, {})
    with np.errstate(over="ignore", invalid="ignore"):
        simplex = Simplex(_scaled(floats, scale), pivots)

    def add_apexes(batches):
        for batch in batches:
            vectors = _scaled(_doubles(batch.column(1), dimensions), scale)
            with np.errstate(over="ignore", invalid="ignore"):
                apexes = simplex.apexes(vectors)
            limits = pa.array(np.arange(len(apexes) + 1) * apexes.shape[1], pa.int32())
            lists = pa.ListArray.from_arrays(limits, pa.array(apexes.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], ["vec_id", "vector", "apex"])

    kept = stored(kept.mapInArrow(add_apexes, f"vec_id {kind}, vector {element}, apex array<double>"), "apexes")

    def sums(centroids: np.ndarray):
        with np.errstate(over="ignore", invalid="ignore"):
            centres = simplex.apexes(_as_doubles(centroids))
        width = simplex.base.shape[0] + 1

        def run(batches):
            total = np.zeros((len(centroids), dimensions + 1), object)
            for batch in batches:
                vectors = whole(_doubles(batch.column(0), dimensions), scale)
                allowed = possible(_doubles(batch.column(1), width), centres)
                at = allowed.argmax(axis=1)
                several = np.flatnonzero(allowed.sum(axis=1) > 1)
                if len(several):
                    at[several] = nearest(vectors[several], centroids, allowed[several])[0]
                order = np.argsort(at, kind="stable")
                first = np.flatnonzero(np.diff(at[order], prepend=-1))
                total[at[order[first]], 1:] += np.add.reduceat(vectors[order], first, axis=0)
                total[:, 0] += np.bincount(at, minlength=len(centroids))
            places = [(int(c), int(p)) for c, p in zip(*np.nonzero(total))]
            out = [(c, p, *limb) for c, p in places for limb in _limbs(int(total[c, p]))]
            columns = zip(*out) if out else [[]] * 4
            types = (pa.int32(), pa.int32(), pa.int32(), pa.int64())
            arrays = [pa.array(one, kind) for one, kind in zip(columns, types)]
            yield pa.RecordBatch.from_arrays(arrays, ["cluster", "place", "limb", "value"])

        parts = kept.select("vector", "apex").mapInArrow(run, _SUMS)
        parts = parts.groupBy("cluster", "place", "limb").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
        total = np.zeros((len(centroids), dimensions + 1), object)
        for row in parts.collect():
            total[row.cluster, row.place] += int(row.value) << (LIMB * row.limb)
        return total

    for _ in range(rounds):
        total = sums(centroids)
        moved = [
            [int(value) // int(total[at, 0]) for value in total[at, 1:]] if total[at, 0] else [int(x) for x in centroids[at]]
            for at in range(len(centroids))
        ]
        large = max(abs(x) for row in moved for x in row) >= LIMIT
        centroids = np.array(moved, dtype=object if large else np.int64)

    with np.errstate(over="ignore", invalid="ignore"):
        centres = simplex.apexes(_as_doubles(centroids))

    def assign(batches):
        for batch in batches:
            vectors = whole(_doubles(batch.column(1), dimensions), scale)
            allowed = possible(_doubles(batch.column(2), centres.shape[1]), centres)
            number, distance = nearest(vectors, centroids, allowed)
            distance = np.minimum(distance, LONG).astype(np.int64)
            arrays = [batch.column(0), pa.array(number, pa.int32()), pa.array(distance, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["vec_id", "cluster", "distance"])

    assigned = stored(kept.mapInArrow(assign, f"vec_id {kind}, cluster int, distance long"), "clusters")
    inertia = assigned.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia")
    )
    return assigned, _centroid_table(spark, centroids, {row.cluster: (row.n, int(row.inertia)) for row in inertia.collect()})


def _centroid_table(spark, centroids: np.ndarray, found: dict[int, tuple[int, int]]) -> DataFrame:
    total = min(sum(inertia for _, inertia in found.values()), LONG)
    rows = []
    for at, centroid in enumerate(centroids):
        n, inertia = found.get(at, (0, 0))
        rows.append((at, [str(x) for x in centroid], n, min(inertia, LONG), total))
    return spark.createDataFrame(rows, "cluster int, centroid array<string>, n long, inertia long, total long")
