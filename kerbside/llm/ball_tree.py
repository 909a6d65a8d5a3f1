"""Exact top-k by inner product: a ball tree per shard, searched by branch and bound.

Rows are dealt into shards by hash. A task builds the ball tree of a shard once, over its distinct vectors, and
the trees are kept in a table. A node cannot hold a score above ``query . centre + |query| * radius``; nodes
are taken by that bound, highest first, until it falls below the query's current k-th score. That score is shared:
queries visit the shards in waves, and the k-th score of all shards seen so far goes with them into the next wave.
Queries stream through a shard's tree; a task holds one tree and one batch of queries.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbside.llm.common import limit_batches, pick, stored
from kerbside.llm.simplex_clusters import whole

K = 10
SCALE = 1024
#: With smaller scaled components, inner products stay in 64 bits; a shard or query with others counts in Python integers.
LIMIT = 1 << 24
#: Rows of a shard, about; at least ``SHARDS`` shards, so that small tables spread too.
SHARD_ROWS, SHARDS = 8192, 32
#: Shards that a query visits in the first waves; the last wave takes all others.
WAVES = (1, 3, 12)
LEAF = 32
#: Scores are compared exactly up to so many digits, and as equal beyond.
DIGITS = 38
LONG = (1 << 63) - 1

FOUND = f"query long, row long, vec_id long, score long, beyond decimal({DIGITS},0)"


class BallTree:
    """Distinct integer vectors, each with its ``keep`` first rows, by id and number."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, vectors: np.ndarray, keep: int):
        order = np.lexsort((rows, ids, *vectors.T[::-1]))
        ids, rows, vectors = ids[order], rows[order], vectors[order]
        new = np.ones(len(ids), bool)
        new[1:] = (vectors[1:] != vectors[:-1]).any(axis=1)
        first = np.flatnonzero(new)
        self.vectors = vectors[first]
        # Rows with equal vectors tie, and ties go to smaller ids: more than ``keep`` can never be asked for.
        ends = [min(b, a + keep) for a, b in zip(first, [*first[1:], len(ids)])]
        self.held = [list(zip(ids[a:b].tolist(), rows[a:b].tolist())) for a, b in zip(first, ends)]
        self.floats = as_doubles(self.vectors)
        #: Leaves that searches have opened, to see what the bound saves.
        self.opened = 0
        self.nodes: list[tuple] = []
        self.root = self._build(np.arange(len(first)))

    def _build(self, rows: np.ndarray) -> int:
        """Split at the median along the line between two far points; the depth is logarithmic."""
        points = self.floats[rows]
        centre = points.mean(axis=0)
        apart = np.sqrt(((points - centre) ** 2).sum(axis=1))
        # Rounding must not make a bound too small.
        radius = apart.max() * (1 + 1e-9) + 1e-6
        if len(rows) <= LEAF:
            self.nodes.append((centre, radius, rows, None))
            return len(self.nodes) - 1
        one = points[apart.argmax()]
        two = points[((points - one) ** 2).sum(axis=1).argmax()]
        along = np.argsort(points @ (one - two), kind="stable")
        half = len(rows) // 2
        children = self._build(rows[along[:half]]), self._build(rows[along[half:]])
        self.nodes.append((centre, radius, None, children))
        return len(self.nodes) - 1

    def _bound(self, query: np.ndarray, length: float, node: int) -> float:
        centre, radius = self.nodes[node][:2]
        with np.errstate(over="ignore", invalid="ignore"):
            bound = float(query @ centre) + length * radius
        # What cannot be computed leaves nothing out.
        return np.inf if np.isnan(bound) else bound

    def search(self, row: int, query: np.ndarray, k: int, least: int | None) -> list[tuple[int, int, int]]:
        """The best (score, -id, -row) of rows other than ``row``, best first; none below ``least``."""
        asked = as_doubles(query)
        with np.errstate(over="ignore", invalid="ignore"):
            length = float(np.sqrt(asked @ asked))
            slack = 1e-6 + 1e-12 * length * float(np.abs(self.floats).max(initial=0)) * len(asked)
        best: list[tuple[int, int, int]] = []
        open_ = [(-self._bound(asked, length, self.root), self.root)]
        while open_:
            bound, node = heapq.heappop(open_)
            floor = best[0][0] if len(best) == k else least
            if floor is not None and -bound + slack < floor:
                break
            _, _, rows, children = self.nodes[node]
            if children:
                for child in children:
                    heapq.heappush(open_, (-self._bound(asked, length, child), child))
                continue
            self.opened += 1
            scores = self.vectors[rows] @ query
            for at in np.argsort(-scores, kind="stable").tolist():
                score = int(scores[at])
                floor = best[0][0] if len(best) == k else least
                if floor is not None and score < floor:
                    break
                for vec_id, other in self.held[rows[at]]:
                    if other == row:
                        continue
                    found = (score, -vec_id, -other)
                    if len(best) < k:
                        heapq.heappush(best, found)
                    elif found > best[0]:
                        heapq.heapreplace(best, found)
        return sorted(best, reverse=True)


def as_doubles(values: np.ndarray) -> np.ndarray:
    """Integers as doubles; those that no double can hold as infinite."""
    if values.dtype != object:
        return values.astype(np.float64)
    flat = [float(x) if abs(x) < 1 << 1023 else np.inf if x > 0 else -np.inf for x in values.ravel().tolist()]
    return np.array(flat, np.float64).reshape(values.shape)


def _matrix(vectors: pa.Array, width: int, scale: int) -> np.ndarray:
    """One row of integers per vector; shorter ones are filled up with zeros."""
    sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
    floats = np.zeros((len(vectors), width), np.float64)
    floats[np.arange(width) < sizes[:, None]] = vectors.flatten().to_numpy(zero_copy_only=False)
    return whole(floats, scale, LIMIT)


def usable(vector: Column) -> Column:
    """Vectors that take part."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return vector.isNotNull() & finite


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    """Rows come sorted by shard, the first column; one shard is held at a time."""
    shard, held = None, []
    for batch in batches:
        shards = batch.column(0).to_numpy()
        limits = [0, *(np.flatnonzero(np.diff(shards)) + 1).tolist(), len(shards)]
        for a, b in zip(limits[:-1], limits[1:]):
            if b > a:
                if shards[a] != shard and held:
                    yield shard, pa.Table.from_batches(held)
                    held = []
                shard = int(shards[a])
                held.append(batch.slice(a, b - a))
    if held:
        yield shard, pa.Table.from_batches(held)


def _build(width: int, scale: int, keep: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, rows in _grouped(batches):
            rows = rows.combine_chunks()
            ids, numbers = (rows.column(at).to_numpy() for at in (1, 2))
            tree = BallTree(ids, numbers, _matrix(rows.column(3).combine_chunks(), width, scale), keep)
            columns = [pa.array([shard], pa.int64()), pa.array([pickle.dumps(tree)], pa.binary())]
            yield pa.record_batch(columns, names=["shard", "tree"])

    return run


def _search(width: int, scale: int, k: int):
    """(shard, tree) rows with the shard's queries behind each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, tree = None, None
        for batch in batches:
            shards, trees, queries = batch.column(0).to_numpy(), batch.column(1), batch.column(2).to_pylist()
            floors, beyond = batch.column(4).to_pylist(), batch.column(5).to_pylist()
            asked = _matrix(batch.column(3), width, scale)
            found: list[tuple] = []
            for at, query in enumerate(queries):
                if query is None:
                    held, tree = shards[at], pickle.loads(trees[at].as_buffer())  # written by ``_build``
                elif held == shards[at]:
                    floor = floors[at] if beyond[at] is None else int(beyond[at])
                    found += ((query, -row, -minus, score) for score, minus, row in tree.search(query, asked[at], k, floor))
            yield _rows(found)

    return run


def _rows(found: list[tuple]) -> pa.RecordBatch:
    query, row, vec_id, score = zip(*found) if found else ((),) * 4
    top = 10**DIGITS - 1
    beyond = [Decimal(max(-top, min(top, x))) if abs(x) > LONG else None for x in score]
    columns = [pa.array(one, pa.int64()) for one in (query, row, vec_id, [max(-LONG, min(LONG, x)) for x in score])]
    return pa.record_batch([*columns, pa.array(beyond, pa.decimal128(DIGITS, 0))], names=["query", "row", "vec_id", "score", "beyond"])


def top_k(
    rows: DataFrame,
    k: int = K,
    every: int = 100,
    scale: int = SCALE,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best other rows of every query, ties to smaller ids.

    Queries are the rows whose id is divisible by ``every``; components are floor(scale * x). Fewer
    than ``k`` other rows give fewer results.

    Vectors that are null or hold a null, NaN or infinite component take no part, nor do rows with a
    null id. Shorter vectors count as filled up with zeros, so an empty one scores 0. Rows that repeat an id or
    a vector are rows of their own: each is a candidate for all others, and a query if its id asks for it. Integers
    are exact at any size; scores beyond a long are ranked by up to 38 digits and shown as the largest or smallest
    long. An empty table gives no rows. Other columns are not looked at.
    """
    limit_batches(rows.sparkSession)
    whole_rows = pick(rows, vec_id=vec_id, vector=embedding).where(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    whole_rows = whole_rows.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long"), "vector")
    # Written once: from here on a row keeps its number.
    whole_rows = stored(whole_rows, "vectors")
    size = whole_rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("width")).first()
    shards, width = max(SHARDS, -(-size.n // SHARD_ROWS)), size.width or 0
    dealt = whole_rows.select(F.pmod(F.xxhash64("row"), F.lit(shards)).alias("shard"), "vec_id", "row", F.col("vector").cast("array<double>"))
    dealt = dealt.repartition("shard").sortWithinPartitions("shard")
    trees = stored(dealt.mapInArrow(_build(width, scale, k + 1), "shard long, tree binary"), "trees")
    asked = whole_rows.where(F.col("vec_id") % every == 0)
    asked = asked.select(F.col("row").alias("query"), F.col("vec_id").alias("query_id"), F.col("vector").cast("array<double>").alias("asked"))
    order = Window.partitionBy("query").orderBy(F.coalesce("beyond", F.col("score").cast(f"decimal({DIGITS},0)")).desc(), "vec_id", "row")

    def best(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    found, begin = None, 0
    for end in [*(end for end in np.cumsum(WAVES).tolist() if end < shards), shards]:
        # A query starts at a shard of its own and goes round.
        start = F.pmod(F.xxhash64("query", F.lit(1)), F.lit(shards))
        visits = F.transform(F.sequence(F.lit(begin), F.lit(end - 1)), lambda at: F.pmod(start + at, F.lit(shards)))
        queries = asked.select("query", "asked", F.explode(visits).alias("shard"))
        none = F.lit(None)
        if found is None:
            queries = queries.select("*", none.cast("long").alias("floor"), none.cast(f"decimal({DIGITS},0)").alias("floor_beyond"))
        else:
            last = found.where(F.col("rank") == k).select("query", F.col("score").alias("floor"), F.col("beyond").alias("floor_beyond"))
            queries = queries.join(last, "query", "left")
        queries = queries.select("shard", none.cast("binary").alias("tree"), "query", "asked", "floor", "floor_beyond")
        with_trees = trees.select(
            "shard", "tree", none.cast("long").alias("query"), F.array().cast("array<double>").alias("asked"),
            none.cast("long").alias("floor"), none.cast(f"decimal({DIGITS},0)").alias("floor_beyond"),
        ).unionByName(queries)
        # Nulls first: the tree comes ahead of its queries.
        visited = with_trees.repartition("shard").sortWithinPartitions("shard", "query")
        new = visited.mapInArrow(_search(width, scale, k), FOUND)
        found = best(new if found is None else found.drop("rank").unionByName(new))
        found, begin = stored(found, "best"), end
    named = found.join(asked.select("query", "query_id"), "query")
    return named.select("query_id", "rank", "vec_id", "score")
