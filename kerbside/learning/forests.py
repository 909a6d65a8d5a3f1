"""Forests whose trees are grown side by side, each in one task, over rows that fit in a task's memory.

Spark's own forests send figures of every node and feature from every task in each pass, which for deep trees takes many
times as long as the rows themselves.
"""

from __future__ import annotations

import json
import time
from collections import defaultdict
from collections.abc import Iterator, Sequence
from contextlib import nullcontext
from itertools import pairwise
from threading import Lock

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressionModel, RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.learning.trees import KINDS, Layout, Rules, Tree, bundles, grow, predictions, thresholds, tried_features
from kerbside.session import scratch_path, stored

# Codes and labels of one set of rows are held by each Python worker, and once by the driver.
LOCAL_BYTES = 256 << 20
# Trees whose predictions a task adds up before they are shuffled.
TREES_PER_TASK = 10
# Spark's default; a forest with another number of bins is fitted by Spark.
MAX_BINS = 32
# Rows whose predictions are added up together.
BLOCK = 1 << 16
#: Parameters that the trees follow; a forest with any other one is fitted by Spark.
RULED = {"numTrees", "maxDepth", "minInstancesPerNode", "minInfoGain", "featureSubsetStrategy", "subsamplingRate", "bootstrap"}
NEUTRAL = {"featuresCol", "labelCol", "predictionCol", "seed", "cacheNodeIds", "checkpointInterval", "maxMemoryInMB"}

_TREES = ", ".join(["number int", *(f"{name} binary" for name in KINDS)])
_LARGE = Lock()
_CODED = "wide binary, bits binary, label binary"
_NODES = """treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>,
    rawCount: bigint, gain: double, leftChild: int, rightChild: int,
    split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>>"""


class Codes:
    """Rows with a vector and a label, and rows held out, as codes of the vectors' bins, handed to the executors.

    Their order depends on the rows' values only, so that bags do not follow partitions. ``release`` takes the codes
    back from the executors.
    """

    @classmethod
    def of(cls, rows: DataFrame, held_out: DataFrame | None = None, label: str = "label", seed: int = 0) -> Codes | None:
        """The codes, or none if they could take more than ``LOCAL_BYTES``."""
        parts = [df.select(vector_to_array("features").alias("vector"), F.col(label).cast("double").alias("label")) for df in (rows, held_out) if df is not None]
        counts = [df.count() for df in parts]
        if not counts[0]:
            raise ValueError("a forest needs rows")
        width = parts[0].select(F.size("vector")).first()[0]
        return cls(parts, counts, seed) if sum(counts) * (width + 8) <= LOCAL_BYTES else None

    def __init__(self, parts: Sequence[DataFrame], counts: Sequence[int], seed: int):
        self.spark, self.counts = parts[0].sparkSession, counts
        # As many rows as Spark looks at for its thresholds.
        wanted = max(MAX_BINS**2, 10_000)
        some = parts[0] if counts[0] <= wanted else parts[0].sample(wanted / counts[0], seed)
        values = some.select("vector").toArrow()["vector"].combine_chunks()
        sample = values.values.to_numpy(zero_copy_only=False).reshape(len(values), -1)
        limits = tuple(thresholds(sample[:, at], min(MAX_BINS, counts[0])) for at in range(sample.shape[1]))
        self.wide = [at for at, found in enumerate(limits) if len(found) > 1]
        self.binary = [at for at, found in enumerate(limits) if len(found) == 1]
        # The driver holds one large set at a time.
        large = sum(counts) * (sample.shape[1] + 8) > LOCAL_BYTES // 8
        with _LARGE if large else nullcontext():
            coded = [self._coded(df, limits) for df in parts]
            together = sum(self._together(bits) for _, bits, _ in coded) > 0
            members = bundles(together, self.binary, 255)
            self.layout = Layout(len(limits), limits, tuple([(at,) for at in self.wide] + members))
            ordered = []
            while coded:
                ordered.append(self._ordered(*coded.pop(0), members))
            self.shared = self.spark.sparkContext.broadcast((self.layout, *ordered))

    def release(self) -> None:
        self.shared.destroy()

    def _coded(self, df: DataFrame, limits: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        wide, binary = self.wide, self.binary

        def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                label = batch.column("label").to_numpy(zero_copy_only=False)
                if np.isnan(label).any():
                    raise ValueError("labels must not be null or NaN")
                values = batch.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(len(label), -1)
                if not np.isfinite(values).all():
                    raise ValueError("vectors must not hold NaN or infinity")
                codes = [np.searchsorted(limits[at], values[:, at]).astype(np.uint8) for at in wide]
                bits = np.packbits(values[:, binary] > [limits[at][0] for at in binary], axis=1)
                columns = (np.stack(codes, 1) if codes else np.empty((len(label), 0), np.uint8), bits, label)
                yield pa.RecordBatch.from_pydict({n: [c.tobytes()] for n, c in zip(("wide", "bits", "label"), columns)})

        found = df.mapInArrow(code, _CODED).toArrow()
        joined = [b"".join(found[name].to_pylist()) for name in ("wide", "bits", "label")]
        label = np.frombuffer(joined[2], np.float64)
        codes, bits = (np.frombuffer(part, np.uint8).reshape(len(label), -1) for part in joined[:2])
        return codes, bits, label

    def _unpacked(self, bits: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
        for at in range(0, len(bits), BLOCK):
            yield slice(at, at + BLOCK), np.unpackbits(bits[at : at + BLOCK], axis=1, count=len(self.binary))

    def _together(self, bits: np.ndarray) -> np.ndarray:
        """In how many rows two features are both above their thresholds."""
        out = np.zeros((len(self.binary),) * 2)
        for _, some in self._unpacked(bits):
            some = some.astype(np.float32)
            out += some.T @ some
        return out

    def _ordered(self, wide, bits, label, members) -> tuple[np.ndarray, np.ndarray]:
        codes = np.zeros((len(label), len(self.wide) + len(members)), np.uint8)
        codes[:, : len(self.wide)] = wide
        place = {feature: (column, at) for column, group in enumerate(members, len(self.wide)) for at, feature in enumerate(group, 1)}
        for rows, some in self._unpacked(bits):
            for at, feature in enumerate(self.binary):
                column, code = place[feature]
                codes[rows, column] += some[:, at] * np.uint8(code)
        # Rows of the same hash hold the same values, so that it does not matter which of them comes first.
        key = label.view(np.uint64).copy()
        for column in range(codes.shape[1]):
            key ^= codes[:, column]
            key *= np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
        order = np.argsort(key)
        return codes[order], label[order]


class InTasks:
    """Put before ``RandomForestRegressor``: with ``over`` trees are grown in tasks, from codes of the fitted rows."""

    codes: Codes | None = None

    def over(self, codes: Codes | None) -> InTasks:
        self.codes = codes
        return self

    def _fit(self, dataset: DataFrame):
        given = {param.name for param in self._paramMap}
        if self.codes is None or not given <= RULED | NEUTRAL:
            return super()._fit(dataset)
        return TaskForest(self, self.codes)


class TaskForest(RandomForestRegressionModel):
    """A forest as its parameters and the rows to grow it from: where trees are needed, tasks grow them.

    ``stored`` grows all of them into a table. Spark's own model, which holds them in the driver, is made from it when
    something of that model is first asked for, such as predictions.
    """

    def __init__(self, estimator: RandomForestRegressor, codes: Codes):
        self._model, self._table = None, None
        super().__init__()
        self._resetUid(estimator.uid)
        estimator._copyValues(self)
        self.codes = codes
        get = self.getOrDefault
        self.count = get("numTrees")
        self.rules = Rules(
            seed=get("seed"),
            depth=get("maxDepth"),
            tried=tried_features(get("featureSubsetStrategy"), self.count, codes.layout.features),
            least=get("minInstancesPerNode"),
            gain=get("minInfoGain"),
            rate=get("subsamplingRate"),
            replace=get("bootstrap"),
        )

    @property
    def _java_obj(self):
        if self._model is None and self.__dict__.get("codes") is not None:
            self._model = RandomForestRegressionModel.load(self._saved())
        return self._model._java_obj if self._model is not None else None

    @_java_obj.setter
    def _java_obj(self, value) -> None:
        if value is not None:
            self._model = RandomForestRegressionModel(value)

    @property
    def trees(self) -> list:
        """A plain property, so that a look at the parameters does not load the trees."""
        return [DecisionTreeRegressionModel(tree) for tree in self._call_java("trees")]

    def __del__(self) -> None:
        """The loaded model lets its own Java object go."""

    def stored(self) -> TaskForest:
        """Grow the trees into a table with a row for each."""
        if self._table is None:
            spark, rules, shared = self.codes.spark, self.rules, self.codes.shared

            def grown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                layout, (codes, labels), *_ = shared.value
                for batch in batches:
                    for number in batch.column(0).to_pylist():
                        (tree,) = grow(codes, labels, layout, [rules], number)
                        packed = {name: [value.tobytes()] for name, value in vars(tree).items()}
                        yield pa.RecordBatch.from_pydict({"number": pa.array([number], pa.int32()), **packed})

            # Few trees in a task, since nothing is added up.
            tasks = -(-self.count // 2)
            self._table = stored(spark.range(0, self.count, 1, tasks).mapInArrow(grown, _TREES), "trees")
        return self

    def _saved(self) -> str:
        """A new folder with the trees in the form of Spark's models."""
        folder, spark, layout = scratch_path(self.codes.spark, "forest"), self.codes.spark, self.codes.layout

        def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    number = row.pop("number")
                    tree = Tree(**{name: np.frombuffer(value, KINDS[name]) for name, value in row.items()})
                    yield from _nodes(tree, layout, number)

        self.stored()._table.mapInArrow(nodes, _NODES).write.parquet(f"{folder}/data")
        tree = {"class": "org.apache.spark.ml.regression.DecisionTreeRegressionModel"}
        of_forests = ("numTrees", "featureSubsetStrategy", "subsamplingRate", "bootstrap")
        about = [(at, self._about(tree | {"uid": f"{self.uid}_{at}"}, of_forests), 1.0) for at in range(self.count)]
        spark.createDataFrame(about, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{folder}/treesMetadata")
        forest = {"class": "org.apache.spark.ml.regression.RandomForestRegressionModel", "uid": self.uid}
        forest |= {"numFeatures": layout.features, "numTrees": self.count}
        spark.createDataFrame([(self._about(forest),)], "value string").coalesce(1).write.text(f"{folder}/metadata")
        return folder

    def _about(self, facts: dict, without: Sequence[str] = ()) -> str:
        maps = {"paramMap": self._paramMap, "defaultParamMap": self._defaultParamMap}
        named = {name: {p.name: v for p, v in found.items() if p.name not in without} for name, found in maps.items()}
        return json.dumps(facts | named | {"timestamp": int(time.time() * 1000), "sparkVersion": self.codes.spark.version})


def _nodes(tree: Tree, layout: Layout, number: int, most: int = 10_000) -> Iterator[pa.RecordBatch]:
    """A tree's nodes as rows of Spark's models."""
    inner = tree.split >= 0
    splits = layout.splits()
    feature, at = (np.where(inner, np.append(splits[:, c], -1)[tree.split], -1) for c in (0, 2))
    limit = np.array([layout.thresholds[f][t] for f, t in zip(feature[inner], at[inner])], np.float64)
    total = tree.rows * tree.mean
    stats = np.stack([tree.rows, total, tree.rows * (tree.impurity + tree.mean**2)], 1)
    size = len(inner)
    lists = pa.ListArray.from_arrays(np.append(0, np.cumsum(inner)).astype(np.int32), limit)
    columns = {
        "id": np.arange(size, dtype=np.int32),
        "prediction": tree.mean,
        "impurity": tree.impurity,
        "impurityStats": pa.ListArray.from_arrays(np.arange(0, 3 * size + 1, 3, dtype=np.int32), stats.ravel()),
        "rawCount": tree.rows.astype(np.int64),
        "gain": tree.gain,
        "leftChild": np.where(inner, tree.left, -1).astype(np.int32),
        "rightChild": np.where(inner, tree.left + 1, -1).astype(np.int32),
        "split": pa.StructArray.from_arrays(
            [pa.array(feature.astype(np.int32)), lists, pa.array(np.full(size, -1, np.int32))],
            ["featureIndex", "leftCategoriesOrThreshold", "numCategories"],
        ),
    }
    data = pa.StructArray.from_arrays([pa.array(c) if isinstance(c, np.ndarray) else c for c in columns.values()], list(columns))
    whole = pa.RecordBatch.from_arrays([pa.array(np.full(size, number, np.int32)), data], ["treeID", "nodeData"])
    for begin in range(0, size, most):
        yield whole.slice(begin, most)


def held_out_errors(models: Sequence[TaskForest], sizes: Sequence[int]) -> list[dict[int, float | None]]:
    """For each of the forests over the same codes the RMSE of its first n trees on the rows held out, for each n.

    Forests that draw alike are grown together: once to the largest depth, with predictions at each depth on the way,
    and in common down to where their rules part.
    """
    codes = models[0].codes
    rows = codes.counts[1]
    if not rows:
        return [dict.fromkeys(sizes) for _ in models]
    # The distinct trees, and those of one family by what else they differ in than depth.
    wanted = sorted({model.rules for model in models}, key=lambda rules: rules.depth)
    families: dict[Rules, dict[tuple, list[int]]] = defaultdict(lambda: defaultdict(list))
    for place, rules in enumerate(wanted):
        families[rules.draws][rules.least, rules.gain].append(place)
    grown = [list(family.values()) for family in families.values()]
    ends = sorted({0, *sizes, *range(0, max(sizes), TREES_PER_TASK)})
    units = [(places, begin, end) for places in grown for begin, end in pairwise(ends)]
    context, shared = codes.spark.sparkContext, codes.shared

    def scored(unit: tuple[list[list[int]], int, int]) -> Iterator[tuple]:
        layout, (inside, labels), (outside, _) = shared.value
        cuts, begin, end = unit
        sums = {place: np.zeros(len(outside)) for places in cuts for place in places}
        deepest = [wanted[places[-1]] for places in cuts]
        for number in range(begin, end):
            for places, tree in zip(cuts, grow(inside, labels, layout, deepest, number)):
                depths = [wanted[place].depth for place in places]
                for place, (_, found) in zip(places, predictions(tree, outside, layout, depths)):
                    sums[place] += found
        for place, total in sums.items():
            for row in range(0, len(total), BLOCK):
                yield (place, row), (end, total[row : row + BLOCK])

    def squares(item: tuple) -> list[tuple]:
        (place, row), parts = item
        truth, total, out = shared.value[2][1][row : row + BLOCK], 0.0, []
        for end, part in sorted(parts, key=lambda part: part[0]):
            total = total + part
            if end in sizes:
                out.append((place, end, row, float(np.square(total / end - truth).sum())))
        return out

    dealt = context.parallelize(units, len(units)).flatMap(scored).groupByKey(context.defaultParallelism)
    found = sorted(dealt.flatMap(squares).collect())
    error: dict[tuple[int, int], float] = defaultdict(float)
    for place, size, _, value in found:
        error[place, size] += value
    return [{n: (error[wanted.index(model.rules), n] / rows) ** 0.5 for n in sizes} for model in models]
