"""Training, tuning and scoring of the fare, cancellation, segment and demand models."""

from __future__ import annotations

import logging
from collections import defaultdict
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from functools import reduce
from itertools import product
from math import ceil
from multiprocessing.pool import ThreadPool
from operator import add

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.errors import AnalysisException, IllegalArgumentException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.regression import (
    GBTRegressor,
    LinearRegression,
    RandomForestRegressionModel,
    RandomForestRegressor,
)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.functions.scalars import split
from kerbside.learning.features import (
    CATEGORIES,
    DEMAND_NUMBERS,
    FEATURE_COLUMNS,
    NUMBERS,
    SEGMENT_NUMBERS,
    demand_input,
    features,
    prob_of,
    segment_input,
)
from kerbside.learning.forests import Codes, InTasks, TaskForest, held_out_errors
from kerbside.operators.aggregates import describe_numeric

log = logging.getLogger(__name__)

# Fixed values of the models.
SEED = 42
SHARES = (0.8, 0.2)
FARE_TREES = 50
FARE_ROUNDS = 20
CANCEL_TREES = 30
DEMAND_TREES = 50
SEGMENTS = 4
TUNE_GRID = {"numTrees": (20, 50, 100), "maxDepth": (5, 10, 15), "minInstancesPerNode": (1, 5, 10)}
TUNE_FOLDS = 3
# Rows in a task of a tuned forest. In each pass a task sends figures of all nodes, however few rows it has.
TUNE_ROWS = 20_000
MODEL_NAMES = ("fare_prediction", "cancellation_prediction", "customer_segmentation", "demand_forecasting")
METRICS = "model string, metric string, value double"

FARE, CANCEL, SEGMENT, DEMAND = "predicted_fare", "cancellation_probability", "segment", "predicted_demand"
CANCEL_LABEL = "cancelled_label"


@contextmanager
def kept(*frames: DataFrame) -> Iterator[tuple[DataFrame, ...]]:
    """Keep frames that are read many times; what a lost executor held is computed again."""
    held = [df.persist(StorageLevel.MEMORY_AND_DISK) for df in frames]
    try:
        yield tuple(held)
    finally:
        for df in held:
            df.unpersist()


def regression_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """RMSE, MAE and R2 in one row from one pass."""
    error = F.col(prediction) - F.col(label)
    return df.agg(
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (1 - F.try_divide(F.sum(error * error), F.var_pop(label) * F.count(label))).alias("r2"),
    )


def _long(model: str, one_row: DataFrame) -> DataFrame:
    pairs = [part for name in one_row.columns for part in (F.lit(name), F.col(name))]
    return one_row.select(F.lit(model).alias("model"), F.explode(F.create_map(*pairs)).alias("metric", "value"))


def _bounded(df: DataFrame) -> DataFrame:
    """A few metric rows, taken out of their plan so that kept frames can be let go."""
    return df.sparkSession.createDataFrame(df.collect(), METRICS)


def _split(df: DataFrame, key: Sequence[str] | None) -> tuple[DataFrame, DataFrame]:
    train, test = split(df, SHARES, SEED, key)
    return train, test


def train_fare(df: DataFrame, key: Sequence[str] | None = None) -> tuple[PipelineModel, DataFrame]:
    """Linear, forest and boosted models of the fare with their metrics; the forest is kept.

    ``key`` names columns that identify a row, for the split; all columns if none.
    """
    train, test = _split(df, key)
    prepared = features().fit(train)
    candidates = {
        "linear_regression": LinearRegression(labelCol="fare", predictionCol=FARE),
        "random_forest": RandomForestRegressor(labelCol="fare", predictionCol=FARE, numTrees=FARE_TREES, seed=SEED),
        "gradient_boosting": GBTRegressor(labelCol="fare", predictionCol=FARE, maxIter=FARE_ROUNDS, seed=SEED),
    }
    slim = ("features", "fare")
    with kept(prepared.transform(train).select(*slim), prepared.transform(test).select(*slim)) as (ready, held_out):
        fitted = {name: estimator.fit(ready) for name, estimator in candidates.items()}
        scores = [_long(name, regression_metrics(model.transform(held_out), "fare", FARE)) for name, model in fitted.items()]
        found = _bounded(_union(scores))
    return PipelineModel([*prepared.stages, fitted["random_forest"]]), found


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df)
    return out


def with_cancel_label(df: DataFrame) -> DataFrame:
    """Classifiers need a numeric label."""
    return df.withColumn(CANCEL_LABEL, F.col("is_cancelled").cast("double"))


def train_cancel(df: DataFrame, key: Sequence[str] | None = None) -> tuple[PipelineModel, DataFrame]:
    """Logistic and forest models of cancellation; the one with the larger area under ROC is kept."""
    train, test = _split(with_cancel_label(df), key)
    prepared = features().fit(train)
    candidates = {
        "logistic_regression": LogisticRegression(labelCol=CANCEL_LABEL),
        "random_forest": RandomForestClassifier(labelCol=CANCEL_LABEL, numTrees=CANCEL_TREES, seed=SEED),
    }
    slim = ("features", CANCEL_LABEL)
    evaluator = BinaryClassificationEvaluator(labelCol=CANCEL_LABEL, metricName="areaUnderROC")
    with kept(prepared.transform(train).select(*slim), prepared.transform(test).select(*slim)) as (ready, held_out):
        fitted = {name: estimator.fit(ready) for name, estimator in candidates.items()}
        auc = {name: evaluator.evaluate(model.transform(held_out)) for name, model in fitted.items()}
    best = "random_forest" if auc["random_forest"] > auc["logistic_regression"] else "logistic_regression"
    rows = [(name, "auc", value) for name, value in auc.items()] + [(best, "kept", 1.0)]
    return PipelineModel([*prepared.stages, fitted[best]]), df.sparkSession.createDataFrame(rows, METRICS)


def train_segments(df: DataFrame, k: int = SEGMENTS, seed: int = SEED) -> tuple[PipelineModel, DataFrame]:
    """k-means over customer groups; the fitted pipeline and the groups with their segment."""
    groups = segment_input(df)
    pipeline = Pipeline(
        stages=[
            VectorAssembler(inputCols=list(SEGMENT_NUMBERS), outputCol="raw_features"),
            StandardScaler(inputCol="raw_features", outputCol="features"),
            KMeans(featuresCol="features", predictionCol=SEGMENT, k=k, seed=seed),
        ]
    )
    # A fixed order of the few groups makes the seeded start the same in every run.
    with kept(groups.orderBy("customer_age", "customer_gender", "membership")) as (ordered,):
        model = pipeline.fit(ordered)
    return model, model.transform(groups).drop("raw_features", "features")


def segment_summary(segmented: DataFrame) -> DataFrame:
    return (
        segmented.groupBy(SEGMENT)
        .agg(
            F.count(F.lit(1)).alias("count"),
            F.avg("customer_age").alias("avg_age"),
            F.avg("total_trips").alias("avg_trips"),
            F.avg("total_spent").alias("avg_spent"),
            F.avg("avg_rating").alias("avg_rating"),
        )
        .orderBy(SEGMENT)
    )


def train_demand(df: DataFrame) -> tuple[PipelineModel, DataFrame]:
    """A forest of the demand per hour, weekday and district with its RMSE."""
    train, test = _split(demand_input(df), ["hour", "day_of_week", "pickup_district"])
    pipeline = Pipeline(
        stages=[
            StringIndexer(inputCol="pickup_district", outputCol="district_index", handleInvalid="keep"),
            OneHotEncoder(inputCol="district_index", outputCol="district_encoded"),
            VectorAssembler(inputCols=[*DEMAND_NUMBERS, "district_encoded"], outputCol="features"),
            RandomForestRegressor(labelCol="demand", predictionCol=DEMAND, numTrees=DEMAND_TREES, seed=SEED),
        ]
    )
    with kept(train, test) as (ready, held_out):
        model = pipeline.fit(ready)
        found = _bounded(_long("demand_forest", regression_metrics(model.transform(held_out), "demand", DEMAND)))
    return model, found


def _fold(key: Sequence[str] | None, folds: int, df: DataFrame) -> Column:
    """The fold of a row, from a hash of its key."""
    return F.pmod(F.xxhash64(F.lit("fold"), *(key or df.columns)), F.lit(folds))


def _prefix_errors(
    models: Sequence[RandomForestRegressionModel], ready: DataFrame, sizes: Sequence[int]
) -> list[dict[int, float]]:
    """RMSE of the first n trees of each forest for each n."""
    if all(isinstance(model, TaskForest) for model in models):
        return held_out_errors(models, sizes)
    return [_spark_errors(model, ready, sizes) for model in models]


def _spark_errors(model: RandomForestRegressionModel, ready: DataFrame, sizes: Sequence[int]) -> dict[int, float]:
    """From one pass over the rows."""
    rows = ready
    for at, tree in enumerate(model.trees):
        rows = tree.copy().setPredictionCol(f"tree_{at}").transform(rows)
    errors = {}
    for size in sizes:
        mean = reduce(add, (F.col(f"tree_{at}") for at in range(size))) / size
        errors[str(size)] = F.sqrt(F.avg((mean - F.col("fare")) ** 2))
    found = rows.agg(*(error.alias(size) for size, error in errors.items())).first()
    return {int(size): found[size] for size in errors}


def tune_fare(
    df: DataFrame,
    grid: Mapping[str, Sequence] | None = None,
    folds: int = TUNE_FOLDS,
    parallelism: int = 4,
    key: Sequence[str] | None = None,
) -> tuple[PipelineModel, DataFrame]:
    """Cross-validated grid search for the fare forest; the best model and the RMSE of each setting.

    Features are fitted once per fold, on the rows outside it, and the rows of a fold with their vectors are kept while
    its settings are trained, ``parallelism`` folds at a time. Settings that differ in ``numTrees`` only share one
    forest: a forest's prediction is the mean of its trees, and its trees are drawn alike and independently, so its first
    n trees are a forest of n trees. Trees are grown in tasks (``forests``) where a fold's rows fit in one, else by Spark.
    RMSE is the mean over the folds; the best setting, of equal ones the first, is trained again on all training rows.
    ``key`` names columns that identify a row, as in ``train_fare``.
    """
    grid = dict(grid or TUNE_GRID)
    sizes = grid.pop("numTrees")
    settings = [dict(zip(grid, values)) for values in product(*grid.values())]
    train, _ = _split(df, key)
    errors: dict[tuple[int, int], list[float]] = defaultdict(list)

    class Forest(InTasks, RandomForestRegressor):
        pass

    def forest(codes: Codes | None, **params) -> Forest:
        # Rows remember their nodes; else every task of a pass gets all trees and walks each row from their roots.
        return Forest(labelCol="fare", predictionCol=FARE, seed=SEED, cacheNodeIds=True, **params).over(codes)

    # Spread by the number of rows, whatever files they came in, over no more tasks than a shuffle has.
    most = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = max(1, min(most, ceil(train.count() / TUNE_ROWS)))
    numbered = train.withColumn("fold", _fold(key, folds, train)).repartition(spread, *(key or train.columns))
    numbered = numbered.select(*CATEGORIES, *NUMBERS, "fare", "fold")

    def fitted(fold: int) -> list[dict[int, float]]:
        inside, outside = numbered.where(F.col("fold") != fold), numbered.where(F.col("fold") == fold)
        prepared = features().fit(inside)
        with kept(*(prepared.transform(part).select("features", "fare") for part in (inside, outside))) as (ready, held_out):
            codes = Codes.of(ready, held_out, "fare", SEED)
            models = [forest(codes, numTrees=max(sizes), **setting).fit(ready) for setting in settings]
            found = _prefix_errors(models, held_out, sizes)
        if codes:
            codes.release()
        return found

    with kept(numbered) as (numbered,):
        with ThreadPool(max(1, min(parallelism, folds))) as pool:
            for found in pool.map(inheritable_thread_target(df.sparkSession)(fitted), range(folds), chunksize=1):
                for at, of_sizes in enumerate(found):
                    for size, error in of_sizes.items():
                        errors[size, at].append(error)
        mean = {place: sum(values) / folds for place, values in errors.items()}
        names = {
            (size, at): {"numTrees": size, **setting} for size in sizes for at, setting in enumerate(settings)
        }
        best = names[min(names, key=lambda place: mean[place])]
        prepared = features().fit(numbered)
        with kept(prepared.transform(numbered).select("features", "fare")) as (ready,):
            codes = Codes.of(ready, None, "fare", SEED)
            model = forest(codes, **best).fit(ready)
            if isinstance(model, TaskForest):
                model.stored()
        if codes:
            codes.release()
    rows = [
        (", ".join(f"{name}={value}" for name, value in setting.items()), "rmse", float(mean[place]))
        for place, setting in names.items()
    ]
    return PipelineModel([*prepared.stages, model]), df.sparkSession.createDataFrame(rows, METRICS)


def load_models(spark: SparkSession, folder: str, names: Sequence[str] = MODEL_NAMES) -> dict[str, PipelineModel]:
    """The saved pipelines that exist below a folder on any file system Spark can read."""
    found = {}
    for name in names:
        path = f"{folder}/{name}_model"
        if _exists(spark, path):
            found[name] = PipelineModel.load(path)
        else:
            log.warning("no model at %s", path)
    return found


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.text(f"{path}/metadata")
    except (AnalysisException, IllegalArgumentException):
        return False
    return True


def predict(model: PipelineModel, df: DataFrame, out: str) -> DataFrame:
    """The rows with one more column; the columns a model works with do not stay behind."""
    scored = model.transform(df)
    if out == CANCEL:
        scored = scored.withColumn(out, prob_of("probability", 1))
    return scored.select(*df.columns, out)


OUTPUTS = {
    "fare_prediction": FARE,
    "cancellation_prediction": CANCEL,
}


def score(df: DataFrame, models: Mapping[str, PipelineModel]) -> DataFrame:
    """Fare and cancellation predictions for a table or a stream."""
    for name, out in OUTPUTS.items():
        if name in models:
            df = predict(models[name], df, out)
    return df


def performance(df: DataFrame, models: Mapping[str, PipelineModel]) -> DataFrame:
    """(model, metric, value) rows: errors, fare distribution, area under ROC, chances by outcome."""
    scored = score(with_cancel_label(df), models)
    parts = []
    if FARE in scored.columns:
        parts.append(_long("fare_prediction", regression_metrics(scored, "fare", FARE)))
        facts = describe_numeric(scored, ["fare", FARE])
        names = ("count", "mean", "stddev", "min", "max")
        pairs = [p for name in names for p in (F.concat("column", F.lit(f"_{name}")), F.col(name).cast("double"))]
        parts.append(
            facts.select(F.lit("fare_prediction").alias("model"), F.explode(F.create_map(*pairs)).alias("metric", "value"))
        )
    if CANCEL in scored.columns:
        evaluator = BinaryClassificationEvaluator(labelCol=CANCEL_LABEL, rawPredictionCol=CANCEL)
        with kept(scored.select(CANCEL, CANCEL_LABEL)) as (ready,):
            rows = [("cancellation_prediction", "auc", evaluator.evaluate(ready))]
            by_outcome = ready.groupBy(CANCEL_LABEL).agg(F.avg(CANCEL).alias("mean"), F.count(F.lit(1)).alias("n"))
            for outcome in by_outcome.collect():
                side = "cancelled" if outcome[CANCEL_LABEL] else "completed"
                rows.append(("cancellation_prediction", f"avg_probability_{side}", outcome["mean"]))
                rows.append(("cancellation_prediction", f"count_{side}", float(outcome["n"])))
        parts.append(df.sparkSession.createDataFrame(rows, METRICS))
    if not parts:
        return df.sparkSession.createDataFrame([], METRICS)
    return _union(parts)


TRAINERS = {
    "fare_prediction": train_fare,
    "cancellation_prediction": train_cancel,
    "customer_segmentation": train_segments,
    "demand_forecasting": train_demand,
}


def run_ml(
    action: str, df: DataFrame, folder: str, names: Sequence[str] = MODEL_NAMES, grid: Mapping[str, Sequence] | None = None
) -> DataFrame:
    """train, evaluate, tune or predict over the chosen models, saved below ``folder``."""
    if action == "train":
        reports = []
        for name in names:
            model, found = TRAINERS[name](df)
            model.write().overwrite().save(f"{folder}/{name}_model")
            if "metric" not in found.columns:  # segments: the report is their size
                sizes = segment_summary(found)
                found = sizes.select(
                    F.lit(name).alias("model"),
                    F.concat(F.lit("segment_"), SEGMENT, F.lit("_count")).alias("metric"),
                    F.col("count").cast("double").alias("value"),
                )
            reports.append(found)
        return _union(reports)
    if action == "tune":
        return tune_fare(df, grid)[1]
    models = load_models(df.sparkSession, folder, names)
    if action == "evaluate":
        return performance(df, models)
    if action == "predict":
        return score(df, models)
    raise ValueError(f"action must be train, evaluate, tune or predict, not {action!r}")
