"""Forests grown in tasks: the same trees as Spark's where nothing is drawn, and the same forests cut off."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor

from kerbside.learning import forests as G
from kerbside.learning import models as P
from kerbside.learning import trees as T


class Forest(G.InTasks, RandomForestRegressor):
    pass


def rows(spark, size, seed=3):
    """Two wide features, a one-hot of three, and two flags that can be set together."""
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(size):
        kind, far, late, flag, other = rng.integers(3), rng.random() * 40, float(rng.integers(24)), rng.random() < 0.3, rng.random() < 0.4
        label = far * (1 + 0.3 * kind) + (9.7 if flag else 0) + (3.1 if other and late > 16 else 0) + rng.normal()
        vector = [far, late, *(2.5 * (kind == k) for k in range(3)), 1.5 * flag, 1.0 * other]
        out.append((Vectors.dense(vector), float(label)))
    return spark.createDataFrame(out, ["features", "label"]).repartition(3).cache()


@pytest.fixture(scope="module")
def samples(spark):
    return rows(spark, 1500), rows(spark, 400, seed=4)


def test_trees_without_chance_are_those_of_spark(samples, tmp_path):
    given = dict(numTrees=1, maxDepth=9, minInstancesPerNode=3, bootstrap=False, featureSubsetStrategy="all", seed=5)
    theirs = RandomForestRegressor(**given).fit(samples[0])
    ours = Forest(**given).over(G.Codes.of(*samples)).fit(samples[0])
    assert isinstance(ours, G.TaskForest)
    assert ours.totalNumNodes == theirs.totalNumNodes > 100 and ours.trees[0].depth == theirs.trees[0].depth
    ours.setPredictionCol("ours")
    for row in ours.transform(theirs.transform(samples[0].union(samples[1]))).collect():
        assert abs(row.ours - row.prediction) < 1e-9
    ours.save(f"{tmp_path}/model")
    assert RandomForestRegressionModel.load(f"{tmp_path}/model").totalNumNodes == theirs.totalNumNodes


def test_forests_err_as_those_of_spark(samples):
    given = dict(numTrees=60, maxDepth=8, seed=5)
    theirs = RandomForestRegressor(**given, labelCol="fare").fit(samples[0].withColumnRenamed("label", "fare"))
    ours = Forest(**given).over(G.Codes.of(*samples)).fit(samples[0])
    held_out = samples[1].withColumnRenamed("label", "fare")
    (error,) = G.held_out_errors([ours], (20, 60))
    spark_error = P._spark_errors(theirs, held_out, (20, 60))
    assert all(abs(error[size] / spark_error[size] - 1) < 0.1 for size in (20, 60))
    assert abs(ours.totalNumNodes / theirs.totalNumNodes - 1) < 0.1
    # What tasks add up on the way is what the stored forest predicts.
    stored = P._spark_errors(ours, held_out, (20, 60))
    assert all(abs(error[size] - stored[size]) < 1e-9 for size in (20, 60))


def test_forests_of_several_settings_are_those_of_each(samples):
    codes = G.Codes.of(*samples)
    settings = [dict(maxDepth=d, minInstancesPerNode=m) for d in (2, 5, 9) for m in (1, 4, 30)]
    models = [Forest(numTrees=7, seed=1, **setting).over(codes).fit(samples[0]) for setting in settings]
    alone = [G.held_out_errors([model], (3, 7))[0] for model in models]
    assert G.held_out_errors(models, (3, 7)) == alone
    assert len({error[7] for error in alone}) > 6


def test_partitions_do_not_matter(samples):
    def error(frame):
        model = Forest(numTrees=4, maxDepth=5, seed=1).over(G.Codes.of(frame, samples[1])).fit(frame)
        return G.held_out_errors([model], (4,))

    assert error(samples[0]) == error(samples[0].repartition(5, "label"))


def test_what_is_not_ruled_or_too_large_is_left_to_spark(samples, monkeypatch):
    codes = G.Codes.of(*samples)
    assert not isinstance(Forest(numTrees=1, maxBins=8).over(codes).fit(samples[0]), G.TaskForest)
    monkeypatch.setattr(G, "LOCAL_BYTES", 10_000)
    assert G.Codes.of(*samples) is None
    assert not isinstance(Forest(numTrees=1).over(None).fit(samples[0]), G.TaskForest)


def test_constant_labels_and_features_make_one_leaf(spark, samples):
    same = spark.createDataFrame([(Vectors.dense(1.0, 2.0), float(at % 2)) for at in range(20)], ["features", "label"])
    flat = samples[0].selectExpr("features", "5.0D AS label")
    for frame in (same, flat):
        model = Forest(numTrees=2).over(G.Codes.of(frame)).fit(frame)
        assert model.totalNumNodes == 2


def test_odd_labels_and_vectors_are_refused(spark, samples):
    for bad in (samples[0].selectExpr("features", "IF(label < 5, null, label) AS label"), samples[0].limit(0)):
        with pytest.raises(Exception, match="labels must not be null|needs rows"):
            G.Codes.of(bad)


def test_thresholds_follow_spark():
    assert list(T.thresholds(np.array([1.0, 1.0, 2.0, 4.0]), 32)) == [1.5, 3.0]
    assert list(T.thresholds(np.array([7.0] * 5), 32)) == []
    assert len(T.thresholds(np.arange(10_000.0), 32)) == 31


def test_tuning_has_as_many_jobs_for_deep_trees(spark):
    from kerbside.plans.tables import Tables

    df = Tables(spark, "/root/testdata/sf0.001").ml_samples.persist()
    assert df.count() == 1000
    jobs = []
    for depths in ((1, 2), (3, 9)):
        group = f"tuning {depths}"
        spark.sparkContext.setJobGroup(group, group)
        P.tune_fare(df, {"numTrees": (2, 4), "maxDepth": depths}, folds=2, key=["trip_id"])
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    df.unpersist()
    assert 0 < jobs[1] <= jobs[0] + 3, jobs
