"""Models: metric bounds, save and load, scoring of tables and streams."""

import pytest
from pyspark.sql import functions as F

from kerbside.functions.scalars import split
from kerbside.learning import features as L
from kerbside.learning import models as P
from kerbside.plans.tables import Tables
from kerbside.session import scratch_path, stream_session
from kerbside.streaming import sinks

KEY = ["trip_id"]


@pytest.fixture(scope="module")
def samples(spark):
    df = Tables(spark, "/root/testdata/sf0.01").ml_samples.persist()
    yield df
    df.unpersist()


@pytest.fixture(scope="module")
def fare(samples):
    return P.train_fare(samples, KEY)


@pytest.fixture(scope="module")
def cancel(samples):
    return P.train_cancel(samples, KEY)


def values(found, model):
    return {r.metric: r.value for r in found.collect() if r.model == model}


def test_fare_models_beat_the_mean(fare, samples):
    for name in ("linear_regression", "random_forest", "gradient_boosting"):
        facts = values(fare[1], name)
        assert facts["r2"] > 0.6 and 0 < facts["mae"] <= facts["rmse"]


def test_metrics_agree_with_the_evaluator(fare, samples):
    from pyspark.ml.evaluation import RegressionEvaluator

    scored = P.predict(fare[0], samples, P.FARE)
    ours = P.regression_metrics(scored, "fare", P.FARE).first()
    for name in ("rmse", "mae", "r2"):
        theirs = RegressionEvaluator(labelCol="fare", predictionCol=P.FARE, metricName=name).evaluate(scored)
        assert abs(ours[name] - theirs) < 1e-9


def test_cancellation_is_better_than_chance(cancel):
    facts = cancel[1].collect()
    assert max(r.value for r in facts if r.metric == "auc") > 0.55
    assert [r.metric for r in facts].count("kept") == 1


def test_scores_leave_only_their_columns(fare, cancel, samples):
    models = {"fare_prediction": fare[0], "cancellation_prediction": cancel[0]}
    scored = P.score(samples, models)
    assert scored.columns == [*samples.columns, P.FARE, P.CANCEL]
    low, high = scored.agg(F.min(P.CANCEL), F.max(P.CANCEL)).first()
    assert 0 <= low < high <= 1
    report = P.performance(samples, models)
    assert values(report, "fare_prediction")["fare_count"] == samples.count()
    chances = values(report, "cancellation_prediction")
    assert chances["avg_probability_cancelled"] > chances["avg_probability_completed"]


def test_saved_models_score_a_stream(spark, fare, samples, tmp_path):
    folder = scratch_path(spark, "models")
    sinks.save_model(fare[0], f"{folder}/fare_prediction_model")
    sinks.save_model(fare[0], f"{folder}/fare_prediction_model")  # replaces the first
    models = P.load_models(spark, folder)
    assert list(models) == ["fare_prediction"]
    rows = samples.limit(50)
    rows.write.parquet(f"{tmp_path}/in")
    stream = stream_session(spark).readStream.schema(rows.schema).parquet(f"{tmp_path}/in")
    sinks.to_files(P.score(stream, models).select("trip_id", P.FARE), "parquet", f"{tmp_path}/out", f"{tmp_path}/c",
                   "available_now").awaitTermination()
    streamed = dict(spark.read.parquet(f"{tmp_path}/out").collect())
    batch = dict(P.score(spark.read.parquet(f"{tmp_path}/in"), models).select("trip_id", P.FARE).collect())
    assert len(streamed) == 50 and streamed == batch


def test_unseen_categories_can_be_scored(fare, samples):
    odd = samples.limit(1).withColumn("pickup_district", F.lit("Nowhere"))
    assert P.predict(fare[0], odd, P.FARE).first()[P.FARE] > 0


def test_segments_repeat(samples):
    first, second = (P.train_segments(samples)[1] for _ in range(2))
    key = ("customer_age", "customer_gender", "membership", P.SEGMENT)
    assert sorted(first.select(*key).collect()) == sorted(second.select(*key).collect())
    summary = P.segment_summary(first).collect()
    assert [r.segment for r in summary] == [0, 1, 2, 3]
    assert sum(r["count"] for r in summary) == L.segment_input(samples).count()


def test_tuning_reports_every_setting(samples):
    small = split(samples, [0.2, 0.8], key=KEY)[0]
    best, found = P.tune_fare(small, {"numTrees": (3, 6), "maxDepth": (2, 4)}, folds=2, key=KEY)
    scores = {r.model: r.value for r in found.collect()}
    assert len(scores) == 4
    forest = best.stages[-1]
    assert min(scores, key=scores.get) == f"numTrees={forest.getNumTrees}, maxDepth={forest.getMaxDepth()}"
    assert P.FARE in best.transform(small.limit(3)).columns
    assert {name: len(entries) for name, entries in P.TUNE_GRID.items()} == {
        "numTrees": 3, "maxDepth": 3, "minInstancesPerNode": 3
    }


def test_tuned_forests_are_spread_by_rows(samples, monkeypatch):
    seen = []

    class Seen(P.RandomForestRegressor):
        def fit(self, rows):
            seen.append((rows.rdd.getNumPartitions(), self.getCacheNodeIds()))
            return super().fit(rows)

    monkeypatch.setattr(P, "RandomForestRegressor", Seen)
    small = split(samples, [0.2, 0.8], key=KEY)[0]
    for rows, tasks in ((P.TUNE_ROWS, 1), (1500, 2), (10, 4)):
        monkeypatch.setattr(P, "TUNE_ROWS", rows)
        P.tune_fare(small, {"numTrees": (1, 2), "maxDepth": (1, 3)}, folds=2, key=KEY)
        assert seen == [(tasks, True)] * 5
        seen.clear()


def test_unknown_action(samples):
    with pytest.raises(ValueError):
        P.run_ml("guess", samples, "/nowhere")


def test_split_depends_on_values_only(samples):
    key = samples.select("trip_id")
    sides = [{r.trip_id for r in part.collect()} for part in split(key, [0.8, 0.2])]
    again = [{r.trip_id for r in part.collect()} for part in split(key.repartition(7), [0.8, 0.2])]
    assert sides == again and not sides[0] & sides[1]
    assert len(sides[0] | sides[1]) == 10000 and abs(len(sides[0]) - 8000) < 200


def test_model_queries_make_their_samples_once(spark):
    from kerbside.plans.catalog import runner

    found = runner("ml_segment")(spark, "/root/testdata/sf0.001")
    assert not [file for file in found.inputFiles() if "testdata" in file]
    t = Tables(spark, "/root/testdata/sf0.001")
    assert t.stored_samples.dtypes == t.ml_samples.dtypes
    assert t.stored_samples.exceptAll(t.ml_samples).isEmpty() and t.ml_samples.exceptAll(t.stored_samples).isEmpty()
