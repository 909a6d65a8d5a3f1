"""Model inputs and models over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from kerbside.learning import features as L
from kerbside.learning import models as P
from kerbside.plans.catalog import query
from kerbside.plans.tables import Tables
from kerbside.session import scratch_path

SAMPLES = ("ml_samples",)
KEY = ["trip_id"]


@query(
    "ml_segment_agg",
    f"SELECT customer_age, customer_gender, membership, count(*) AS total_trips, avg(fare) AS avg_fare, "
    f"sum(fare) AS total_spent, avg(distance) AS avg_distance, "
    f"avg(surge_multiplier) AS avg_surge, count(*) FILTER (is_cancelled) AS cancellations, "
    f"avg(rating) AS avg_rating, count(*) FILTER (is_cancelled) / count(*) AS cancellation_rate "
    "FROM ml_samples GROUP BY customer_age, customer_gender, membership",
    SAMPLES,
    digits={"avg_fare": 9, "total_spent": 4, "avg_distance": 9, "avg_surge": 9, "avg_rating": 9},
)
def _(t):
    return L.segment_input(t.ml_samples)


@query(
    "ml_demand_agg",
    f"SELECT hour, day_of_week, pickup_district, count(*) AS demand, avg(surge_multiplier) AS avg_surge, "
    "count(*) FILTER (is_cancelled) AS cancellations, count(*) FILTER (is_cancelled) / count(*) AS cancellation_rate, "
    "any_value(is_weekend) AS is_weekend, any_value(is_rush_hour) AS is_rush_hour, any_value(is_night) AS is_night "
    "FROM ml_samples GROUP BY hour, day_of_week, pickup_district",
    SAMPLES,
    digits={"avg_surge": 9},
)
def _(t):
    return L.demand_input(t.ml_samples)


@query(
    "ml_features",
    "SELECT trip_id, distance / stddev_samp(distance) OVER () AS distance_scaled FROM ml_samples",
    SAMPLES,
    digits={"distance_scaled": 9},
)
def _(t):
    model = L.features().fit(t.ml_samples)
    scaled = model.transform(t.ml_samples)
    return scaled.select("trip_id", L.prob_of("features", 0).alias("distance_scaled"))


# --- models ----------------------------------------------------------------------------------
# What a model learns can't be said in SQL. These queries return keys, names and the truth of what a model
# must fulfil that has learnt something: each of them fails if predictions are replaced by the label's mean.

_ERRORS = ("rmse", "mae", "r2")
#: Errors stay below this share of the error of the mean (demand is mostly chance); areas under ROC above this.
_SHARE, _DEMAND_SHARE, _AREA = 0.8, 0.92, 0.52


def _named_rows(rows) -> str:
    return " UNION ALL ".join(f"SELECT '{model}' AS model, '{metric}' AS metric, true AS learnt" for model, metric in rows)


def _of_mean(rows, label: str):
    """What predicting the label's mean would give: (n, mean, lo, hi, sd, mae), a scalar."""
    mean = rows.agg(F.avg(label).alias("mean")).scalar()
    return rows.agg(
        F.struct(
            F.count(label).cast("double").alias("n"),
            F.avg(label).alias("mean"),
            F.min(label).cast("double").alias("lo"),
            F.max(label).cast("double").alias("hi"),
            F.stddev_pop(label).alias("sd"),
            F.avg(F.abs(F.col(label) - mean)).alias("mae"),
        )
    ).scalar()


def _learnt(found, rows, label: str = "fare", cancelled=None, share: float = _SHARE):
    """(model, metric, learnt) of reported numbers, against the same numbers for a model that knows the mean only."""
    value, metric, mean = F.col("value"), F.col("metric"), _of_mean(rows, label)
    rate = F.lit(None) if cancelled is None else cancelled.agg(F.avg(F.col("is_cancelled").cast("double"))).scalar()
    outcomes = F.lit(None) if cancelled is None else cancelled.agg(F.sum(F.col("is_cancelled").cast("double"))).scalar()
    learnt = (
        F.when(metric == "rmse", value.between(0, share * mean["sd"]))
        .when(metric == "mae", value.between(0, share * mean["mae"]))
        .when(metric == "r2", value.between(1 - share**2, 1))
        .when(metric == "auc", value.between(_AREA, 1))
        .when(metric == "kept", value == 1)
        .when(metric == "avg_probability_cancelled", value.between(rate + 1e-6, 1))
        .when(metric == "avg_probability_completed", value.between(0, rate - 1e-6))
        .when(metric == "count_cancelled", value == outcomes)
        .when(metric == "count_completed", value == mean["n"] - outcomes)
        .when(metric.endswith("_count") & ~metric.startswith("segment"), value == mean["n"])
        .when(metric.endswith("_mean"), F.abs(value - mean["mean"]) < 0.1 * mean["sd"])
        .when(metric == f"{label}_stddev", F.abs(value / mean["sd"] - 1) < 0.01)
        .when(metric.endswith("_stddev"), value.between(0.3 * mean["sd"], 1.2 * mean["sd"]))
        .when(metric.endswith("_min"), value.between(mean["lo"] - 1e-6, mean["mean"] - 0.5 * mean["sd"]))
        .when(metric.endswith("_max"), value.between(mean["mean"] + 0.5 * mean["sd"], mean["hi"] + 1e-6))
        .otherwise(value > 0)
    )
    return found.select("model", "metric", F.coalesce(learnt, F.lit(False)).alias("learnt"))


def _close(prediction: str, label: str, found, rows, share: float = _SHARE):
    """Whether the prediction of a row lies within the labels, and those of all rows are closer than their mean."""
    mean = _of_mean(rows, label)
    error = found.agg(F.sqrt(F.avg((F.col(prediction) - F.col(label)) ** 2))).scalar()
    return F.col(prediction).between(mean["lo"] - 1e-6, mean["hi"] + 1e-6) & (error < share * mean["sd"])


@query(
    "ml_fare",
    _named_rows((m, e) for m in ("linear_regression", "random_forest", "gradient_boosting") for e in _ERRORS),
)
def _(t):
    return _learnt(P.train_fare(t.stored_samples, KEY)[1], t.stored_samples)


@query("ml_cancel", "SELECT 'auc' AS metric, CAST(2 AS BIGINT) AS models, true AS learnt UNION ALL SELECT 'kept', 1, true")
def _(t):
    found = P.train_cancel(t.stored_samples, KEY)[1]
    best = _learnt(found, t.stored_samples).groupBy("metric")
    # The model that was kept is the better one; it must have learnt something.
    return best.agg(F.count_distinct("model").alias("models"), F.max("learnt").alias("learnt"))


_GROUPS = "SELECT customer_age, customer_gender, membership, count(*) AS total_trips FROM ml_samples GROUP BY ALL"


def _tight(segmented):
    """Whether segments lie closer together than one segment would, in the scaled numbers that they are made from."""
    scales = segmented.agg(F.struct(*(F.stddev(name).alias(name) for name in L.SEGMENT_NUMBERS))).scalar()
    scaled = segmented.select(P.SEGMENT, *(F.coalesce(F.col(n) / F.nullif(scales[n], F.lit(0.0)), F.lit(0.0)).alias(n) for n in L.SEGMENT_NUMBERS))
    cost = sum((F.var_pop(name) for name in L.SEGMENT_NUMBERS), F.lit(0.0)) * F.count(F.lit(1))
    of_segments = scaled.groupBy(P.SEGMENT).agg(cost.alias("cost")).agg(F.sum("cost")).scalar()
    return of_segments < 0.8 * scaled.agg(cost).scalar()


@query("ml_segment", f"SELECT *, true AS known_segment, true AS tight FROM ({_GROUPS})", SAMPLES)
def _(t):
    groups = P.train_segments(t.stored_samples)[1]
    known = F.col(P.SEGMENT).between(0, P.SEGMENTS - 1).alias("known_segment")
    return groups.select("customer_age", "customer_gender", "membership", "total_trips", known, _tight(groups).alias("tight"))


@query(
    "ml_segment_summary",
    f"SELECT CAST({P.SEGMENTS} AS BIGINT) AS segments, count(*) AS groups, "
    f"CAST(sum(total_trips) AS BIGINT) AS trips FROM ({_GROUPS})",
    SAMPLES,
)
def _(t):
    found = P.segment_summary(P.train_segments(t.stored_samples)[1])
    return found.agg(
        F.count(F.lit(1)).alias("segments"),
        F.sum("count").alias("groups"),
        F.round(F.sum(F.col("avg_trips") * F.col("count"))).cast("long").alias("trips"),
    )


@query("ml_demand", _named_rows(("demand_forest", e) for e in _ERRORS))
def _(t):
    return _learnt(P.train_demand(t.stored_samples)[1], L.demand_input(t.stored_samples), "demand", share=_DEMAND_SHARE)


@query(
    "ml_tune",
    _named_rows(
        (f"numTrees={n}, maxDepth={d}, minInstancesPerNode={m}", "rmse")
        for n in P.TUNE_GRID["numTrees"]
        for d in P.TUNE_GRID["maxDepth"]
        for m in P.TUNE_GRID["minInstancesPerNode"]
    ),
)
def _(t):
    """The whole grid: 27 settings, 3 folds."""
    return _learnt(P.tune_fare(t.stored_samples, key=KEY)[1], t.stored_samples)


def _models(t: Tables):
    return {
        "fare_prediction": P.train_fare(t.stored_samples, KEY)[0],
        "cancellation_prediction": P.train_cancel(t.stored_samples, KEY)[0],
    }


@query("ml_predict", "SELECT trip_id, fare, true AS within FROM ml_samples", SAMPLES)
def _(t):
    model = P.train_fare(t.stored_samples, KEY)[0]
    found = P.predict(model, t.stored_samples, P.FARE)
    return found.select("trip_id", "fare", _close(P.FARE, "fare", found, t.stored_samples).alias("within"))


@query("ml_batch", "SELECT trip_id, fare, true AS within, true AS chance FROM ml_samples", SAMPLES)
def _(t):
    found = P.score(t.stored_samples, _models(t))
    within = _close(P.FARE, "fare", found, t.stored_samples).alias("within")
    # Cancelled trips have the higher chances on the whole.
    apart = found.agg(F.avg(F.when(F.col("is_cancelled"), F.col(P.CANCEL))) - F.avg(F.when(~F.col("is_cancelled"), F.col(P.CANCEL)))).scalar()
    return found.select("trip_id", "fare", within, (F.col(P.CANCEL).between(0, 1) & (apart > 1e-6)).alias("chance"))


_FACTS = [f"{column}_{fact}" for column in ("fare", P.FARE) for fact in ("count", "mean", "stddev", "min", "max")]
_CHANCES = ["auc", *(f"{fact}_{side}" for fact in ("avg_probability", "count") for side in ("cancelled", "completed"))]


@query(
    "ml_report",
    _named_rows([("fare_prediction", m) for m in (*_ERRORS, *_FACTS)] + [("cancellation_prediction", m) for m in _CHANCES]),
)
def _(t):
    return _learnt(P.performance(t.stored_samples, _models(t)), t.stored_samples, cancelled=t.stored_samples)


@query(
    "ml_load",
    "SELECT hour, day_of_week, pickup_district, count(*) AS demand, true AS within FROM ml_samples GROUP BY ALL",
    SAMPLES,
)
def _(t):
    folder = scratch_path(t.spark, "models")
    P.run_ml("train", t.stored_samples, folder, ["demand_forecasting"])
    models = P.load_models(t.spark, folder)
    demand = L.demand_input(t.stored_samples)
    found = P.predict(models["demand_forecasting"], demand, P.DEMAND)
    return found.select("hour", "day_of_week", "pickup_district", "demand", _close(P.DEMAND, "demand", found, demand, _DEMAND_SHARE).alias("within"))


_TRAINED = {"auc": 3, "kept": 1} | {m: 1 for m in _CHANCES if m != "auc"} | {f"segment_{n}_count": 1 for n in range(P.SEGMENTS)}


@query(
    "ml_actions",
    " UNION ALL ".join(
        f"SELECT '{metric}' AS metric, CAST({n} AS BIGINT) AS n, true AS learnt" for metric, n in _TRAINED.items()
    ),
)
def _(t):
    folder = scratch_path(t.spark, "models")
    names = ["cancellation_prediction", "customer_segmentation"]
    trained = P.run_ml("train", t.stored_samples, folder, names)
    both = _learnt(trained.unionByName(P.run_ml("evaluate", t.stored_samples, folder, names)), t.stored_samples, cancelled=t.stored_samples)
    return both.groupBy("metric").agg(F.count(F.lit(1)).alias("n"), F.max("learnt").alias("learnt"))
