"""Totals and means are Spark's own, whatever the values."""

import math

import pytest
from pyspark.sql import functions as F

from kerbside.operators import measures as M
from kerbside.operators import trip_windows as T
from kerbside.operators.windows import windowed
from kerbside.plans.tables import Tables

SMALL = "/root/testdata/sf0.001"
NAN, INF = float("nan"), float("inf")


def same(a, b):
    return (a is None and b is None) or a == b or (math.isnan(a) and math.isnan(b))


@pytest.mark.parametrize("values", [[1e-7, 2e-7, 4e-7], [1.0, NAN], [INF, 1.0], [INF, -INF], [1e13, 1.0], [None, None], [None, 2.0], [9e18, 9e18]])
@pytest.mark.parametrize("slide", [None, "1 minute"])
def test_totals_and_means(spark, values, slide):
    df = spark.createDataFrame([(0, value) for value in values], "at long, v double")
    df = df.withColumn("ts", F.timestamp_seconds("at"))
    report = windowed(df, "ts", "2 minutes", [M.total("total", "v"), M.mean("mean", "v")], slide=slide).first()
    plain = df.agg(F.sum("v").alias("total"), F.avg("v").alias("mean")).first()
    assert same(report.total, plain.total) and same(report["mean"], plain["mean"])


def test_a_nan_fare_ends_no_report(spark):
    trips = Tables(spark, SMALL).trips_events.withColumn("fare_amount", F.lit(NAN))
    assert math.isnan(T.tw_trips(trips).first().total_revenue)


@pytest.mark.parametrize("rsd", [0.05, 0.01])
def test_one_sketch_in_both_forms(spark, rsd):
    """Rows taken in one step and panes merged give estimates of one accuracy."""
    df = spark.range(40_000).selectExpr("id", "timestamp_seconds(id) as ts", "hash(id) as value")
    one = M.distinct("n", "value", rsd=rsd)
    panes = windowed(df, "ts", "6 hours", [one], slide="1 hour")
    window = F.window("ts", "6 hours", "1 hour").alias("window")
    direct = df.groupBy(window).agg(one.direct.alias("n"), F.count_distinct("value").alias("exact"))
    direct = direct.select(F.col("window.start").alias("window_start"), F.col("n").alias("d"), "exact")
    rows = panes.join(direct, "window_start").collect()
    assert rows and all(abs(row.n - row.d) <= rsd * row.exact for row in rows)
    assert all(abs(at - row.exact) <= 4 * rsd * row.exact for row in rows for at in (row.n, row.d))


def test_distinct_of_nothing(spark):
    df = spark.createDataFrame([(0, None)], "at long, v string").withColumn("ts", F.timestamp_seconds("at"))
    for slide in (None, "1 minute"):
        report = windowed(df, "ts", "2 minutes", [M.distinct("n", "v")], slide=slide)
        assert {row.n for row in report.collect()} == {0}
