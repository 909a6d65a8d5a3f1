"""Quality checks on odd tables, and the report."""

import json
import math
import uuid

import pytest
from pyspark.sql import functions as F

from kerbside.operators.quality import checks as K
from kerbside.operators.quality import report as P
from kerbside.operators.quality import rules as R
from kerbside.plans.tables import Tables
from kerbside.streaming.sinks import write_report
from tests.helpers import rows

CHECKED = "/root/testdata/sf0.01"


def test_empty_table(spark):
    df = spark.createDataFrame([], "a int, b string")
    assert rows(K.completeness(df, ["a"])) == [("a", 0, None, "EMPTY", False), ("b", 0, None, "EMPTY", False)]
    assert rows(K.uniqueness(df, ["a"]), "distinct_count", "status", "critical") == [(0, "EMPTY", False)]
    assert K.ranges(df, {"a": (0, 1)}).count() == 0
    assert K.outliers(df).count() == 0
    assert rows(K.profile(df, exact=True), "total_rows", "distinct_count", "cardinality") == [(0, 0, 0.0), (0, 0, 0.0)]
    assert rows(R.rule_driver_rating(spark.createDataFrame([], "Rating double")), "violations", "status") == [(0, "PASS")]


def test_column_of_nulls(spark):
    df = spark.createDataFrame([(None, 1), (None, 2)], "a int, b int")
    found = K.completeness(df, ["a"]).filter("column = 'a'").first()
    assert (found.null_count, found.completeness_rate, found.status, found.critical) == (2, 0.0, "FAIL", True)
    assert [r[0] for r in rows(K.ranges(df, {"a": (0, 1), "b": (0, 1)}))] == ["b"]
    assert [r.column for r in K.outliers(df).collect()] == ["b"]
    assert rows(K.uniqueness(df, ["a"]), "distinct_count", "duplicates") == [(1, 1)]


@pytest.mark.parametrize(
    "values",
    [
        list(range(1000)), [5] * 40, [1, 2], [7], [None, 3, None], [10.0**at for at in range(-300, 300, 3)], [0, 0, 0, 1e308, -1e308],
        [float("-inf"), 1, 2, 3, float("inf")], [(at * 7919) % 997 / 3 for at in range(5000)], [-0.0, 0.0, float("nan"), 1],
    ],
)
def test_exact_quantiles(spark, values):
    df = spark.createDataFrame([(None if v is None else float(v), 1) for v in values], "a double, b int")
    known = sorted(v for v in values if v is not None and v == v)
    want = [float(known[max(1, math.ceil(share * len(known))) - 1]) for share in (0.25, 0.5, 0.75)]
    assert K.exact_quantiles(df, ["a", "b"], buckets=16) == {"a": want, "b": [1.0] * 3}


def test_exact_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "a double")
    assert K.exact_quantiles(df, ["a"]) == {"a": None} and K.outliers(df, exact=True).count() == 0


def test_null_and_zero_signs_as_values(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,), (None,), (None,), (float("nan"),)], "a double")
    assert rows(K.uniqueness(df, ["a"]), "distinct_count") == [(df.distinct().count(),)] == [(3,)]


def test_range_severity_and_examples(spark):
    few = spark.createDataFrame([(float(i),) for i in range(100)] + [(None,)], "a double")
    found = K.ranges(few, {"a": (0, 94), "missing": (0, 1)}).first()
    assert (found.out_of_range_count, found.validity_rate, found.critical, found.warning) == (5, 0.95, False, True)
    assert K.ranges(few, {"a": (0, 50)}).first().critical
    assert rows(K.range_examples(few, {"a": (3, 90)}, 4)) == [("a", [0.0, 1.0, 2.0, 91.0])]
    exact = K.ranges(few, {"a": (0, 99)}).first()
    assert (exact.status, exact.critical, exact.warning) == ("PASS", False, False)


def test_columns_with_odd_names(spark):
    df = spark.createDataFrame([(1, "x"), (2, None)], "`a b` int, `it's` string")
    assert dict(rows(K.completeness(df), "column", "null_count")) == {"a b": 0, "it's": 1}
    assert dict(rows(K.profile(df, exact=True), "column", "distinct_count")) == {"a b": 2, "it's": 2}


def test_rules_on_odd_rows(spark):
    trips = spark.createDataFrame(
        [("A", 0.0, 600, 10.0, 9), ("B", 10.0, 600, 5.0, 4), ("Z", 10.0, 6000, 50.0, 99), (None, None, None, None, None)],
        "TaxiNumber string, DistanceTravelled double, TripDurationInSeconds int, TripFare double, NumberOfPassengers int",
    )
    taxis = spark.createDataFrame(
        [("A", "Mini Cab", 4), ("B", "Rickshaw", 99), ("C", "Maxi Cab", 5)],
        "TaxiNumber string, TaxiType string, TaxiPassengerCapacity int",
    )
    assert rows(R.rule_fare_per_km(trips), "violations") == [(1,)]
    assert rows(R.rule_minutes_per_km(trips), "violations") == [(0,)]
    assert rows(R.rule_seats(trips, taxis), "violations") == [(1,)]
    assert rows(R.rule_taxi_capacity(taxis), "violations") == [(1,)]
    # A null taxi number is a reference to nothing; null passenger ids are skipped.
    assert rows(R.ref_check({"trips": trips, "taxis": taxis}, "taxi_references"), "invalid_references") == [(2,)]


def test_quartiles_stay_within_the_rank_error(spark):
    trips = Tables(spark, CHECKED).trips
    total = trips.count()
    found = K.outliers(trips, rel_err=0.01, columns=["TripFare", "TripDurationInSeconds"]).collect()
    for row in found:
        for value, share in ((row.q1, 0.25), (row.median, 0.5), (row.q3, 0.75)):
            below = trips.filter(F.col(row.column) <= value).count() / total
            assert abs(below - share) <= 0.015
        low, high = row.q1 - 1.5 * row.iqr, row.q3 + 1.5 * row.iqr
        outside = trips.filter((F.col(row.column) < low) | (F.col(row.column) > high)).count()
        assert outside == row.outliers


def test_profile_with_sketches(spark):
    df = Tables(spark, CHECKED).table("lineitem").select("l_orderkey", "l_returnflag", "l_discount")
    exact = {r.column: r.distinct_count for r in K.profile(df, exact=True).collect()}
    about = {r.column: r.distinct_count for r in K.profile(df, exact=False).collect()}
    assert all(abs(about[name] - exact[name]) <= 0.15 * exact[name] for name in exact)


def _jobs(spark, action):
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        action()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_jobs_do_not_grow_with_columns(spark):
    base = spark.range(100)
    narrow = base.select(*[(F.col("id") + i).alias(f"c{i}") for i in range(2)])
    wide = base.select(*[(F.col("id") + i).alias(f"c{i}") for i in range(60)])
    for check in (K.completeness, K.profile, K.outliers):
        assert _jobs(spark, lambda: check(narrow).collect()) == _jobs(spark, lambda: check(wide).collect())


def datasets(spark):
    t = Tables(spark, "/root/testdata/sf0.001")
    return {"taxis": t.taxis, "drivers": t.drivers, "passengers": t.all_passengers, "trips": t.passenger_trips}


def test_report_and_file(spark, tmp_path):
    report = P.run_suite(datasets(spark))
    found = report.collect()
    assert {r.check for r in found} == {
        "profiling", "completeness", "uniqueness", "ranges", "business_rules", "consistency", "distribution"
    }
    facts = P.summary(report).first()
    counted = [r for r in found if r.check in P.COUNTED]
    assert facts.total_checks == len(counted) == facts.passed_checks + facts.failed_checks
    assert facts.critical_issues == sum(r.critical for r in found)
    assert facts.warnings == sum(r.warning for r in found)
    write_report(report, f"{tmp_path}/report")
    written = [json.loads(line) for line in open(next(tmp_path.glob("report/*.json")))]
    assert len(written) == len(found) and all("metrics" in row for row in written)
    assert dict(rows(P.monitoring(report)))["trips_column_count"] == 7.0


def test_suite_over_some_datasets(spark):
    some = {"drivers": datasets(spark)["drivers"]}
    found = P.run_suite(some).collect()
    assert {r.dataset for r in found} == {"drivers"} and not [r for r in found if r.check == "consistency"]


@pytest.mark.parametrize("passed, word", [(100, "EXCELLENT"), (95, "EXCELLENT"), (94, "GOOD"), (89, "ACCEPTABLE"), (79, "POOR")])
def test_verdicts(spark, passed, word):
    given = [("d", "ranges", str(i), "PASS" if i < passed else "FAIL", False, False) for i in range(100)]
    report = spark.createDataFrame(given, "dataset string, check string, item string, status string, critical boolean, warning boolean")
    found = P.summary(report)
    assert found.first().overall == word
    advice = [r.advice for r in P.recommend(found).orderBy("place").collect()]
    assert len(advice) == (0 if passed == 100 else 2)


def test_exact_outliers_make_their_rows_once(spark, tmp_path):
    spark.createDataFrame([(float(n % 7), None if n == 3 else n) for n in range(50)] + [(99.0, 500)], "`a b` double, n int").write.parquet(f"{tmp_path}/t")
    found = K.outliers(spark.read.parquet(f"{tmp_path}/t"), exact=True)
    assert not [file for file in found.inputFiles() if f"{tmp_path}/t" in file]
    assert rows(found, "column", "q1", "median", "q3", "outliers") == [("a b", 1.0, 3.0, 5.0, 1), ("n", 13.0, 25.0, 38.0, 1)]


def test_suite_counts_outliers_in_the_first_pass(spark):
    df = spark.createDataFrame([(float(n % 7), None) for n in range(50)] + [(99.0, None)], "TripFare double, nothing int")
    report = P.run_suite({"other": df})
    assert report._jdf.queryExecution().optimizedPlan().collectLeaves().size() == 1
    found = report.where("check = 'distribution'").select("item", "status", "warning", "metrics.outliers", "metrics.q3").collect()
    assert [tuple(row) for row in found] == [("TripFare", "PASS", False, 1.0, 5.0)]


def test_trips_are_made_behind_the_join(spark):
    plan = Tables(spark, CHECKED).passenger_trips._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Supplier#") < plan.index("Join")
