"""Panes, hot keys and helpers of the window functions."""

import random

import pytest
from pyspark.sql import functions as F

from kerbside.operators import measures as M
from kerbside.operators import series_windows as S
from kerbside.operators import trip_windows as T
from kerbside.operators.windows import seconds, windowed
from kerbside.plans.tables import Tables
from tests.helpers import rows

SMALL = "/root/testdata/sf0.001"


def test_durations():
    assert [seconds(x) for x in ("30 seconds", "1 minute", "2 hours", "1 day", 7)] == [30, 60, 7200, 86400, 7]
    with pytest.raises(ValueError):
        seconds("soon")


def hot_rows(spark):
    """A third of all rows under one key, and some null keys, values and times."""
    chance = random.Random(5)
    given = []
    for place in range(3000):
        key = "hot" if place % 3 == 0 else None if place % 31 == 0 else f"k{place % 17}"
        value = None if place % 29 == 0 else round(chance.uniform(-5, 50), 2)
        given.append((key, value, chance.randrange(40), None if place % 97 == 0 else 1_700_000_000 + chance.randrange(7200)))
    df = spark.createDataFrame(given, "key string, value double, who int, at long")
    return df.withColumn("ts", F.timestamp_seconds("at")), given


@pytest.mark.parametrize("length, slide", [(300, 60), (240, 30), (600, 600), (100, 40)])
def test_windows_against_brute_force(spark, length, slide):
    df, given = hot_rows(spark)
    found = windowed(
        df, "ts", length,
        [M.count_rows("n"), M.count_of("some", "value"), M.total("total", "value"), M.mean("mean", "value"),
         M.largest("top", "value"), M.count_if("high", F.col("value") > 20), M.distinct("people", "who", exact=True),
         M.total_int("who_sum", "who")],
        ["key"], slide=slide,
    ).withColumn("window_start", F.unix_seconds("window_start")).drop("window_end")
    groups = {}
    for key, value, who, at in given:
        if at is None:
            continue
        start = at - at % slide
        while start > at - length:
            groups.setdefault((start, key), []).append((value, who))
            start -= slide
    expected = []
    for (start, key), members in groups.items():
        values = [value for value, _ in members if value is not None]
        cents = sum(round(value * 1_000_000) for value in values)
        expected.append((
            start, key, len(members), len(values), cents / 1e6 if values else None,
            cents / 1e6 / len(values) if values else None, max(values, default=None),
            sum(value > 20 for value in values), len({who for _, who in members}), sum(who for _, who in members),
        ))
    # Sums of doubles differ in the last bits with the order of the rows.
    found = found.withColumns({"total": F.round("total", 6), "mean": F.round("mean", 9)})
    expected = [(*row[:5], None if row[5] is None else round(row[5], 9), *row[6:]) for row in expected]
    assert rows(found) == sorted(expected, key=repr)


def test_approximate_distinct_stays_close(spark):
    trips = Tables(spark, "/root/testdata/sf0.01").bookings
    df = trips.withColumn("day", F.lit(1))
    for slide in (None, "1 hour"):
        measures = [M.distinct("about", "passenger_id"), M.distinct("exactly", "passenger_id", exact=True)]
        found = [windowed(df, "event_time", "6 hours", [m], slide=slide) for m in measures]
        for row in found[0].join(found[1], "window_start").collect():
            assert abs(row.about - row.exactly) <= max(2, 0.15 * row.exactly)


def test_late_minutes_as_histogram(spark):
    trips = Tables(spark, SMALL).trips_events
    for exact in (False, True):
        pairs = rows(T.wm_lenient(trips, exact), "late_data_minutes", "late_events_count", "trip_count", "unique_trips")
        assert any(row[0] for row in pairs)
        for late, events, count, unique in pairs:
            assert sum(n for _, n in late) == events and [m for m, _ in late] == sorted({m for m, _ in late})
            assert 0 < unique <= count or not exact


def test_running_totals_over_many_days(spark):
    given = [(f"b{i % 2}" if i % 5 else None, i * 7000, i, i % 3) for i in range(200)]
    df = spark.createDataFrame(given, "BrokerCode string, at long, TotalBuy long, TotalSell long").select(
        "BrokerCode", F.timestamp_seconds("at").alias("end"), "TotalBuy", "TotalSell", "at"
    )
    whole = {r.at: (r.RTotalBuy, r.RTotalSell, r.NetValue) for r in S.running_totals(df).collect()}
    parted = {r.at: r.RTotalBuy for r in S.running_totals(df, by=["BrokerCode"]).collect()}
    buy = sell = 0
    per_key = {}
    for key, at, bought, sold in given:
        buy, sell = buy + bought, sell + sold
        per_key[key] = per_key.get(key, 0) + bought
        assert whole[at] == (buy, sell, buy - sell)
        assert parted[at] == per_key[key]
    assert len(whole) == len(parted) == 200


def test_last_rows_of_a_hot_key(spark):
    df, given = hot_rows(spark)
    order = sorted((row for row in given if row[0] == "hot" and row[3]), key=lambda row: (row[3], row[2]), reverse=True)
    for n in (3, 20):
        narrow = S.last_n(df.filter("ts is not null"), "key", "ts", n, tie=["who"])
        try:
            spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "1")  # take the two-step way
            wide = S.last_n(df.filter("ts is not null"), "key", "ts", n, tie=["who"])
        finally:
            spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")
        expected = [(row[3], row[2]) for row in order[:n]]
        for found in (narrow, wide):
            assert sorted(((r["at"], r.who) for r in found.filter("key = 'hot'").collect()), reverse=True) == expected


def test_limit_of_last_rows_is_pushed_before_the_shuffle(spark):
    plan = S.last_n(Tables(spark, SMALL).table("events"), "user_id", "ts", 50)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and plan.count("WindowGroupLimit") >= 2


def test_sliding_batches_expand_panes_and_not_rows(spark):
    plan = T.sw_performance(Tables(spark, SMALL).trips_events)._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    expand = next(place for place, line in enumerate(lines) if "Expand" in line)
    scan = next(place for place, line in enumerate(lines) if "Scan parquet" in line)
    assert any("HashAggregate" in line for line in lines[expand:scan])
