"""Windowed reports on taxi trips (event time in ``event_timestamp``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from kerbside.functions.scalars import case, seconds_between
from kerbside.operators import measures as M
from kerbside.operators.aggregates import p95
from kerbside.operators.windows import windowed

TS = "event_timestamp"
TRIP_DELAY = "2 minutes"


#: Sums of the same rows in another order differ in the last bits. They are cut to this many digits
#: before a report rounds, so that those bits do not decide which way a half goes.
STEADY_DIGITS = 9


def _rounded(df: DataFrame, **digits: int) -> DataFrame:
    return df.withColumns({name: F.round(F.round(name, STEADY_DIGITS), places) for name, places in digits.items()})


def tw_trips(df: DataFrame) -> DataFrame:
    report = windowed(
        df,
        TS,
        "2 minutes",
        [
            M.count_of("trip_count", "trip_id"),
            M.total("total_revenue", "fare_amount"),
            M.mean("avg_fare", "fare_amount"),
            M.largest("max_distance", "distance_km"),
        ],
        delay=TRIP_DELAY,
    )
    return _rounded(report, total_revenue=2, avg_fare=2)


def tw_districts(df: DataFrame) -> DataFrame:
    report = windowed(
        df,
        TS,
        "3 minutes",
        [M.count_of("pickup_count", "trip_id"), M.mean("avg_fare", "fare_amount")],
        keys=["pickup_district"],
        delay=TRIP_DELAY,
    )
    return _rounded(report, avg_fare=2)


def tw_taxi_types(df: DataFrame) -> DataFrame:
    report = windowed(
        df,
        TS,
        "5 minutes",
        [
            M.count_of("trip_count", "trip_id"),
            M.total("revenue", "fare_amount"),
            M.mean("avg_distance", "distance_km"),
            M.mean("avg_duration_sec", "duration_seconds"),
        ],
        keys=["taxi_type"],
        delay=TRIP_DELAY,
    )
    return _rounded(report, revenue=2, avg_distance=2, avg_duration_sec=0)


def sw_trends(df: DataFrame, exact: bool = False) -> DataFrame:
    report = windowed(
        df,
        TS,
        "5 minutes",
        [
            M.count_of("trip_count", "trip_id"),
            M.total("total_revenue", "fare_amount"),
            M.mean("avg_fare", "fare_amount"),
            M.mean("avg_distance", "distance_km"),
            M.distinct("unique_pickup_districts", "pickup_district", exact),
        ],
        slide="1 minute",
        delay=TRIP_DELAY,
    )
    return _rounded(report, total_revenue=2, avg_fare=2, avg_distance=2)


def sw_districts(df: DataFrame, at_least: int = 2) -> DataFrame:
    report = windowed(
        df,
        TS,
        "4 minutes",
        [
            M.count_of("pickup_count", "trip_id"),
            M.total("revenue", "fare_amount"),
            M.mean("avg_passengers", "passenger_count"),
        ],
        keys=["pickup_district"],
        slide="30 seconds",
        delay=TRIP_DELAY,
    )
    return _rounded(report.filter(F.col("pickup_count") >= at_least), revenue=2, avg_passengers=1)


def sw_performance(df: DataFrame) -> DataFrame:
    report = windowed(
        df,
        TS,
        "3 minutes",
        [
            M.count_of("trip_count", "trip_id"),
            M.mean("avg_fare", "fare_amount"),
            M.total("total_distance", "distance_km"),
            M.mean("avg_duration_min", "duration_seconds"),
            M.total_int("total_passengers", "passenger_count"),
        ],
        keys=["taxi_type"],
        slide="30 seconds",
        delay=TRIP_DELAY,
    )
    in_minutes = report.withColumn("avg_duration_min", F.col("avg_duration_min") / 60)
    return _rounded(in_minutes, avg_fare=2, total_distance=2, avg_duration_min=1)


def sw_rush(df: DataFrame, busy_above: int = 15, exact: bool = False) -> DataFrame:
    report = windowed(
        df,
        TS,
        "6 minutes",
        [
            M.count_of("trip_count", "trip_id"),
            M.mean("avg_fare", "fare_amount"),
            M.distinct("active_districts", "pickup_district", exact),
            M.count_if("group_trips", F.col("passenger_count") > 2),
            M.mean("avg_distance", "distance_km"),
        ],
        slide="2 minutes",
        delay=TRIP_DELAY,
    )
    demand = F.when(F.col("trip_count") > busy_above, "HIGH_DEMAND").otherwise("NORMAL")
    return _rounded(report, avg_fare=2, avg_distance=2).select(
        "window_start",
        "window_end",
        "trip_count",
        demand.alias("is_rush_hour"),
        "avg_fare",
        "active_districts",
        "group_trips",
        "avg_distance",
    )


# --- lateness --------------------------------------------------------------------------------

def _late() -> Column:
    """Unflagged rows count as on time."""
    return F.coalesce(F.col("is_late_data"), F.lit(False))


def late_minutes(minutes: str = "late_by_minutes") -> Column:
    """Minutes of a late row, null for one on time."""
    return F.when(_late(), F.col(minutes))


def _late_report(df: DataFrame, delay: str, label: str, late_count: bool, exact: bool) -> DataFrame:
    """Trips per window and district with the delays of late rows.

    The delays are gathered as a histogram of minutes, in two steps: rows are combined per minute
    first, so no group ever holds more entries than there are different minutes, however hot the
    district.
    """
    marked = df.withColumn("late__minutes", late_minutes())
    trips = M.count_of("trip_count", "trip_id")
    revenue = M.total("total_revenue", "fare_amount")
    unique = M.distinct("unique_trips", "trip_id", exact)
    late = M.count_if("late_events_count", _late())
    first = [trips, revenue, late] + ([] if exact else [unique])
    parts = [column.alias(name) for m in first for name, column in m.parts.items()]
    parts.append(F.count(F.lit(1)).alias("late__events"))
    carried = [F.col("trip_id").alias("unique_trips__value")] if exact else []
    if delay:
        marked = marked.withWatermark(TS, delay)
    per_minute = marked.groupBy(
        F.window(TS, "2 minutes").alias("window"), "pickup_district", "late__minutes", *carried
    ).agg(*parts)
    if exact:  # batch only: bring the trip ids down to one row per minute before the list is built
        per_minute = _exact_trips(per_minute, first)
    entry = F.when(
        F.col("late__minutes").isNotNull(),
        F.struct(F.col("late__minutes").alias("minutes"), F.col("late__events").alias("events")),
    )
    merged = {m.name: m.merged({name: F.col(name) for name in m.parts}) for m in first}
    if exact:
        merged["unique_trips"] = F.sum("unique_trips__n")
    again = F.window(F.window_time("window"), "2 minutes") if df.isStreaming else F.col("window")
    out = per_minute.groupBy(again.alias("window"), "pickup_district").agg(
        *[column.alias(name) for name, column in merged.items()],
        F.sort_array(F.collect_list(entry)).alias("late_data_minutes"),
    )
    names = ["trip_count", "total_revenue", "unique_trips"] + (["late_events_count"] if late_count else [])
    return _rounded(
        out.select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            F.lit(label).alias("watermark_type"),
            "pickup_district",
            *names,
            "late_data_minutes",
        ),
        total_revenue=2,
    )


def _exact_trips(per_trip: DataFrame, first: list[M.Measure]) -> DataFrame:
    """(window, district, minute, trip) rows -> (window, district, minute) rows with the number of trips
    whose smallest minute it is, so that the numbers of a window add up to its different trips."""
    place = ["window", "pickup_district"]
    order = Window.partitionBy(*place, "unique_trips__value").orderBy("late__minutes")
    new = (F.row_number().over(order) == 1) & F.col("unique_trips__value").isNotNull()
    names = [name for m in first for name in m.parts] + ["late__events"]
    marked = per_trip.withColumn("unique_trips__n", F.when(new, 1).otherwise(0))
    return marked.groupBy(*place, "late__minutes").agg(*[F.sum(name).alias(name) for name in (*names, "unique_trips__n")])


def wm_strict(df: DataFrame, exact: bool = False) -> DataFrame:
    return _late_report(df, "30 seconds", "STRICT_30s", False, exact)


def wm_lenient(df: DataFrame, exact: bool = False) -> DataFrame:
    return _late_report(df, "5 minutes", "LENIENT_5m", True, exact)


def wm_none(df: DataFrame) -> DataFrame:
    report = windowed(
        df,
        TS,
        "2 minutes",
        [
            M.count_of("trip_count", "trip_id"),
            M.total("total_revenue", "fare_amount"),
            M.count_if("late_events_count", _late()),
            M.largest("max_lateness_minutes", "late_by_minutes"),
        ],
        keys=["pickup_district"],
    )
    return _rounded(report, total_revenue=2).select(
        "window_start",
        "window_end",
        F.lit("NO_WATERMARK").alias("watermark_type"),
        "pickup_district",
        "trip_count",
        "total_revenue",
        "late_events_count",
        "max_lateness_minutes",
    )


def lateness(df: DataFrame, event: str = TS, processing: str = "processing_timestamp") -> DataFrame:
    late_by = seconds_between(processing, event)
    return df.withColumn("lateness_seconds", late_by).withColumn(
        "lateness_category",
        case(
            [
                (F.col("lateness_seconds") <= 30, "ON_TIME"),
                (F.col("lateness_seconds") <= 120, "SLIGHTLY_LATE"),
                (F.col("lateness_seconds") <= 300, "MODERATELY_LATE"),
            ],
            "VERY_LATE",
        ),
    )


def wm_lateness(df: DataFrame) -> DataFrame:
    report = windowed(
        lateness(df),
        TS,
        "1 minute",
        [
            M.count_of("event_count", "trip_id"),
            M.mean("avg_lateness_sec", "lateness_seconds"),
            M.largest("max_lateness_sec", "lateness_seconds"),
        ],
        keys=["lateness_category"],
        delay=TRIP_DELAY,
    )
    return _rounded(report, avg_lateness_sec=1)


def wm_collected(df: DataFrame, exact: bool = False) -> DataFrame:
    """Events, trips and the 95th percentile of the fares (a sketch) per two-minute window."""
    out = df.groupBy(F.window(TS, "2 minutes").alias("window")).agg(
        F.count(F.lit(1)).alias("total_events"),
        M.distinct("unique_trips", "trip_id", exact).direct.alias("unique_trips"),
        p95("fare_amount").alias("p95_fare"),
    )
    return out.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *out.columns[1:]
    )
