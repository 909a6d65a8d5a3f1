"""Windowed reports on enriched bookings and on booking messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.operators import measures as M
from kerbside.operators.windows import windowed


def bk_operational(df: DataFrame, exact: bool = False) -> DataFrame:
    return windowed(
        df,
        "event_time",
        "5 minutes",
        [
            M.count_rows("booking_count"),
            M.mean("avg_fare", "estimated_fare"),
            M.mean("avg_distance", "estimated_distance"),
            M.mean("avg_priority", "priority_score"),
            M.total("total_revenue", "estimated_fare"),
            M.mean("avg_duration", "estimated_duration_minutes"),
            M.distinct("unique_passengers", "passenger_id", exact),
        ],
        keys=["pickup_district", "requested_taxi_type"],
        slide="1 minute",
        delay="10 minutes",
    )


def bk_customer(df: DataFrame, exact: bool = False) -> DataFrame:
    return windowed(
        df,
        "event_time",
        "10 minutes",
        [
            M.count_rows("bookings"),
            M.mean("avg_fare", "estimated_fare"),
            M.total("revenue", "estimated_fare"),
            M.distinct("unique_customers", "passenger_id", exact),
            M.mean("avg_priority", "priority_score"),
            M.mean("avg_distance", "estimated_distance"),
        ],
        keys=["membership_status", "time_category"],
        delay="15 minutes",
        keep_struct=True,
    )


def bk_surge(df: DataFrame) -> DataFrame:
    return windowed(
        df.filter(F.col("surge_multiplier") > 1.0),
        "event_time",
        "5 minutes",
        [
            M.count_rows("surge_bookings"),
            M.mean("avg_surge", "surge_multiplier"),
            M.largest("max_surge", "surge_multiplier"),
            M.total("surge_revenue", "estimated_fare"),
            M.mean("avg_priority_surge", "priority_score"),
        ],
        keys=["pickup_district", "route_type"],
        delay="10 minutes",
        keep_struct=True,
    )


def bk_routes(df: DataFrame, popular: int = 3) -> DataFrame:
    report = windowed(
        df,
        "event_time",
        "15 minutes",
        [
            M.count_rows("trip_count"),
            M.mean("avg_route_fare", "estimated_fare"),
            M.mean("avg_route_distance", "estimated_distance"),
            M.mean("avg_duration", "estimated_duration_minutes"),
        ],
        keys=["pickup_district", "dropoff_district", "distance_category"],
        delay="10 minutes",
        keep_struct=True,
    )
    return report.filter(F.col("trip_count") >= popular)


def bw_tumble(df: DataFrame, ts: str = "MessageSubmittedTime") -> DataFrame:
    return windowed(df, ts, "10 minutes", [M.count_rows("count")], keep_struct=True)


def bw_slide(df: DataFrame, ts: str = "MessageSubmittedTime") -> DataFrame:
    return windowed(df, ts, "100 minutes", [M.count_rows("count")], slide="10 minutes", keep_struct=True)


def bw_location(df: DataFrame) -> DataFrame:
    return df.groupBy("pickup_location").count()


def bw_minute(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    return windowed(df, ts, "1 minute", [M.count_rows("count")], keys=["pickup_location"], keep_struct=True)
