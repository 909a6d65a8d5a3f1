"""Joining bookings with passengers and deriving fare, priority and categories."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.functions import fares
from kerbside.functions.scalars import time_parts, with_processing_time
from kerbside.operators.joins import lookup
from kerbside.schemas import TIER_COLUMN

PASSENGER_COLUMNS = ("PassengerID", "PassengerName", TIER_COLUMN, "AmountSpent", "Age", "Gender")

ENRICHED = (
    "booking_id",
    "event_time",
    "processing_time",
    "passenger_id",
    "passenger_name",
    "membership_status",
    "total_spent_history",
    "passenger_age",
    "passenger_gender",
    "pickup_district",
    "dropoff_district",
    "requested_taxi_type",
    "num_passengers",
    "estimated_distance",
    "surge_multiplier",
    "payment_method",
    "special_requirements",
    "priority_level",
    "hour_of_day",
    "day_of_week",
    "estimated_fare",
    "time_category",
    "distance_category",
    "route_type",
    "priority_score",
    "estimated_duration_minutes",
)

SUMMARY = (
    "booking_id",
    "passenger_name",
    "membership_status",
    "pickup_district",
    "dropoff_district",
    "estimated_fare",
    "priority_score",
    "time_category",
    "route_type",
)


def booking_times(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Processing time, event time from ISO text, and its hour and weekday."""
    timed = with_processing_time(df).withColumn("event_time", F.try_to_timestamp(F.col(ts)))
    return time_parts(timed, "event_time")


def join_passengers(bookings: DataFrame, passengers: DataFrame, salts: int = 1) -> DataFrame:
    """Every booking, with its passenger's columns where there is one."""
    dim = passengers.select(*PASSENGER_COLUMNS)
    return lookup(bookings, dim, {"passenger_id": "PassengerID"}, salts=salts)


def passenger_defaults(df: DataFrame) -> DataFrame:
    """Name the passenger columns and fill those of bookings without a passenger."""
    named = {
        "passenger_name": ("PassengerName", "Unknown Passenger"),
        "membership_status": (TIER_COLUMN, "Standard"),
        "total_spent_history": ("AmountSpent", 0.0),
        "passenger_age": ("Age", 30),
        "passenger_gender": ("Gender", "U"),
    }
    filled = df.withColumns(
        {name: F.coalesce(F.col(source), F.lit(value)) for name, (source, value) in named.items()}
    )
    return filled.drop(*PASSENGER_COLUMNS)


def add_booking_rules(df: DataFrame, night: str = "literal") -> DataFrame:
    return df.withColumns(
        {
            "estimated_fare": fares.estimated_fare(night),
            "time_category": fares.time_category(night),
            "distance_category": fares.distance_category(),
            "route_type": fares.route_type(),
            "priority_score": fares.priority_score(),
            "estimated_duration_minutes": fares.estimated_duration(night),
        }
    )


def enrich_bookings(
    bookings: DataFrame, passengers: DataFrame, night: str = "literal", salts: int = 1
) -> DataFrame:
    """The 26 columns of an enriched booking."""
    joined = passenger_defaults(join_passengers(bookings, passengers, salts))
    return add_booking_rules(joined, night).select(*ENRICHED)


def booking_summary(enriched: DataFrame) -> DataFrame:
    return enriched.select(*SUMMARY)
