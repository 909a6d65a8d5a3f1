"""Booking fare, category, priority and duration rules as column expressions.

Each rule reads the standard booking columns and ``membership_status``. ``night`` selects how the
hours 22 to 6 are understood: ``"literal"`` compares 22 <= hour <= 6, which no hour satisfies, so
night rules stay silent; ``"wrap"`` goes over midnight.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kerbside.functions.scalars import by_value, case, first_step, hours, in_set

# Fixed values of the booking rules.
BASE_FARE = 3.5
RATE_PER_KM = 2.2
FARE_RUSH = ((6, 9), (17, 20))
ROAD_RUSH = ((7, 9), (17, 19))
SUNDAY_FIRST_WEEKEND = (1, 7)
TYPE_FACTOR = {"Premier": 1.5, "Limosine": 2.0, "Maxi Cab": 1.3, "Mini Cab": 0.9}
TIER_FACTOR = {"Gold": 0.85, "Silver": 0.92}
LEVEL_POINTS = {"VIP": 20, "High": 10}
TIER_POINTS = {"Gold": 15, "Silver": 8}
SURGE_POINTS = ((2.0, 15), (1.5, 10), (1.2, 5))
GROUP_POINTS = ((4, 8), (2, 3))
DISTANCE_POINTS = ((20, 10), (10, 5))
AIRPORT = "Changi Airport"
CITY_CENTER = ("Central", "Orchard", "Marina Bay")


def _night(hour: Column, night: str) -> Column:
    if night not in ("literal", "wrap"):
        raise ValueError(f"night must be 'literal' or 'wrap', not {night!r}")
    return F.lit(False) if night == "literal" else (hour >= 22) | (hour <= 6)


def _special() -> Column:
    return F.col("special_requirements").isNotNull()


def _touches_airport() -> Column:
    return (F.col("pickup_district") == AIRPORT) | (F.col("dropoff_district") == AIRPORT)


def estimated_fare(night: str = "literal") -> Column:
    hour = F.col("hour_of_day")
    time_extra = case([(hours(hour, *FARE_RUSH), F.lit(2.0)), (_night(hour, night), F.lit(1.5))], F.lit(0.0))
    weekend_extra = F.when(in_set("day_of_week", SUNDAY_FIRST_WEEKEND), 1.0).otherwise(0.0)
    metered = F.lit(BASE_FARE) + F.col("estimated_distance") * F.lit(RATE_PER_KM) + time_extra + weekend_extra
    factors = (
        F.col("surge_multiplier"),
        by_value("requested_taxi_type", TYPE_FACTOR, 1.0),
        by_value("membership_status", TIER_FACTOR, 1.0),
        F.when(_special(), 1.1).otherwise(1.0),
    )
    for factor in factors:
        metered = metered * factor
    return F.round(metered, 2)


def time_category(night: str = "literal") -> Column:
    hour = F.col("hour_of_day")
    return case(
        [
            (hours(hour, *ROAD_RUSH), "RUSH_HOUR"),
            (_night(hour, night), "NIGHT"),
            (in_set("day_of_week", SUNDAY_FIRST_WEEKEND), "WEEKEND"),
        ],
        "REGULAR",
    )


def distance_category(distance: str = "estimated_distance") -> Column:
    """A boundary belongs to the shorter class; an unknown distance to the longest."""
    km = F.col(distance)
    return case([(km < 5, "SHORT"), (km <= 15, "MEDIUM"), (km <= 25, "LONG")], "EXTRA_LONG")


def route_type() -> Column:
    pickup, dropoff = F.col("pickup_district"), F.col("dropoff_district")
    return case(
        [
            (_touches_airport(), "AIRPORT"),
            (in_set(pickup, CITY_CENTER) & in_set(dropoff, CITY_CENTER), "CITY_CENTER"),
            (pickup != dropoff, "CROSS_DISTRICT"),
        ],
        "LOCAL",
    )


def priority_score() -> Column:
    points = (
        by_value("priority_level", LEVEL_POINTS, 0),
        by_value("membership_status", TIER_POINTS, 0),
        first_step(F.col("surge_multiplier"), SURGE_POINTS, 0),
        first_step(F.col("num_passengers"), GROUP_POINTS, 0),
        F.when(_special(), 5).otherwise(0),
        first_step(F.col("estimated_distance"), DISTANCE_POINTS, 0),
    )
    score = points[0]
    for part in points[1:]:
        score = score + part
    return score


def estimated_duration(night: str = "literal") -> Column:
    """Whole minutes, with time for pickup and dropoff."""
    hour = F.col("hour_of_day")
    speed = case([(hours(hour, *ROAD_RUSH), F.lit(15.0)), (_night(hour, night), F.lit(35.0))], F.lit(25.0))
    handling = F.when(_touches_airport(), 10).otherwise(5)
    return F.round(F.col("estimated_distance") / speed * 60 + handling, 0)
