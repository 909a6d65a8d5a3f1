"""Booking and trip formulas on edge rows, against plain Python."""

import itertools
import math

import pytest
from pyspark.sql import functions as F

from kerbside.functions import fares, trip_model
from kerbside.operators import enrich as E
from tests.helpers import rows

FIELDS = (
    "hour_of_day int, day_of_week int, estimated_distance double, surge_multiplier double, requested_taxi_type string, "
    "membership_status string, special_requirements string, priority_level string, num_passengers int, "
    "pickup_district string, dropoff_district string"
)
HOURS = (22, 23, 0, 6, 7, 9, 10, 17, 19, 20)
KM = (4.99, 5.0, 15.0, 15.01, 25.0, 25.01, None)


def edge_rows():
    mixes = itertools.cycle(
        [
            (1, 1.0, "Standard", "Gold", None, "VIP", 5, "Changi Airport", "Central"),
            (3, 1.2, "Premier", "Silver", "Child Seat", "High", 2, "Orchard", "Marina Bay"),
            (7, 1.5, "Limosine", "Standard", None, "Normal", 3, "Tampines", "Tampines"),
            (4, 2.0, "Mini Cab", "Gold", "Wheelchair", None, 4, "Central", "Sentosa"),
            (2, 2.4, "Maxi Cab", None, None, "VIP", 1, None, "Changi Airport"),
            (6, 1.6, "Other", "Silver", None, "Normal", 6, "Chinatown", None),
        ]
    )
    for hour, km in itertools.product(HOURS, KM):
        day, surge, *rest = next(mixes)
        yield (hour, day, km, surge, *rest)


def fare(hour, day, km, surge, kind, tier, special, night):
    if km is None:
        return None
    late = night == "wrap" and (hour >= 22 or hour <= 6)
    extra = 2.0 if 6 <= hour <= 9 or 17 <= hour <= 20 else 1.5 if late else 0.0
    value = 3.5 + km * 2.2 + extra + (1.0 if day in (1, 7) else 0.0)
    value *= surge
    value *= {"Premier": 1.5, "Limosine": 2.0, "Maxi Cab": 1.3, "Mini Cab": 0.9}.get(kind, 1.0)
    value *= {"Gold": 0.85, "Silver": 0.92}.get(tier, 1.0)
    return value * (1.1 if special else 1.0)


@pytest.mark.parametrize("night", ["literal", "wrap"])
def test_fares(spark, night):
    given = list(edge_rows())
    df = spark.createDataFrame(given, FIELDS).withColumn("fare", fares.estimated_fare(night))
    for row in df.collect():
        expected = fare(*row[:7], night)
        assert (row.fare is None) == (expected is None)
        assert expected is None or math.isclose(row.fare, expected, abs_tol=0.00501)


def test_night_is_silent_unless_wrapped(spark):
    df = spark.createDataFrame(list(edge_rows()), FIELDS)
    assert "NIGHT" not in {r[0] for r in df.select(fares.time_category()).collect()}
    wrapped = df.select("hour_of_day", fares.time_category("wrap").alias("c")).filter("c = 'NIGHT'")
    assert {r.hour_of_day for r in wrapped.collect()} == {22, 23, 0, 6}
    with pytest.raises(ValueError):
        fares.time_category("dusk")


def test_categories(spark):
    km = spark.createDataFrame([(x,) for x in KM], "estimated_distance double")
    found = {r[0]: r[1] for r in km.select("estimated_distance", fares.distance_category()).collect()}
    assert found == {
        4.99: "SHORT", 5.0: "MEDIUM", 15.0: "MEDIUM", 15.01: "LONG", 25.0: "LONG", 25.01: "EXTRA_LONG", None: "EXTRA_LONG"
    }
    ends = [("Changi Airport", "Changi Airport"), ("Central", "Orchard"), ("Central", "Central"), ("Sentosa", "Sentosa"),
            ("Sentosa", "Central"), (None, "Central")]
    df = spark.createDataFrame(ends, "pickup_district string, dropoff_district string")
    assert [r[0] for r in df.select(fares.route_type()).collect()] == [
        "AIRPORT", "CITY_CENTER", "CITY_CENTER", "LOCAL", "CROSS_DISTRICT", "LOCAL"
    ]


def test_priority(spark):
    top = (8, 2, 20.01, 2.01, "Standard", "Gold", "Child Seat", "VIP", 5, "a", "b")
    low = (8, 2, 10.0, 1.2, "Standard", None, None, None, 2, "a", "b")
    df = spark.createDataFrame([top, low], FIELDS)
    assert [r[0] for r in df.select(fares.priority_score()).collect()] == [20 + 15 + 15 + 8 + 5 + 10, 0]


def test_unknown_passenger_gets_defaults(spark):
    from kerbside.schemas import TIER_COLUMN

    booking = "booking_id string, timestamp string, passenger_id int, " + FIELDS.replace("membership_status string, ", "").replace(
        "hour_of_day int, day_of_week int, ", ""
    ) + ", payment_method string"
    given = [("b1", "2024-01-06T08:00:00", 1, 5.0, 1.0, "Standard", None, "VIP", 1, "Central", "Orchard", "Cash"),
             ("b2", "2024-01-06T08:00:00", 9, 5.0, 1.0, "Standard", None, "VIP", 1, "Central", "Orchard", "Cash")]
    passengers = spark.createDataFrame(
        [(1, "Ann", "Gold", 50.0, 40, "F", "x")],
        f"PassengerID int, PassengerName string, {TIER_COLUMN} string, AmountSpent double, Age int, Gender string, Extra string",
    )
    found = E.enrich_bookings(E.booking_times(spark.createDataFrame(given, booking)), passengers)
    assert tuple(found.columns) == E.ENRICHED and len(E.ENRICHED) == 26
    assert rows(found, "booking_id", "passenger_name", "membership_status", "total_spent_history", "passenger_age",
                "passenger_gender", "day_of_week", "hour_of_day") == [
        ("b1", "Ann", "Gold", 50.0, 40, "F", 7, 8), ("b2", "Unknown Passenger", "Standard", 0.0, 30, "U", 7, 8)
    ]


def test_trip_model_edges(spark):
    df = spark.createDataFrame(
        [(23, 4, 2.0, 1.0, "Limosine", "Gold", 5, 1.0, 0.5), (12, 0, 2.0, 2.5, "None", "Bronze", 1, 60.0, 200.0)],
        "hour int, day_of_week int, distance double, surge_multiplier double, taxi_type string, membership string, "
        "num_passengers int, fare double, duration_minutes double",
    )
    low, high = trip_model.surge_band("taxi_type")
    found = df.select(
        trip_model.model_fare(), trip_model.cancel_probability(), trip_model.expected_rating(), low, high,
        trip_model.draw((low, high), 1).alias("drawn"),
    ).collect()
    assert math.isclose(found[0][0], (3.5 + 4.4 + 1.5 + 1.0) * 2.0 * 1.0 * 0.85 + 2.0)
    assert math.isclose(found[0][1], (0.05 + 0.05) * 0.5)
    assert math.isclose(found[0][2], 4.7 + 0.2 + 0.2, abs_tol=0.11) and found[0][2] == 5.0
    assert math.isclose(found[1][1], 0.05 + 0.15 + 0.10 + 0.05)
    assert math.isclose(found[1][2], 4.0 - 0.5 - 0.3)
    assert all(row[3] <= row.drawn <= row[4] for row in found)


def test_distance_of_unknown_district_is_unknown(spark):
    df = spark.createDataFrame([("Central", "Nowhere"), ("Central", "Central")], "pickup_district string, dropoff_district string")
    assert [r[0] for r in df.select(trip_model.district_distance()).collect()] == [None, 1.0]


def test_salted_lookup_gives_the_same_rows(spark):
    hot = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("passenger_id"), "id")
    hot = hot.withColumn("passenger_id", F.when(F.col("id") % 10 != 1, F.col("passenger_id")))
    dim = spark.range(40).select(F.col("id").alias("passenger_id"), (F.col("id") * 2).alias("twice"))
    from kerbside.operators.joins import lookup

    plain, salted = lookup(hot, dim, "passenger_id"), lookup(hot, dim, "passenger_id", salts=8)
    assert plain.columns == salted.columns == ["passenger_id", "id", "twice"]
    assert rows(plain) == rows(salted) and plain.count() == 3000
