"""Deterministic formulas behind the trip samples used for training.

Where a formula has a random part, the band it is drawn from is given as (low, high) columns; the
noise itself is left to the caller (``rand(seed)``), so that results can be checked.
Weekdays count from Monday = 0 here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.functions.fares import AIRPORT, BASE_FARE, RATE_PER_KM, ROAD_RUSH
from kerbside.functions.scalars import by_value, case, first_step, flag, hours, in_set, ratio

# District centres (latitude, longitude).
DISTRICTS = {
    "Central": (1.2966, 103.8520),
    "Orchard": (1.3048, 103.8318),
    "Marina Bay": (1.2815, 103.8639),
    "Chinatown": (1.2833, 103.8449),
    "Jurong East": (1.3329, 103.7436),
    "Tampines": (1.3496, 103.9568),
    "Woodlands": (1.4382, 103.7890),
    "Changi Airport": (1.3644, 103.9915),
    "Sentosa": (1.2494, 103.8303),
}
# Kilometres per degree and the shortest distance charged.
KM_PER_DEGREE = 111.0
SHORTEST_KM = 1.0
# Fixed values of the fare, cancellation and rating formulas.
TYPE_FACTOR = {"Standard": 1.0, "Premier": 1.5, "Mini Cab": 0.9, "Maxi Cab": 1.3, "Limosine": 2.0}
TIER_FACTOR = {"Gold": 0.85, "Silver": 0.92}
TYPE_RATING = {"Standard": 4.0, "Premier": 4.5, "Mini Cab": 3.8, "Maxi Cab": 4.2, "Limosine": 4.7}
FRIDAY_SATURDAY = (4, 5)
SATURDAY_SUNDAY = (5, 6)
BUSY_DISTRICTS = ("Orchard", "Marina Bay", "Changi Airport")
CANCEL_BASE = 0.05
CANCEL_BY_SURGE = ((2.0, 0.15), (1.5, 0.08))
CANCEL_BY_FARE = ((50, 0.10), (30, 0.05))
CANCEL_BY_TIER = {"Gold": 0.5, "Silver": 0.7}
CANCEL_CAP = 0.4


def night_hours(hour: str = "hour") -> Column:
    return (F.col(hour) >= 22) | (F.col(hour) <= 6)


def district_distance(
    pickup: str = "pickup_district", dropoff: str = "dropoff_district", centres: dict | None = None
) -> Column:
    """Flat-earth distance between district centres; null for a district without a centre."""
    centres = centres or DISTRICTS

    def axis(column: str, place: int) -> Column:
        return by_value(column, {name: point[place] for name, point in centres.items()}, None)

    north = axis(pickup, 0) - axis(dropoff, 0)
    east = axis(pickup, 1) - axis(dropoff, 1)
    km = F.sqrt(north * north + east * east) * F.lit(KM_PER_DEGREE)
    return F.when(km.isNotNull(), F.greatest(km, F.lit(SHORTEST_KM)))


def model_fare() -> Column:
    time_extra = case([(hours("hour", *ROAD_RUSH), F.lit(2.0)), (night_hours(), F.lit(1.5))], F.lit(0.0))
    weekend_extra = F.when(in_set("day_of_week", FRIDAY_SATURDAY), 1.0).otherwise(0.0)
    group_extra = F.when(F.col("num_passengers") > 4, 2.0).otherwise(0.0)
    metered = F.lit(BASE_FARE) + F.col("distance") * F.lit(RATE_PER_KM) + time_extra + weekend_extra
    factors = (
        by_value("taxi_type", TYPE_FACTOR, 1.0),
        F.col("surge_multiplier"),
        by_value("membership", TIER_FACTOR, 1.0),
    )
    for factor in factors:
        metered = metered * factor
    fare = metered + group_extra
    return F.when(fare.isNotNull(), F.greatest(fare, F.lit(BASE_FARE)))


def surge_band(district: str = "pickup_district") -> tuple[Column, Column]:
    """Lowest and highest surge for the hour, weekday and district."""
    bands = [
        (hours("hour", *ROAD_RUSH), (1.3, 2.5)),
        (night_hours(), (1.1, 1.8)),
        (in_set("day_of_week", FRIDAY_SATURDAY), (1.2, 2.0)),
    ]
    busy = in_set(district, BUSY_DISTRICTS)

    def edge(place: int, calm: float, lift: float) -> Column:
        base = case([(when, F.lit(band[place])) for when, band in bands], F.lit(calm))
        return base * F.when(busy, lift).otherwise(1.0)

    return edge(0, 1.0, 1.1), edge(1, 1.4, 1.3)


def speed_band() -> tuple[Column, Column]:
    """Lowest and highest average speed in km/h for the hour."""
    bands = [(hours("hour", *ROAD_RUSH), (12.0, 20.0)), (night_hours(), (35.0, 45.0))]

    def edge(place: int, calm: float) -> Column:
        return case([(when, F.lit(band[place])) for when, band in bands], F.lit(calm))

    return edge(0, 25.0), edge(1, 35.0)


def draw(band: tuple[Column, Column], seed: int) -> Column:
    """A uniform value within a band."""
    low, high = band
    return low + F.rand(seed) * (high - low)


def cancel_probability() -> Column:
    chance = (
        F.lit(CANCEL_BASE)
        + first_step(F.col("surge_multiplier"), CANCEL_BY_SURGE, 0.0)
        + first_step(F.col("fare"), CANCEL_BY_FARE, 0.0)
        + F.when(F.col("distance") < 3, 0.05).otherwise(0.0)
    )
    return F.least(chance * by_value("membership", CANCEL_BY_TIER, 1.0), F.lit(CANCEL_CAP))


def expected_rating() -> Column:
    """1 to 5 stars before noise."""
    planned = F.col("distance") / 25 * 60 + 10
    pace = case(
        [
            (F.col("duration_minutes") > planned * 1.3, F.lit(-0.5)),
            (F.col("duration_minutes") < planned * 0.8, F.lit(0.2)),
        ],
        F.lit(0.0),
    )
    price = F.when(ratio("fare", "distance") > 8, -0.3).otherwise(0.0)
    tier = F.when(F.col("membership") == "Gold", 0.2).otherwise(0.0)
    stars = by_value("taxi_type", TYPE_RATING, 4.0) + pace + price + tier
    return F.least(F.greatest(stars, F.lit(1.0)), F.lit(5.0))


def calendar_flags(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "is_weekend": flag(in_set("day_of_week", SATURDAY_SUNDAY)),
            "is_rush_hour": flag(hours("hour", *ROAD_RUSH)),
            "is_night": flag(night_hours()),
        }
    )


def trip_flags(df: DataFrame) -> DataFrame:
    airport = (F.col("pickup_district") == AIRPORT) | (F.col("dropoff_district") == AIRPORT)
    return calendar_flags(df).withColumns(
        {"fare_per_km": ratio("fare", "distance"), "is_airport_trip": flag(airport)}
    )


def buy_sell(df: DataFrame) -> DataFrame:
    """The amount under the column of its trade side; zero elsewhere."""
    return df.withColumns(
        {
            name: F.when(F.col("Type") == side, F.col("Amount")).otherwise(0)
            for name, side in (("Buy", "BUY"), ("Sell", "SELL"))
        }
    )
