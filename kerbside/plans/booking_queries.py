"""Enrichment, booking windows and joins over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.functions import fares, trip_model
from kerbside.functions.scalars import time_parts
from kerbside.operators import booking_windows as B
from kerbside.operators import enrich as E
from kerbside.operators import joins as J
from kerbside.plans.catalog import query
from kerbside.plans.oracle_views import windows
from kerbside.plans.tables import Tables


def enriched(t: Tables, night: str = "literal") -> DataFrame:
    return E.enrich_bookings(t.bookings, t.passengers, night)


def _rider(t: Tables) -> DataFrame:
    return E.passenger_defaults(E.join_passengers(t.bookings, t.passengers))


@query(
    "en_join",
    "SELECT booking_id, passenger_id, PassengerName, tier, Age FROM bookings LEFT JOIN passengers "
    "ON passenger_id = PassengerID",
    ("bookings", "passengers"),
)
def _(t):
    joined = E.join_passengers(t.bookings, t.passengers)
    return joined.select("booking_id", "passenger_id", "PassengerName", F.col(E.TIER_COLUMN).alias("tier"), "Age")


@query(
    "en_defaults",
    "SELECT booking_id, passenger_name, membership_status, total_spent_history, passenger_age, passenger_gender "
    "FROM enriched",
    ("enriched",),
)
def _(t):
    return _rider(t).select(
        "booking_id",
        "passenger_name",
        "membership_status",
        "total_spent_history",
        "passenger_age",
        "passenger_gender",
    )


@query(
    "en_timeparts",
    "SELECT 'BK' || event_id AS booking_id, date_trunc('second', et) AS event_time, hour(et) AS hour_of_day, "
    "dayofweek(et) + 1 AS day_of_week FROM ev",
    ("ev",),
)
def _(t):
    text = F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp")
    timed = E.booking_times(t.bookings.select("booking_id", text))
    return timed.select("booking_id", "event_time", "hour_of_day", "day_of_week")


_RULES = {
    "en_fare": ("estimated_fare", fares.estimated_fare),
    "en_timecat": ("time_category", fares.time_category),
    "en_duration": ("estimated_duration_minutes", fares.estimated_duration),
}

for _name, (_column, _rule) in _RULES.items():
    for _suffix, _night, _view in (("", "literal", "enriched"), ("_wrap", "wrap", "enriched_wrap")):

        @query(_name + _suffix, f"SELECT booking_id, {_column} FROM {_view}", (_view,))
        def _(t, column=_column, rule=_rule, night=_night):
            return _rider(t).select("booking_id", rule(night).alias(column))


@query("en_distcat", "SELECT booking_id, distance_category FROM enriched", ("enriched",))
def _(t):
    return t.bookings.select("booking_id", fares.distance_category().alias("distance_category"))


@query("en_route", "SELECT booking_id, route_type FROM enriched", ("enriched",))
def _(t):
    return t.bookings.select("booking_id", fares.route_type().alias("route_type"))


@query("en_priority", "SELECT booking_id, priority_score FROM enriched", ("enriched",))
def _(t):
    return _rider(t).select("booking_id", fares.priority_score().alias("priority_score"))


@query("en_enriched", "SELECT * FROM enriched", ("enriched",))
def _(t):
    return enriched(t)


@query(
    "en_summary",
    "SELECT booking_id, passenger_name, membership_status, pickup_district, dropoff_district, estimated_fare, "
    "priority_score, time_category, route_type FROM enriched",
    ("enriched",),
)
def _(t):
    return E.booking_summary(enriched(t))


# --- trip formulas ---------------------------------------------------------------------------

# Places of the districts, and the busy ones.
_CENTRES = (
    "(VALUES ('Central', 1.2966::DOUBLE, 103.8520::DOUBLE), ('Orchard', 1.3048::DOUBLE, 103.8318::DOUBLE), "
    "('Marina Bay', 1.2815::DOUBLE, 103.8639::DOUBLE), ('Chinatown', 1.2833::DOUBLE, 103.8449::DOUBLE), "
    "('Jurong East', 1.3329::DOUBLE, 103.7436::DOUBLE), ('Tampines', 1.3496::DOUBLE, 103.9568::DOUBLE), "
    "('Woodlands', 1.4382::DOUBLE, 103.7890::DOUBLE), ('Changi Airport', 1.3644::DOUBLE, 103.9915::DOUBLE), "
    "('Sentosa', 1.2494::DOUBLE, 103.8303::DOUBLE))"
)


@query(
    "fx_distance",
    f"SELECT booking_id, round(greatest(1.0::DOUBLE, sqrt((a.y - b.y) * (a.y - b.y) + (a.x - b.x) * (a.x - b.x)) "
    f"* 111), 6) AS km FROM bookings JOIN {_CENTRES} a(name, y, x) ON a.name = pickup_district "
    f"JOIN {_CENTRES} b(name, y, x) ON b.name = dropoff_district",
    ("bookings",),
)
def _(t):
    return t.bookings.select("booking_id", F.round(trip_model.district_distance(), 6).alias("km"))


@query("fx_fare_ml", "SELECT trip_id, fare FROM ml_priced", ("ml_priced",))
def _(t):
    return t.ml_bookings.select("trip_id", F.round(trip_model.model_fare(), 2).alias("fare"))


def _band_sql(rush: str, night: str, friday: str, calm: str, lift: str) -> str:
    return (
        "round(CASE WHEN list_contains([7,8,9,17,18,19], hour) THEN " + rush
        + " WHEN hour NOT BETWEEN 7 AND 21 THEN " + night
        + (f" WHEN day_of_week IN (4, 5) THEN {friday}" if friday else "")
        + f" ELSE {calm} END * CASE WHEN pickup_district IN ('Orchard', 'Marina Bay', 'Changi Airport') "
        f"THEN {lift} ELSE 1.0::DOUBLE END, 6)"
    )


@query(
    "fx_surge_band",
    "SELECT trip_id, "
    + _band_sql("1.3::DOUBLE", "1.1::DOUBLE", "1.2::DOUBLE", "1.0::DOUBLE", "1.1::DOUBLE")
    + " AS lowest, "
    + _band_sql("2.5::DOUBLE", "1.8::DOUBLE", "2.0::DOUBLE", "1.4::DOUBLE", "1.3::DOUBLE")
    + " AS highest FROM ml_bookings",
    ("ml_bookings",),
)
def _(t):
    low, high = trip_model.surge_band()
    return t.ml_bookings.select("trip_id", F.round(low, 6).alias("lowest"), F.round(high, 6).alias("highest"))


@query(
    "fx_speed_band",
    "SELECT trip_id, "
    + _band_sql("12.0::DOUBLE", "35.0::DOUBLE", "", "25.0::DOUBLE", "1.0::DOUBLE")
    + " AS lowest, "
    + _band_sql("20.0::DOUBLE", "45.0::DOUBLE", "", "35.0::DOUBLE", "1.0::DOUBLE")
    + " AS highest FROM ml_bookings",
    ("ml_bookings",),
)
def _(t):
    low, high = trip_model.speed_band()
    return t.ml_bookings.select("trip_id", low.alias("lowest"), high.alias("highest"))


@query("fx_cancel", "SELECT trip_id, round(cancel_probability, 6) AS chance FROM ml_chances", ("ml_chances",))
def _(t):
    return t.ml_samples.select("trip_id", F.round(trip_model.cancel_probability(), 6).alias("chance"))


@query("fx_rating", "SELECT trip_id, round(expected_rating, 6) AS stars FROM ml_chances", ("ml_chances",))
def _(t):
    return t.ml_samples.select("trip_id", F.round(trip_model.expected_rating(), 6).alias("stars"))


@query(
    "fx_flags",
    "SELECT trip_id, is_cancelled, rating, is_weekend, is_rush_hour, is_night, fare_per_km, is_airport_trip "
    "FROM ml_samples",
    ("ml_samples",),
)
def _(t):
    return t.ml_samples.select(
        "trip_id", "is_cancelled", "rating", "is_weekend", "is_rush_hour", "is_night", "fare_per_km", "is_airport_trip"
    )


@query(
    "fx_buysell",
    "SELECT CreatedTime, Type, Amount * CAST(Type = 'BUY' AS INTEGER) AS Buy, "
    "Amount * CAST(Type = 'SELL' AS INTEGER) AS Sell FROM trades",
    ("trades",),
)
def _(t):
    return trip_model.buy_sell(t.trades).select("CreatedTime", "Type", "Buy", "Sell")


# --- booking windows -------------------------------------------------------------------------

@query(
    "bk_operational",
    f"""SELECT window_start, window_end, pickup_district, requested_taxi_type, count(*) AS booking_count,
  avg(estimated_fare) AS avg_fare, avg(estimated_distance) AS avg_distance,
  avg(priority_score) AS avg_priority, sum(estimated_fare) AS total_revenue,
  avg(estimated_duration_minutes) AS avg_duration,
  count(DISTINCT passenger_id) AS unique_passengers
  FROM {windows('enriched', 'event_time', 300, 60)} GROUP BY ALL""",
    ("enriched",),
    digits={"avg_fare": 9, "avg_distance": 9, "avg_priority": 9, "total_revenue": 6, "avg_duration": 9},
)
def _(t):
    return B.bk_operational(enriched(t), exact=True)


@query(
    "bk_customer",
    f"""SELECT window_start, window_end, membership_status, time_category, count(*) AS bookings,
  avg(estimated_fare) AS avg_fare, sum(estimated_fare) AS revenue,
  count(DISTINCT passenger_id) AS unique_customers, avg(priority_score) AS avg_priority,
  avg(estimated_distance) AS avg_distance
  FROM {windows('enriched', 'event_time', 600)} GROUP BY ALL""",
    ("enriched",),
    digits={"avg_fare": 9, "revenue": 6, "avg_priority": 9, "avg_distance": 9},
)
def _(t):
    return B.bk_customer(enriched(t), exact=True)


@query(
    "bk_surge",
    f"""SELECT window_start, window_end, pickup_district, route_type, count(*) AS surge_bookings,
  avg(surge_multiplier) AS avg_surge, max(surge_multiplier) AS max_surge,
  sum(estimated_fare) AS surge_revenue, avg(priority_score) AS avg_priority_surge
  FROM {windows('enriched', 'event_time', 300)} WHERE surge_multiplier > 1 GROUP BY ALL""",
    ("enriched",),
    digits={"avg_surge": 9, "surge_revenue": 6, "avg_priority_surge": 9},
)
def _(t):
    return B.bk_surge(enriched(t))


@query(
    "bk_routes",
    f"""SELECT window_start, window_end, pickup_district, dropoff_district, distance_category,
  count(*) AS trip_count, avg(estimated_fare) AS avg_route_fare,
  avg(estimated_distance) AS avg_route_distance, avg(estimated_duration_minutes) AS avg_duration
  FROM {windows('enriched', 'event_time', 900)} GROUP BY ALL HAVING count(*) > 2""",
    ("enriched",),
    digits={"avg_route_fare": 9, "avg_route_distance": 9, "avg_duration": 9},
)
def _(t):
    return B.bk_routes(enriched(t))


_COUNT = "SELECT window_start, window_end, count(*) AS count FROM "


@query("bw_tumble", f"{_COUNT} {windows('bookings', 'event_time', 600)} GROUP BY ALL", ("bookings",))
def _(t):
    return B.bw_tumble(t.bookings, "event_time")


@query("bw_slide", f"{_COUNT} {windows('bookings', 'event_time', 6000, 600)} GROUP BY ALL", ("bookings",))
def _(t):
    return B.bw_slide(t.bookings, "event_time")


def _located(t: Tables) -> DataFrame:
    return t.bookings.withColumnsRenamed({"pickup_district": "pickup_location", "event_time": "timestamp"})


@query(
    "bw_location",
    "SELECT pickup_district AS pickup_location, count(*) AS count FROM bookings GROUP BY ALL",
    ("bookings",),
)
def _(t):
    return B.bw_location(_located(t))


@query(
    "bw_minute",
    "SELECT window_start, window_end, pickup_district AS pickup_location, count(*) AS count FROM "
    f"{windows('bookings', 'event_time', 60)} GROUP BY ALL",
    ("bookings",),
)
def _(t):
    return B.bw_minute(_located(t))


# --- joins -----------------------------------------------------------------------------------

@query(
    "jn_stream_static",
    "SELECT Sno, TaxiNumber, TaxiType, TaxiID FROM trips LEFT JOIN taxis USING (TaxiNumber)",
    ("trips", "taxis"),
)
def _(t):
    dim = t.taxis.select("TaxiNumber", "TaxiType", "TaxiID")
    return J.lookup(t.trips, dim, "TaxiNumber").select("Sno", "TaxiNumber", "TaxiType", "TaxiID")


@query(
    "jn_using",
    "SELECT TaxiNumber, NumberOfPassengers, TaxiPassengerCapacity, count(*) AS trips FROM trips "
    "LEFT JOIN taxis USING (TaxiNumber) GROUP BY ALL",
    ("trips", "taxis"),
)
def _(t):
    joined = J.join_capacity(t.trips, t.taxis)
    return joined.groupBy("TaxiNumber", "NumberOfPassengers", "TaxiPassengerCapacity").agg(
        F.count(F.lit(1)).alias("trips")
    )


@query(
    "jn_ref_anti",
    "SELECT DISTINCT TaxiNumber FROM trips WHERE TaxiNumber NOT IN (SELECT TaxiNumber FROM taxis)",
    ("trips", "taxis"),
)
def _(t):
    return J.missing_keys(t.trips, t.taxis, "TaxiNumber")


@query(
    "set_diff",
    "SELECT passenger_id FROM bookings EXCEPT SELECT PassengerID FROM passengers",
    ("bookings", "passengers"),
)
def _(t):
    return J.key_difference(t.bookings, t.passengers, "passenger_id", "PassengerID")


@query(
    "jn_dim_explode",
    "SELECT TaxiID AS Sno, TaxiNumber, TaxiType, 'Make ' || (TaxiID % 7) AS TaxiMakeModel, TaxiPassengerCapacity, "
    "'Yellow' AS TaxiColor, 'TM' || TaxiID AS TMDTID, "
    "CASE WHEN n IS NOT NULL THEN 'Driver ' || TaxiID || '-' || n END AS DriverName, "
    "90000000 + TaxiID * 10 + n AS DriverPhone "
    "FROM all_taxis LEFT JOIN generate_series(1, 3) s(n) ON n <= TaxiID % 4",
    ("all_taxis",),
)
def _(t):
    key = F.col("TaxiID")
    count = (key % 4).cast("int")
    drivers = F.transform(
        F.sequence(F.lit(1), F.greatest(count, F.lit(1))),
        lambda at: F.struct(
            F.concat(F.lit("Driver "), key.cast("string"), F.lit("-"), at.cast("string")).alias("DriverName"),
            (key * 10 + at + 90_000_000).alias("DriverPhone"),
        ),
    )
    nested = t.all_taxis.select(
        key.alias("Sno"),
        "TaxiNumber",
        "TaxiType",
        F.struct(
            F.concat(F.lit("Make "), (key % 7).cast("string")).alias("TaxiMakeModel"),
            "TaxiPassengerCapacity",
            F.lit("Yellow").alias("TaxiColor"),
        ).alias("TaxiFeature"),
        F.concat(F.lit("TM"), key.cast("string")).alias("TMDTID"),
        F.when(count > 0, drivers).alias("RegisteredDrivers"),
    )
    return J.taxi_drivers(nested)


# --- time and views --------------------------------------------------------------------------

@query(
    "sc_datepart",
    "SELECT event_id, hour(ts) AS hour_of_day, dayofweek(ts) + 1 AS day_of_week FROM events",
)
def _(t):
    return time_parts(t.table("events"), "ts").select("event_id", "hour_of_day", "day_of_week")
