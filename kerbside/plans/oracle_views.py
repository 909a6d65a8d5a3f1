"""The views of ``tables.py`` and the booking rules, written for DuckDB.

Kept apart from the Spark code on purpose: rules are spelled as lookup tables and arithmetic here,
so that an error in one side does not repeat itself in the other.
"""

from __future__ import annotations


def half_up(value: str, digits: int) -> str:
    """Round the shortest decimal form of a double half up, as Spark does."""
    return f"CAST(round(CAST(CAST(({value}) AS VARCHAR) AS DECIMAL(38, 18)), {digits}) AS DOUBLE)"


def steady(value: str) -> str:
    """A sum or mean without the last bits, which depend on the order of the rows."""
    return half_up(value, 9)


def windows(rows: str, ts: str, length: int, slide: int | None = None) -> str:
    """Rows of a view repeated per window (seconds), with window_start and window_end."""
    slide = slide or length
    copies = length // slide
    return (
        f"(SELECT v.*, make_timestamp((epoch_us(v.{ts}) // {slide}000000 - g.n) * {slide}000000) AS window_start, "
        f"make_timestamp((epoch_us(v.{ts}) // {slide}000000 - g.n) * {slide}000000 + {length}000000) AS window_end "
        f"FROM {rows} v, (SELECT unnest(generate_series(0, {copies - 1})) AS n) g WHERE v.{ts} IS NOT NULL)"
    )


_DISTRICT_LIST = (
    "['Central', 'Orchard', 'Marina Bay', 'Chinatown', 'Jurong East', 'Tampines', 'Woodlands', "
    "'Changi Airport', 'Sentosa']"
)
_TAXI_OF_EVENT = (
    "CASE event_type WHEN 'click' THEN 'Standard' WHEN 'view' THEN 'Mini Cab' WHEN 'purchase' THEN 'Premier' "
    "WHEN 'signup' THEN 'Maxi Cab' ELSE 'Limosine' END"
)


def _enriched(night_hours: str) -> str:
    """Bookings with all derived columns; ``night_hours`` is a list of the hours seen as night."""
    fare = (
        "(3.5::DOUBLE + b.estimated_distance * 2.2::DOUBLE "
        "+ CASE WHEN list_contains([6,7,8,9,17,18,19,20], b.hour_of_day) THEN 2.0::DOUBLE "
        f"WHEN list_contains({night_hours}, b.hour_of_day) THEN 1.5::DOUBLE ELSE 0.0::DOUBLE END "
        "+ CASE WHEN b.day_of_week = 1 OR b.day_of_week = 7 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) "
        "* b.surge_multiplier * coalesce(tr.factor, 1.0::DOUBLE) * coalesce(mr.factor, 1.0::DOUBLE) "
        "* CASE WHEN b.special_requirements IS NULL THEN 1.0::DOUBLE ELSE 1.1::DOUBLE END"
    )
    duration = (
        "b.estimated_distance / CASE WHEN list_contains([7,8,9,17,18,19], b.hour_of_day) THEN 15.0::DOUBLE "
        f"WHEN list_contains({night_hours}, b.hour_of_day) THEN 35.0::DOUBLE ELSE 25.0::DOUBLE END * 60 "
        "+ CASE WHEN 'Changi Airport' IN (b.pickup_district, b.dropoff_district) THEN 10 ELSE 5 END"
    )
    return f"""
SELECT b.booking_id, b.event_time, b.processing_time, b.passenger_id,
  coalesce(p.PassengerName, 'Unknown Passenger') AS passenger_name,
  coalesce(p.tier, 'Standard') AS membership_status,
  coalesce(p.AmountSpent, 0.0) AS total_spent_history,
  coalesce(p.Age, 30) AS passenger_age,
  coalesce(p.Gender, 'U') AS passenger_gender,
  b.pickup_district, b.dropoff_district, b.requested_taxi_type, b.num_passengers, b.estimated_distance,
  b.surge_multiplier, b.payment_method, b.special_requirements, b.priority_level, b.hour_of_day, b.day_of_week,
  {half_up(fare, 2)} AS estimated_fare,
  CASE WHEN list_contains([7,8,9,17,18,19], b.hour_of_day) THEN 'RUSH_HOUR'
       WHEN list_contains({night_hours}, b.hour_of_day) THEN 'NIGHT'
       WHEN b.day_of_week = 1 OR b.day_of_week = 7 THEN 'WEEKEND' ELSE 'REGULAR' END AS time_category,
  CASE WHEN b.estimated_distance IS NULL OR b.estimated_distance > 25 THEN 'EXTRA_LONG'
       WHEN b.estimated_distance > 15 THEN 'LONG' WHEN b.estimated_distance >= 5 THEN 'MEDIUM'
       ELSE 'SHORT' END AS distance_category,
  CASE WHEN 'Changi Airport' IN (b.pickup_district, b.dropoff_district) THEN 'AIRPORT'
       WHEN list_has_all(['Central', 'Orchard', 'Marina Bay'], [b.pickup_district, b.dropoff_district])
         THEN 'CITY_CENTER'
       WHEN b.pickup_district = b.dropoff_district THEN 'LOCAL' ELSE 'CROSS_DISTRICT' END AS route_type,
  coalesce(lp.points, 0) + coalesce(mr.points, 0)
    + CASE WHEN b.surge_multiplier > 2 THEN 15 WHEN b.surge_multiplier > 1.5 THEN 10
           WHEN b.surge_multiplier > 1.2 THEN 5 ELSE 0 END
    + CASE WHEN b.num_passengers > 4 THEN 8 WHEN b.num_passengers > 2 THEN 3 ELSE 0 END
    + CASE WHEN b.special_requirements IS NULL THEN 0 ELSE 5 END
    + CASE WHEN b.estimated_distance > 20 THEN 10 WHEN b.estimated_distance > 10 THEN 5 ELSE 0 END
    AS priority_score,
  {half_up(duration, 0)} AS estimated_duration_minutes
FROM bookings b
LEFT JOIN passengers p ON p.PassengerID = b.passenger_id
LEFT JOIN (VALUES ('Premier', 1.5::DOUBLE), ('Limosine', 2.0::DOUBLE), ('Maxi Cab', 1.3::DOUBLE),
  ('Mini Cab', 0.9::DOUBLE)) tr(name, factor) ON tr.name = b.requested_taxi_type
LEFT JOIN (VALUES ('Gold', 0.85::DOUBLE, 15), ('Silver', 0.92::DOUBLE, 8)) mr(name, factor, points) ON mr.name = p.tier
LEFT JOIN (VALUES ('VIP', 20), ('High', 10)) lp(name, points) ON lp.name = b.priority_level"""


_ROAD_RUSH = "[7,8,9,17,18,19]"
_LATE_HOURS = "[22,23,0,1,2,3,4,5,6]"

_VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "ev": (
        (),
        "SELECT *, make_timestamp(1704326400000000 + (epoch_us(ts) - 1704067200000000) // 6) AS et, "
        "CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events",
    ),
    "bookings": (
        ("ev",),
        f"""SELECT 'BK' || event_id AS booking_id, et AS event_time,
  et + to_seconds(event_id % 400) AS processing_time, user_id AS passenger_id,
  {_DISTRICT_LIST}[user_id % 9 + 1] AS pickup_district,
  {_DISTRICT_LIST}[(user_id + event_id % 3) % 9 + 1] AS dropoff_district,
  {_TAXI_OF_EVENT} AS requested_taxi_type, event_id % 6 + 1 AS num_passengers,
  k / 4.0::DOUBLE AS estimated_distance, (event_id % 15 + 10) / 10.0::DOUBLE AS surge_multiplier,
  ['Cash', 'Card', 'Digital Wallet', 'Corporate'][event_id % 4 + 1] AS payment_method,
  'Pending' AS booking_status,
  CASE WHEN event_id % 10 = 0 THEN 'Child Seat' END AS special_requirements,
  CASE event_id % 20 WHEN 0 THEN 'VIP' WHEN 5 THEN 'High' ELSE 'Normal' END AS priority_level,
  hour(et) AS hour_of_day, dayofweek(et) + 1 AS day_of_week FROM ev""",
    ),
    "trips_events": (
        ("ev",),
        f"""SELECT 'T' || user_id || '-' || (event_id % 2) AS trip_id, et AS event_timestamp,
  et + to_seconds(event_id % 400) AS processing_timestamp,
  {_DISTRICT_LIST}[user_id % 9 + 1] AS pickup_district,
  {_DISTRICT_LIST}[(user_id + event_id % 3) % 9 + 1] AS dropoff_district,
  k + (event_id % 4) * 0.25::DOUBLE AS distance_km, event_id * 7 % 3600 + 60 AS duration_seconds,
  value AS fare_amount, {_TAXI_OF_EVENT} AS taxi_type, event_id % 6 + 1 AS passenger_count,
  CASE WHEN event_id % 13 = 0 THEN true END AS is_late_data,
  CASE WHEN event_id % 13 = 0 THEN event_id % 26 + 5 END AS late_by_minutes FROM ev""",
    ),
    "all_passengers": (
        (),
        """SELECT c_custkey AS PassengerID, c_name AS PassengerName,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'Gold' WHEN 'AUTOMOBILE' THEN 'Silver' ELSE 'Standard' END AS tier,
  c_custkey % 53 + 18 AS Age, CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS Gender,
  c_acctbal AS AmountSpent, c_mktsegment AS Address FROM customer""",
    ),
    "passengers": (("all_passengers",), "SELECT * FROM all_passengers WHERE PassengerID % 10 <> 0"),
    "all_taxis": (
        (),
        """SELECT s_suppkey AS TaxiID, s_name AS TaxiNumber,
  ['Mini Cab', 'Standard', 'Premier', 'Maxi Cab', 'Limosine'][s_suppkey % 5 + 1] AS TaxiType,
  s_suppkey % 6 + 3 AS TaxiPassengerCapacity FROM supplier""",
    ),
    "taxis": (("all_taxis",), "SELECT * FROM all_taxis WHERE TaxiID % 25 <> 0"),
    "drivers": (
        (),
        """SELECT s_suppkey AS DriverID, 'Driver ' || s_suppkey AS DriverName, s_suppkey AS TaxiIDDriving,
  s_suppkey % 55 / 10.0::DOUBLE AS Rating FROM supplier""",
    ),
    "trips": (
        (),
        """SELECT l_orderkey * 10 + l_linenumber AS Sno, o_custkey AS PassengerID, s_name AS TaxiNumber,
  l_quantity AS DistanceTravelled, CAST(floor(l_extendedprice) AS INTEGER) % 7200 AS TripDurationInSeconds,
  l_extendedprice / 1000.0::DOUBLE AS TripFare, l_linenumber AS NumberOfPassengers
  FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey LEFT JOIN supplier ON s_suppkey = l_suppkey""",
    ),
    "trades": (
        ("ev",),
        """SELECT et AS CreatedTime, CASE event_type WHEN 'purchase' THEN 'BUY' ELSE 'SELL' END AS Type,
  CAST(floor(value) AS INTEGER) AS Amount, 'B' || (user_id % 5) AS BrokerCode
  FROM ev WHERE event_type IN ('purchase', 'signup')""",
    ),
    "sensors": (
        ("ev",),
        "SELECT et AS CreatedTime, 'sensor_' || (user_id % 3 + 1) AS SensorID, value AS Reading FROM ev",
    ),
    "devices": (
        ("ev",),
        """SELECT 'C' || user_id AS customerId, 'E' || event_id AS eventId, event_id AS eventOffset,
  'device' AS eventPublisher, strftime(et, '%Y-%m-%d %H:%M:%S') AS eventTime,
  'D-' || user_id || '-' || n AS deviceId, 'C' AS measure,
  CASE WHEN n = 2 THEN 'ERROR' ELSE 'SUCCESS' END AS status, CAST(floor(value) AS BIGINT) + n AS temperature
  FROM ev, generate_series(1, 3) s(n) WHERE n <= event_id % 4""",
    ),
    "tweets": (
        (),
        """SELECT CAST(doc_id AS VARCHAR) AS tweet_id, '@' || source AS user_handle, text,
  CASE WHEN doc_id % 7 <> 0 THEN lang END AS language, doc_id * 1000 AS created_at,
  CASE WHEN doc_id % 3 <> 0 THEN doc_id % 50 END AS retweet_count,
  CASE WHEN doc_id % 5 <> 0 THEN n_chars % 100 END AS like_count FROM documents""",
    ),
    "enriched": (("bookings", "passengers"), _enriched("[]::INTEGER[]")),
    "enriched_wrap": (("bookings", "passengers"), _enriched(_LATE_HOURS)),
    "ml_bookings": (
        ("enriched",),
        """SELECT 'TRIP_' || substr(booking_id, 3) AS trip_id, CAST(substr(booking_id, 3) AS BIGINT) AS event_id,
  pickup_district, dropoff_district, estimated_distance + 1.0::DOUBLE AS distance,
  (estimated_distance + 1.0::DOUBLE) * 2.0::DOUBLE + 5 + CAST(substr(booking_id, 3) AS BIGINT) % 11
    AS duration_minutes,
  hour_of_day AS hour, (day_of_week + 5) % 7 AS day_of_week, surge_multiplier, requested_taxi_type AS taxi_type,
  membership_status AS membership, payment_method, num_passengers, passenger_age AS customer_age,
  passenger_gender AS customer_gender, passenger_id % 500 + 1 AS historical_trips,
  total_spent_history AS historical_spent FROM enriched""",
    ),
    "ml_fares": (
        ("ml_bookings",),
        f"""SELECT m.*, greatest(3.5::DOUBLE,
  (3.5::DOUBLE + distance * 2.2::DOUBLE
   + CASE WHEN list_contains({_ROAD_RUSH}, hour) THEN 2.0::DOUBLE
          WHEN list_contains({_LATE_HOURS}, hour) THEN 1.5::DOUBLE ELSE 0.0::DOUBLE END
   + CASE WHEN day_of_week IN (4, 5) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)
  * coalesce(tf.factor, 1.0::DOUBLE) * surge_multiplier * coalesce(mf.factor, 1.0::DOUBLE)
  + CASE WHEN num_passengers > 4 THEN 2.0::DOUBLE ELSE 0.0::DOUBLE END) AS model_fare
FROM ml_bookings m
LEFT JOIN (VALUES ('Premier', 1.5::DOUBLE), ('Limosine', 2.0::DOUBLE), ('Maxi Cab', 1.3::DOUBLE),
  ('Mini Cab', 0.9::DOUBLE)) tf(name, factor) ON tf.name = taxi_type
LEFT JOIN (VALUES ('Gold', 0.85::DOUBLE), ('Silver', 0.92::DOUBLE)) mf(name, factor) ON mf.name = membership""",
    ),
    "ml_priced": (("ml_fares",), f"SELECT *, {half_up('model_fare', 2)} AS fare FROM ml_fares"),
    "ml_chances": (
        ("ml_priced",),
        """SELECT *, least(0.4::DOUBLE,
  (0.05::DOUBLE + CASE WHEN surge_multiplier > 2.0 THEN 0.15::DOUBLE WHEN surge_multiplier > 1.5 THEN 0.08::DOUBLE
                       ELSE 0.0::DOUBLE END
   + CASE WHEN fare > 50 THEN 0.10::DOUBLE WHEN fare > 30 THEN 0.05::DOUBLE ELSE 0.0::DOUBLE END
   + CASE WHEN distance < 3 THEN 0.05::DOUBLE ELSE 0.0::DOUBLE END)
  * CASE membership WHEN 'Gold' THEN 0.5::DOUBLE WHEN 'Silver' THEN 0.7::DOUBLE ELSE 1.0::DOUBLE END)
    AS cancel_probability,
  least(5.0::DOUBLE, greatest(1.0::DOUBLE,
    CASE taxi_type WHEN 'Premier' THEN 4.5::DOUBLE WHEN 'Mini Cab' THEN 3.8::DOUBLE WHEN 'Maxi Cab' THEN 4.2::DOUBLE
                   WHEN 'Limosine' THEN 4.7::DOUBLE ELSE 4.0::DOUBLE END
    + CASE WHEN duration_minutes > (distance / 25 * 60 + 10) * 1.3::DOUBLE THEN -0.5::DOUBLE
           WHEN duration_minutes < (distance / 25 * 60 + 10) * 0.8::DOUBLE THEN 0.2::DOUBLE ELSE 0.0::DOUBLE END
    + CASE WHEN fare / distance > 8 THEN -0.3::DOUBLE ELSE 0.0::DOUBLE END
    + CASE WHEN membership = 'Gold' THEN 0.2::DOUBLE ELSE 0.0::DOUBLE END)) AS expected_rating
FROM ml_priced""",
    ),
    "ml_samples": (
        ("ml_chances",),
        f"""SELECT *, event_id * 37 % 100 / 100.0::DOUBLE < cancel_probability AS is_cancelled,
  {half_up('expected_rating', 1)} AS rating,
  CAST(day_of_week IN (5, 6) AS INTEGER) AS is_weekend,
  CAST(list_contains({_ROAD_RUSH}, hour) AS INTEGER) AS is_rush_hour,
  CAST(list_contains({_LATE_HOURS}, hour) AS INTEGER) AS is_night, fare / distance AS fare_per_km,
  CAST('Changi Airport' IN (pickup_district, dropoff_district) AS INTEGER) AS is_airport_trip FROM ml_chances""",
    ),
}


def with_views(select: str, *names: str) -> str:
    """Put the definitions of the named views, and of those they read, before a query."""
    order: list[str] = []

    def need(name: str) -> None:
        for parent in _VIEWS[name][0]:
            need(parent)
        if name not in order:
            order.append(name)

    for name in names:
        need(name)
    head = ", ".join(f"{name} AS ({_VIEWS[name][1]})" for name in order)
    return f"WITH {head} {select}" if head else select
