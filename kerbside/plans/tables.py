"""The driver's tables seen as bookings, trips, trades and their dimensions.

Every view is a projection of one table (``trips`` can join orders for the passenger), built with
integer arithmetic so that another engine can derive the same rows. The same code serves batch and
streaming: a streaming ``Tables`` reads the same parquet folder as a stream.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.functions import trip_model
from kerbside.functions.scalars import time_parts
from kerbside.operators.enrich import join_passengers, passenger_defaults
from kerbside.schemas import TIER_COLUMN
from kerbside.session import stored, use_utc
from kerbside.sources.files import load, load_stream

DISTRICTS = tuple(trip_model.DISTRICTS)
TYPE_OF_EVENT = {"click": "Standard", "view": "Mini Cab", "purchase": "Premier", "signup": "Maxi Cab"}
TIER_OF_SEGMENT = {"BUILDING": "Gold", "AUTOMOBILE": "Silver"}
PAYMENTS = ("Cash", "Card", "Digital Wallet", "Corporate")
TAXI_TYPES = ("Mini Cab", "Standard", "Premier", "Maxi Cab", "Limosine")

# Events are one per 4.3 minutes; a sixth of that, from Thursday 2024-01-04, fills short windows.
FIRST_EVENT_US = 1_704_067_200_000_000
FIRST_TRIP_US = 1_704_326_400_000_000
SQUEEZE = 6


def pick(entries: tuple[str, ...], place: str) -> str:
    """SQL for the entry at a zero-based place."""
    listed = ", ".join(f"'{entry}'" for entry in entries)
    return f"element_at(array({listed}), cast({place} % {len(entries)} + 1 as int))"


def named(table: dict, value: str, default: str) -> str:
    """SQL for a lookup in a short fixed table."""
    arms = " ".join(f"WHEN '{key}' THEN '{entry}'" for key, entry in table.items())
    return f"CASE {value} {arms} ELSE '{default}' END"


PICKUP = pick(DISTRICTS, "user_id")
DROPOFF = pick(DISTRICTS, "(user_id + event_id % 3)")
TAXI_OF_EVENT = named(TYPE_OF_EVENT, "event_type", "Limosine")
PROCESSED = "timestamp_micros(unix_micros(et) + event_id % 400 * 1000000)"


class Tables:
    """Views over one folder of parquet tables."""

    def __init__(self, spark: SparkSession, folder: str, stream: bool = False):
        self.spark = use_utc(spark)
        self.folder = folder
        self.stream = stream

    def table(self, name: str) -> DataFrame:
        return load(self.spark, self.folder, name)

    @cached_property
    def events(self) -> DataFrame:
        """Events with the squeezed event time ``et`` and the number in ``props`` as ``k``."""
        raw = load_stream(self.spark, self.folder, "events") if self.stream else self.table("events")
        since = f"(unix_micros(cast(ts as timestamp)) - {FIRST_EVENT_US}) div {SQUEEZE}"
        return raw.selectExpr(
            "*", f"timestamp_micros({FIRST_TRIP_US} + {since}) AS et", "from_json(props, 'k int').k AS k"
        )

    @cached_property
    def bookings(self) -> DataFrame:
        rows = self.events.selectExpr(
            "concat('BK', event_id) AS booking_id",
            "et AS event_time",
            f"{PROCESSED} AS processing_time",
            "user_id AS passenger_id",
            f"{PICKUP} AS pickup_district",
            f"{DROPOFF} AS dropoff_district",
            f"{TAXI_OF_EVENT} AS requested_taxi_type",
            "event_id % 6 + 1 AS num_passengers",
            "k / 4.0D AS estimated_distance",
            "(event_id % 15 + 10) / 10.0D AS surge_multiplier",
            f"{pick(PAYMENTS, 'event_id')} AS payment_method",
            "'Pending' AS booking_status",
            "CASE WHEN event_id % 10 = 0 THEN 'Child Seat' END AS special_requirements",
            "CASE event_id % 20 WHEN 0 THEN 'VIP' WHEN 5 THEN 'High' ELSE 'Normal' END AS priority_level",
        )
        return time_parts(rows, "event_time")

    @cached_property
    def trips_events(self) -> DataFrame:
        return self.events.selectExpr(
            "concat('T', user_id, '-', event_id % 2) AS trip_id",
            "et AS event_timestamp",
            f"{PROCESSED} AS processing_timestamp",
            f"{PICKUP} AS pickup_district",
            f"{DROPOFF} AS dropoff_district",
            "k + event_id % 4 * 0.25D AS distance_km",
            "event_id * 7 % 3600 + 60 AS duration_seconds",
            "value AS fare_amount",
            f"{TAXI_OF_EVENT} AS taxi_type",
            "event_id % 6 + 1 AS passenger_count",
            "CASE WHEN event_id % 13 = 0 THEN true END AS is_late_data",
            "CASE WHEN event_id % 13 = 0 THEN event_id % 26 + 5 END AS late_by_minutes",
        )

    @cached_property
    def all_passengers(self) -> DataFrame:
        return self.table("customer").selectExpr(
            "c_custkey AS PassengerID",
            "c_name AS PassengerName",
            f"{named(TIER_OF_SEGMENT, 'c_mktsegment', 'Standard')} AS {TIER_COLUMN}",
            "c_custkey % 53 + 18 AS Age",
            "CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS Gender",
            "c_acctbal AS AmountSpent",
            "c_mktsegment AS Address",
        )

    @cached_property
    def passengers(self) -> DataFrame:
        """Every tenth customer is left out, so that some bookings have no passenger."""
        return self.all_passengers.filter("PassengerID % 10 <> 0")

    @cached_property
    def all_taxis(self) -> DataFrame:
        return self.table("supplier").selectExpr(
            "s_suppkey AS TaxiID",
            "s_name AS TaxiNumber",
            f"{pick(TAXI_TYPES, 's_suppkey')} AS TaxiType",
            "s_suppkey % 6 + 3 AS TaxiPassengerCapacity",
        )

    @cached_property
    def taxis(self) -> DataFrame:
        """Every 25th is left out, so that some trips and drivers refer to no taxi."""
        return self.all_taxis.filter("TaxiID % 25 <> 0")

    @cached_property
    def drivers(self) -> DataFrame:
        return self.table("supplier").selectExpr(
            "s_suppkey AS DriverID",
            "concat('Driver ', s_suppkey) AS DriverName",
            "s_suppkey AS TaxiIDDriving",
            "s_suppkey % 55 / 10.0D AS Rating",
        )

    def _trips(self, items: DataFrame, *others: str) -> DataFrame:
        return items.selectExpr(
            "l_orderkey * 10 + l_linenumber AS Sno",
            "l_orderkey",
            "concat('Supplier#', lpad(l_suppkey, 9, '0')) AS TaxiNumber",
            "l_quantity AS DistanceTravelled",
            "cast(floor(l_extendedprice) as int) % 7200 AS TripDurationInSeconds",
            "l_extendedprice / 1000.0D AS TripFare",
            "l_linenumber AS NumberOfPassengers",
            *others,
        )

    @cached_property
    def trips(self) -> DataFrame:
        """Trips without their passenger: a projection of line items, no join."""
        return self._trips(self.table("lineitem"))

    @cached_property
    def passenger_trips(self) -> DataFrame:
        """Trips are made behind the join, so that the few numbers they come from are shuffled and not their texts."""
        items = self.table("lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice")
        orders = self.table("orders").selectExpr("o_orderkey", "o_custkey AS PassengerID")
        joined = items.join(orders, items["l_orderkey"] == orders["o_orderkey"], "left")
        return self._trips(joined, "PassengerID").drop("l_orderkey")

    @cached_property
    def trades(self) -> DataFrame:
        return self.events.filter("event_type IN ('purchase', 'signup')").selectExpr(
            "et AS CreatedTime",
            "CASE event_type WHEN 'purchase' THEN 'BUY' ELSE 'SELL' END AS Type",
            "cast(floor(value) as int) AS Amount",
            "concat('B', user_id % 5) AS BrokerCode",
        )

    @cached_property
    def sensors(self) -> DataFrame:
        return self.events.selectExpr(
            "et AS CreatedTime", "concat('sensor_', user_id % 3 + 1) AS SensorID", "value AS Reading"
        )

    @cached_property
    def messages(self) -> DataFrame:
        """Rows shaped like those of a message broker."""
        return self.events.selectExpr(
            "cast(concat('user-', user_id) as binary) AS key",
            "cast(props as binary) AS value",
            "'events' AS topic",
            "cast(user_id % 3 as int) AS partition",
            "event_id AS offset",
            "et AS timestamp",
        )

    @cached_property
    def device_messages(self) -> DataFrame:
        """Nested JSON payloads with 0 to 3 devices each."""
        devices = """transform(sequence(1, 3), n -> named_struct(
            'deviceId', concat('D-', user_id, '-', n), 'measure', 'C',
            'status', CASE WHEN n = 2 THEN 'ERROR' ELSE 'SUCCESS' END,
            'temperature', cast(floor(value) as long) + n))"""
        body = f"""named_struct('customerId', concat('C', user_id),
            'data', named_struct('devices', slice({devices}, 1, cast(event_id % 4 as int))),
            'eventId', concat('E', event_id), 'eventOffset', event_id, 'eventPublisher', 'device',
            'eventTime', date_format(et, 'yyyy-MM-dd HH:mm:ss'))"""
        return self.events.selectExpr(f"cast(to_json({body}) as binary) AS value")

    @cached_property
    def tweets(self) -> DataFrame:
        return self.table("documents").selectExpr(
            "cast(doc_id as string) AS tweet_id",
            "concat('@', source) AS user_handle",
            "text",
            "CASE WHEN doc_id % 7 <> 0 THEN lang END AS language",
            "doc_id * 1000 AS created_at",
            "CASE WHEN doc_id % 3 <> 0 THEN cast(doc_id % 50 as int) END AS retweet_count",
            "CASE WHEN doc_id % 5 <> 0 THEN cast(n_chars % 100 as int) END AS like_count",
        )

    @cached_property
    def ml_bookings(self) -> DataFrame:
        """Bookings with the sample columns that need no formula."""
        rider = passenger_defaults(join_passengers(self.bookings, self.passengers))
        return rider.withColumn("event_id", F.expr("cast(substring(booking_id, 3) as long)")).selectExpr(
            "concat('TRIP_', event_id) AS trip_id",
            "event_id",
            "pickup_district",
            "dropoff_district",
            "estimated_distance + 1.0D AS distance",
            "(estimated_distance + 1.0D) * 2.0D + 5 + event_id % 11 AS duration_minutes",
            "hour_of_day AS hour",
            "(day_of_week + 5) % 7 AS day_of_week",
            "surge_multiplier",
            "requested_taxi_type AS taxi_type",
            "membership_status AS membership",
            "payment_method",
            "num_passengers",
            "passenger_age AS customer_age",
            "passenger_gender AS customer_gender",
            "passenger_id % 500 + 1 AS historical_trips",
            "total_spent_history AS historical_spent",
        )

    @cached_property
    def ml_samples(self) -> DataFrame:
        priced = self.ml_bookings.withColumn("fare", F.round(trip_model.model_fare(), 2))
        labelled = priced.withColumns(
            {
                "is_cancelled": F.expr("event_id * 37 % 100 / 100.0D") < trip_model.cancel_probability(),
                "rating": F.round(trip_model.expected_rating(), 1),
            }
        )
        return trip_model.trip_flags(labelled)

    @cached_property
    def stored_samples(self) -> DataFrame:
        """The samples in a table of their own. Models read them dozens of times, and each time the passengers would be
        collected for the join and the formulas worked out anew."""
        return stored(self.ml_samples, "samples")
