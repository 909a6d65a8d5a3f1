"""Record layouts of the message payloads and reference tables, as DDL strings."""

from __future__ import annotations

BOOKING = (
    "booking_id string, timestamp string, passenger_id int, pickup_district string, dropoff_district string, "
    "booking_time string, requested_taxi_type string, num_passengers int, estimated_distance double, "
    "surge_multiplier double, payment_method string, booking_status string, special_requirements string, "
    "priority_level string"
)

TAXI_TRIP = (
    "trip_id string, event_time string, processing_time string, pickup_district string, dropoff_district string, "
    "distance_km double, duration_seconds int, fare_amount double, taxi_type string, taxi_capacity int, "
    "passenger_count int, hour_of_day int, day_of_week string, is_late_data boolean, late_by_minutes int"
)

WIDE_BOOKING = (
    "BookingID string, MessageSubmittedTime long, MessageReceivedTime long, CustomerID string, CustomerName string, "
    "PhoneNumber string, PickUpLocation string, PickupPostcode string, PickUpTime string, DropLocation string, "
    "DropPostcode string, TaxiType string, FareType string, Fare double"
)

SIMPLE_BOOKING = (
    "booking_id string, customer_id string, pickup_location string, dropoff_location string, timestamp string"
)

TRADE = ("CreatedTime string, Type string, Amount int, BrokerCode string")

SENSOR = ("CreatedTime string, Reading double")

SENSOR_MESSAGE = ("sensor_id string, creation_time timestamp, temperature int")

SENSOR_READING = (
    "reading_id string, sensor_id string, location string, temperature double, humidity double, timestamp long"
)

DEVICE_EVENT = (
    "customerId string, data struct<devices: array<struct<deviceId: string, measure: string, status: string, "
    "temperature: long>>>, eventId string, eventOffset long, eventPublisher string, eventTime string"
)

APP_EVENT = (
    "event_id string, event_type string, user_id string, page string, session_duration_s int, timestamp string"
)

TIMED_VALUE = ("event_time timestamp, value string")

TWEET = (
    "tweet_id string, user_handle string, text string, language string, created_at long, retweet_count int, "
    "like_count int"
)

# Fixed format: the Avro record written by telemetry producers.
TELEMETRY_AVRO = """{"type": "record", "name": "TelemetryEvent", "namespace": "com.example.telemetry", "fields": [
  {"name": "event_id", "type": "string"},
  {"name": "device_id", "type": "string"},
  {"name": "metric", "type": "string"},
  {"name": "value", "type": "double"},
  {"name": "timestamp", "type": "long", "logicalType": "timestamp-millis"}]}"""

# The membership tier column of passenger files has this spelling.
TIER_COLUMN = "MemSilvererStGoldtus"

TAXI = (
    "TaxiID long, TaxiNumber string, TaxiType string, TaxiMakeModel string, TaxiPassengerCapacity long, "
    "TaxiColor string, TMDTID string"
)

NESTED_TAXI = (
    "Sno long, TaxiNumber string, TaxiType string, TaxiFeature struct<TaxiMakeModel: string, "
    "TaxiPassengerCapacity: long, TaxiColor: string>, TMDTID string, RegisteredDrivers array<struct<"
    "DriverName: string, DriverPhone: long>>"
)

DRIVER = ("DriverID long, DriverName string, DriverPhone long, TaxiIDDriving long, Rating double")

PASSENGER = (
    f"PassengerID long, PassengerName string, {TIER_COLUMN} string, Age long, Gender string, AmountSpent double, "
    "Address string, ContactTitle string, Phone long"
)
