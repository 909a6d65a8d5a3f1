"""Batch = stream, late data, restarts, modes, sinks and control of queries."""

import json
import time

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from kerbside import schemas
from kerbside.operators import booking_windows as B
from kerbside.operators import decode as D
from kerbside.operators import enrich as E
from kerbside.operators import series_windows as S
from kerbside.operators import trip_windows as T
from kerbside.plans.stream_queries import append, complete, update
from kerbside.plans.tables import Tables
from kerbside.session import scratch_path, stream_session
from kerbside.sources import files
from kerbside.sources.messages import read_rate, read_rate_batches
from kerbside.streaming import runtime as R
from kerbside.streaming import sinks
from kerbside.streaming.jobs import BOOKING_QUERIES, start_bookings, start_bookings_once_read
from kerbside.streaming.late import late_rows
from kerbside.streaming.state import district_state, on_rocksdb
from tests.helpers import clock, rows, trade_lines, write_ordered

SMALL = "/root/testdata/sf0.001"
NOW = "available_now"


def enriched(t):
    return E.enrich_bookings(t.bookings, t.passengers)


REPORTS = {
    "tw_trips": lambda t: T.tw_trips(t.trips_events),
    "tw_districts": lambda t: T.tw_districts(t.trips_events),
    "tw_taxi_types": lambda t: T.tw_taxi_types(t.trips_events),
    "sw_trends": lambda t: T.sw_trends(t.trips_events).drop("unique_pickup_districts"),
    "sw_districts": lambda t: T.sw_districts(t.trips_events),
    "sw_performance": lambda t: T.sw_performance(t.trips_events),
    "sw_rush": lambda t: T.sw_rush(t.trips_events).drop("active_districts"),
    "wm_none": lambda t: T.wm_none(t.trips_events),
    "wm_lateness": lambda t: T.wm_lateness(t.trips_events),
    "bk_operational": lambda t: B.bk_operational(enriched(t)).drop("unique_passengers"),
    "bk_customer": lambda t: B.bk_customer(enriched(t)).drop("unique_customers"),
    "bk_surge": lambda t: B.bk_surge(enriched(t)),
    "bk_routes": lambda t: B.bk_routes(enriched(t), popular=1),
    "st_tumble": lambda t: S.st_tumble(t.trades),
    "st_by_type": lambda t: S.st_by_type(t.trades),
    "st_watermark": lambda t: S.st_watermark(t.trades),
    "se_slide_15": lambda t: S.se_slide_15(t.sensors),
    "bw_slide": lambda t: B.bw_slide(t.bookings, "event_time"),
    "ev_slide": lambda t: S.ev_slide(t.events.selectExpr("et AS event_time", "event_type AS value")),
}


@pytest.mark.parametrize("name", sorted(REPORTS))
def test_stream_in_complete_mode_equals_batch(spark, name):
    report = REPORTS[name]
    expected = rows(report(Tables(spark, SMALL)))
    streamed = complete(report(Tables(stream_session(spark), SMALL, stream=True)))
    assert expected and rows(streamed) == expected


def trade_stream(spark, folder):
    raw = files.read_json_stream(stream_session(spark), folder, schemas.TRADE, multiline=False, max_files=1)
    return D.event_time(raw, "CreatedTime", D.SECONDS)


def arrived(late, query):
    """Wait until the listener has heard of the query's last batch."""
    for _ in range(300):
        if late.seen.get(str(query.id), -1) >= query.lastProgress["batchId"]:
            return
        time.sleep(0.1)
    raise AssertionError("no progress arrived")


def test_late_rows_of_many_batches(spark, tmp_path):
    """More batches than Spark remembers, each with one late trade."""
    day = "2024-01-01 {:02d}:{:02d}:00"
    line = '{{"CreatedTime": "{}", "Type": "BUY", "Amount": 1, "BrokerCode": "A"}}'
    lines = [line.format(day.format(12, 0))] + [line.format(day.format(1, at % 60)) for at in range(119)]
    write_ordered(f"{tmp_path}/in", lines)
    path = scratch_path(spark, "late-many")
    late = R.LateRows()
    report = S.st_watermark(trade_stream(spark, f"{tmp_path}/in"))
    report.sparkSession.streams.addListener(late)
    try:
        query = sinks.to_snapshots(report, f"{path}/out", f"{path}/checkpoint", "update", NOW)
        query.awaitTermination()
        arrived(late, query)
        # Spark drops by the watermark that held in the batch before: a late row right behind the first batch is
        # still taken, unless an empty batch came between. Every late row is either taken or reported.
        found = sinks.latest_per_key(sinks.read_batches(spark, f"{path}/out"), ["start", "end"])
        taken = found.where("start < '2024-01-01 11:00:00'").agg(F.coalesce(F.sum("TotalBuy"), F.lit(0))).first()[0]
        assert taken <= 1
        assert len(query.recentProgress) <= 100 and late.of(query) + taken == 119
    finally:
        report.sparkSession.streams.removeListener(late)


def test_late_trade_is_dropped(spark, tmp_path):
    write_ordered(f"{tmp_path}/in", trade_lines())
    path = scratch_path(spark, "late")
    report = S.st_watermark(trade_stream(spark, f"{tmp_path}/in"))
    late = R.LateRows()
    report.sparkSession.streams.addListener(late)
    try:
        query = sinks.to_snapshots(report, f"{path}/out", f"{path}/checkpoint", "update", NOW)
        query.awaitTermination()
        arrived(late, query)
        assert late.of(query) == 1
    finally:
        report.sparkSession.streams.removeListener(late)
    found = sinks.latest_per_key(sinks.read_batches(spark, f"{path}/out"), ["start", "end"]).orderBy("start")
    assert [(clock(r.start), r.TotalBuy, r.TotalSell) for r in found.collect()] == [
        ("10:00", 800, 0), ("10:15", 800, 400), ("10:30", 900, 0), ("10:45", 0, 600), ("11:00", 0, 200)
    ]


def test_append_mode_gives_closed_windows_only(spark, tmp_path):
    write_ordered(f"{tmp_path}/in", trade_lines())
    found = append(S.st_watermark(trade_stream(spark, f"{tmp_path}/in"))).orderBy("start").collect()
    assert [(clock(r.start), r.TotalBuy, r.TotalSell) for r in found] == [("10:00", 800, 0), ("10:15", 800, 400)]


def test_append_mode_needs_a_watermark(spark, tmp_path):
    write_ordered(f"{tmp_path}/in", trade_lines())
    with pytest.raises(AnalysisException):
        append(S.st_tumble(trade_stream(spark, f"{tmp_path}/in")))


def test_state_is_kept_without_a_watermark(spark, tmp_path):
    write_ordered(f"{tmp_path}/in", trade_lines())
    held = {}
    for name, report, mode in (("with", S.st_watermark, "update"), ("without", S.st_tumble, "complete")):
        path = scratch_path(spark, "state")
        query = sinks.to_snapshots(report(trade_stream(spark, f"{tmp_path}/in")), f"{path}/o", f"{path}/c", mode, NOW)
        query.awaitTermination()
        held[name] = R.state_rows(query)
    assert held == {"with": 3, "without": 5}


def test_restart_continues_where_it_stopped(spark, tmp_path):
    lines = trade_lines()
    path = scratch_path(spark, "restart")
    totals = []
    for upto in (3, 8):
        write_ordered(f"{tmp_path}/in", lines[:upto])
        counted = trade_stream(spark, f"{tmp_path}/in").groupBy("Type").agg(F.sum("Amount").alias("n"))
        query = sinks.to_snapshots(counted, f"{path}/out", f"{path}/checkpoint", "complete", NOW)
        query.awaitTermination()
        totals.append((sum(p["numInputRows"] for p in query.recentProgress), dict(rows(
            sinks.latest_snapshot(sinks.read_batches(spark, f"{path}/out"))))))
    assert totals == [(3, {"BUY": 1600}), (5, {"BUY": 2500, "SELL": 1400})]


def test_user_state_per_district(spark, tmp_path):
    trips = Tables(spark, SMALL).trips_events.select("pickup_district", "fare_amount")
    trips.repartition(3).write.json(f"{tmp_path}/in")
    session = on_rocksdb(stream_session(spark))
    stream = files.read_json_stream(session, f"{tmp_path}/in", trips.schema, multiline=False)
    found = update(district_state(stream), "pickup_district")
    expected = trips.groupBy("pickup_district").agg(F.count(F.lit(1)), F.round(F.sum("fare_amount"), 2))
    assert rows(found.withColumn("revenue", F.round("revenue", 2))) == rows(expected)


def test_idle_districts_leave_the_state(spark, tmp_path):
    """A is quiet for more than an hour while B goes on; then A starts anew."""
    line = '{{"pickup_district": "{}", "fare_amount": {}, "event_timestamp": "2024-01-01T{}:00"}}'
    trips = [("A", 5, "10:00"), ("A", 7, "10:10"), ("B", 1, "10:20"), ("B", 2, "11:30"), ("B", 4, "11:40"), ("A", 3, "11:50")]
    write_ordered(f"{tmp_path}/in", [line.format(*trip) for trip in trips])
    schema = "pickup_district string, fare_amount double, event_timestamp timestamp"
    session = on_rocksdb(stream_session(spark, 2))
    stream = session.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(f"{tmp_path}/in")
    path = scratch_path(spark, "idle")
    found = district_state(stream, idle="1 hour", delay="0 seconds")
    query = sinks.to_snapshots(found, f"{path}/out", f"{path}/checkpoint", "update", NOW)
    query.awaitTermination()
    out = sinks.read_batches(spark, f"{path}/out").orderBy(sinks.BATCH).collect()
    assert [(r.pickup_district, r.trips, r.revenue) for r in out] == [
        ("A", 1, 5.0), ("A", 2, 12.0), ("B", 1, 1.0), ("B", 2, 3.0), ("B", 3, 7.0), ("A", 1, 3.0)
    ]


def test_every_late_row_is_found(spark, tmp_path):
    """120 batches, a late row in each but the first, some in windows that others share; once more after a restart."""
    day = "2024-01-01 {:02d}:{:02d}:00"
    line = '{{"CreatedTime": "{}", "Type": "BUY", "Amount": {}, "BrokerCode": "A"}}'
    lines = [line.format(day.format(12, 0), 0)] + [line.format(day.format(1, at % 60), at) for at in range(1, 120)]
    path = scratch_path(spark, "late-side")
    session = on_rocksdb(stream_session(spark, 2))

    def run(expected):
        trades = files.read_json_stream(session, f"{tmp_path}/in", schemas.TRADE, multiline=False, max_files=1)
        found = late_rows(D.event_time(trades, "CreatedTime", D.SECONDS), "CreatedTime", "15 minutes", "15 minutes", parts=4)
        sinks.to_files(found, "json", f"{path}/out", f"{path}/checkpoint", NOW).awaitTermination()
        rows = session.read.schema(found.schema).json(f"{path}/out")
        assert sorted(r.Amount for r in rows.select("Amount").collect()) == expected

    write_ordered(f"{tmp_path}/in", lines)
    run(list(range(1, 120)))
    run(list(range(1, 120)))


def test_rows_of_open_windows_are_not_late(spark, tmp_path):
    """A sliding window keeps a row until the last window that holds it is closed."""
    line = '{{"at": "2024-01-01 {}:00", "n": {}}}'
    write_ordered(f"{tmp_path}/in", [line.format(at, n) for n, at in enumerate(("10:00", "11:59", "11:31", "11:29", "11:44"))])
    session = on_rocksdb(stream_session(spark, 2))
    stream = session.readStream.schema("at timestamp, n int").option("maxFilesPerTrigger", 1).json(f"{tmp_path}/in")
    assert sorted(r.n for r in append(late_rows(stream, "at", "0 seconds", "30 minutes", "15 minutes")).collect()) == [3]
    whole = session.readStream.schema("at timestamp, n int").option("maxFilesPerTrigger", 1).json(f"{tmp_path}/in")
    assert sorted(r.n for r in append(late_rows(whole, "at", "10 minutes", "30 minutes")).collect()) == [3]


def test_status_and_control(spark):
    ticks = read_rate(stream_session(spark), 20)
    counts = ticks.groupBy().count()
    path = scratch_path(spark, "control")
    specs = [
        R.StreamSpec("plain", ticks, sinks.to_memory, {"trigger": "1 second", "checkpoint": f"{path}/a"}),
        R.StreamSpec("counts", counts, sinks.to_memory, {"mode": "complete", "checkpoint": f"{path}/b"}),
    ]
    running = R.start_all(specs)
    try:
        for query in running:
            query.processAllAvailable()
        status = {r.name: r for r in R.query_status(spark, running).collect()}
        assert status["plain"].active and status["counts"].active
        assert status["counts"].state_rows == 1 and status["plain"].late_combined_rows is None
    finally:
        R.stop_all(running)
    assert not any(query.isActive for query in running)


def test_failed_start_stops_the_others(spark):
    ticks = read_rate(stream_session(spark), 1)
    path = scratch_path(spark, "fail")
    specs = [
        R.StreamSpec("good", ticks, sinks.to_memory, {"checkpoint": f"{path}/a"}),
        R.StreamSpec("bad", ticks.groupBy("value").count(), sinks.to_memory, {"checkpoint": f"{path}/b"}),
    ]
    before = set(q.id for q in spark.streams.active)
    with pytest.raises(AnalysisException):
        R.start_all(specs)
    assert not [q for q in ticks.sparkSession.streams.active if q.id not in before]


def test_continuous_trigger(spark):
    import time

    session = stream_session(spark)
    query = sinks.to_memory(read_rate(session, 50, partitions=2), "steady", trigger="continuous 1 second",
                            checkpoint=scratch_path(spark, "continuous"))
    try:
        for _ in range(60):
            time.sleep(0.5)
            if session.table("steady").count():
                break
        assert session.table("steady").count() > 0
    finally:
        R.stop_all([query])


def test_trigger_names():
    assert R.trigger_options(None) == {}
    assert R.trigger_options("10 seconds") == {"processingTime": "10 seconds"}
    assert R.trigger_options("available_now") == {"availableNow": True}
    assert R.trigger_options("once") == {"once": True}
    assert R.trigger_options("continuous 10 seconds") == {"continuous": "10 seconds"}


def test_rate_ticks_as_sensor_messages(spark):
    ticks = read_rate_batches(stream_session(spark), 9)
    messages = D.to_message(D.derive_sensor(ticks, seed=3), "sensor_id")
    path = scratch_path(spark, "ticks")
    sinks.to_files(messages, "parquet", f"{path}/out", f"{path}/checkpoint", NOW).awaitTermination(60)
    found = D.parse_json(spark.read.parquet(f"{path}/out"), schemas.SENSOR_MESSAGE, keep=("key",)).collect()
    assert len(found) >= 9 and {r.key for r in found} == {"sensor_1", "sensor_2", "sensor_3"}
    assert all(25 <= r.temperature <= 33 and r.sensor_id == r.key and r.creation_time for r in found)


def booking_messages(spark, folder):
    """Bookings as JSON message files."""
    bookings = Tables(spark, SMALL).bookings.select(
        "booking_id", F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        F.col("passenger_id").cast("int"), "pickup_district", "dropoff_district", "requested_taxi_type",
        F.col("num_passengers").cast("int"), "estimated_distance", "surge_multiplier", "payment_method",
        "special_requirements", "priority_level",
    )
    D.to_message(bookings, "booking_id").select("value").coalesce(2).write.parquet(folder)
    return stream_session(spark).readStream.schema("value string").parquet(folder), bookings


def test_the_five_booking_queries(spark, tmp_path):
    messages, bookings = booking_messages(spark, f"{tmp_path}/in")
    session = messages.sparkSession
    passengers = Tables(session, SMALL).passengers
    running = start_bookings(messages, passengers, f"{tmp_path}/checkpoints", trigger=NOW)
    R.finish_all(running)
    assert [query.name for query in running] == list(BOOKING_QUERIES)
    batch = E.enrich_bookings(E.booking_times(bookings), passengers)
    seen = session.table("surge_metrics")
    assert rows(seen) == rows(B.bk_surge(batch)) and seen.count() > 0
    assert session.table("customer_metrics").agg(F.sum("bookings")).first()[0] == bookings.count()


def test_bookings_read_once_for_many_reports(spark, tmp_path):
    messages, bookings = booking_messages(spark, f"{tmp_path}/in")
    passengers = Tables(messages.sparkSession, SMALL).passengers
    raw = sinks.batch_files(f"{tmp_path}/raw")

    def summary(batch, batch_id):
        sinks.batch_files(f"{tmp_path}/summary", "json")(E.booking_summary(batch), batch_id)

    query = start_bookings_once_read(messages, passengers, {"raw": raw, "summary": summary}, f"{tmp_path}/c", NOW)
    query.awaitTermination()
    assert sum(p["numInputRows"] for p in query.recentProgress) == bookings.count()
    assert spark.read.parquet(f"{tmp_path}/raw").count() == spark.read.json(f"{tmp_path}/summary").count() == bookings.count()


def test_repeated_batch_replaces_its_output(spark, tmp_path):
    write = sinks.batch_files(f"{tmp_path}/out")
    for _ in range(2):
        write(spark.range(5), 0)
    assert spark.read.parquet(f"{tmp_path}/out").count() == 5


def test_console_shows_rows(spark, tmp_path):
    write_ordered(f"{tmp_path}/in", trade_lines()[:1])
    sinks.to_console(trade_stream(spark, f"{tmp_path}/in"), trigger=NOW, checkpoint=f"{tmp_path}/c", rows=5).awaitTermination()


def test_kafka_options(spark):
    assert sinks.kafka_sink_options("sensor", "broker:9092", {"acks": "all", "retries": 3, "batch.size": 16384, "linger.ms": 1}) == {
        "kafka.bootstrap.servers": "broker:9092", "topic": "sensor", "kafka.acks": "all", "kafka.retries": "3",
        "kafka.batch.size": "16384", "kafka.linger.ms": "1",
    }
    shown = D.to_message(spark.createDataFrame([(1, "x")], "id int, name string"), "id").first()
    assert (shown.key, json.loads(shown.value)) == ("1", {"id": 1, "name": "x"})
