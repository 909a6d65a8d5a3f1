"""Finite streams over the driver's tables: output modes, sinks, restarts and user state.

Every query runs a stream to its end with the available-now trigger, writes below the shared folder
and reads the result back, so nothing passes through the driver.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.feature import IndexToString, StringIndexer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.operators import booking_windows as B
from kerbside.operators import enrich as E
from kerbside.operators import measures as M
from kerbside.operators import series_windows as S
from kerbside.operators import trip_windows as T
from kerbside.operators.quality.rules import rule_driver_rating
from kerbside.operators.windows import windowed
from kerbside.plans.catalog import query
from kerbside.plans.message_queries import tweet_messages
from kerbside.plans.oracle_views import half_up, steady, windows
from kerbside.plans.quality_queries import _rule_sql
from kerbside.plans.tables import Tables
from kerbside.plans.window_queries import _late_sql, _pairs
from kerbside.session import scratch_path, stream_session
from kerbside.sources import files
from kerbside.sources.dimensions import load_datasets
from kerbside.streaming import sinks
from kerbside.streaming.jobs import booking_reports, tweet_job
from kerbside.streaming.late import late_rows
from kerbside.streaming.runtime import StreamSpec, finish_all, query_status, start_all, state_rows, stop_all
from kerbside.streaming.state import district_state, on_rocksdb

NOW = "available_now"


#: The tables here are small and the streams finite.
STATE_PARTITIONS = 8


def stream_tables(t: Tables) -> Tables:
    return Tables(stream_session(t.spark, STATE_PARTITIONS), t.folder, stream=True)


def run(df: DataFrame, mode: str) -> DataFrame:
    """All batches of a finite stream, with their batch id."""
    path = scratch_path(df.sparkSession, "stream")
    sinks.to_snapshots(df, f"{path}/out", f"{path}/checkpoint", mode, NOW).awaitTermination()
    return sinks.read_batches(df.sparkSession, f"{path}/out", df.schema.add(sinks.BATCH, "long"))


def complete(df: DataFrame) -> DataFrame:
    return sinks.latest_snapshot(run(df, "complete"))


def update(df: DataFrame, *keys: str) -> DataFrame:
    return sinks.latest_per_key(run(df, "update"), keys)


def append(df: DataFrame) -> DataFrame:
    return run(df, "append").drop(sinks.BATCH)


# A stream in append mode gives the windows that ended at or before the last watermark, which Spark
# keeps in milliseconds.
def closed(view: str, ts: str, delay_seconds: int) -> str:
    return (
        f"window_end <= (SELECT make_timestamp(epoch_us(max({ts})) // 1000 * 1000) - to_seconds({delay_seconds}) "
        f"FROM {view})"
    )


@query(
    "rt_mode_complete",
    f"SELECT window_start, window_end, pickup_district, count(trip_id) AS trip_count, "
    f"{half_up(steady('sum(fare_amount)'), 2)} AS total_revenue, count(*) FILTER (is_late_data) AS late_events_count, "
    f"max(late_by_minutes) AS max_lateness_minutes, 'NO_WATERMARK' AS watermark_type "
    f"FROM {windows('trips_events', 'event_timestamp', 120)} GROUP BY window_start, window_end, pickup_district",
    ("trips_events",),
)
def _(t):
    return complete(T.wm_none(stream_tables(t).trips_events))


@query(
    "rt_mode_update",
    "SELECT SensorID, window_start AS \"start\", window_end AS \"end\", max(Reading) AS MaxReading "
    f"FROM {windows('sensors', 'CreatedTime', 900, 300)} GROUP BY SensorID, window_start, window_end",
    ("sensors",),
)
def _(t):
    return update(S.se_slide_15(stream_tables(t).sensors), "SensorID", "start", "end")


@query(
    "rt_mode_append",
    "SELECT window_start, window_end, count(trip_id) AS trip_count, "
    f"{half_up(steady('sum(fare_amount)'), 2)} AS total_revenue, {half_up(steady('avg(fare_amount)'), 2)} AS avg_fare, "
    f"max(distance_km) AS max_distance FROM {windows('trips_events', 'event_timestamp', 120)} "
    f"WHERE {closed('trips_events', 'event_timestamp', 120)} GROUP BY window_start, window_end",
    ("trips_events",),
)
def _(t):
    return append(T.tw_trips(stream_tables(t).trips_events))


@query(
    "tm_watermark",
    f"SELECT * EXCLUDE unique_trips FROM ({_late_sql('LENIENT_5m', True)}) WHERE "
    + closed("trips_events", "event_timestamp", 300),
    ("trips_events",),
)
def _(t):
    report = T.wm_lenient(stream_tables(t).trips_events)
    return _pairs(append(report)).drop("unique_trips")


@query(
    "rt_trig_once",
    "SELECT booking_id, passenger_name, membership_status, pickup_district, dropoff_district, estimated_fare, "
    "priority_score, time_category, route_type FROM enriched",
    ("enriched",),
)
def _(t):
    streaming = stream_tables(t)
    return append(E.booking_summary(E.enrich_bookings(streaming.bookings, streaming.passengers)))


_WORDS = "SELECT word, count(*) AS count FROM (SELECT unnest(string_split(text, ' ')) AS word FROM {}) GROUP BY word"


@query("wc_stream", _WORDS.format("conversations"))
def _(t):
    session = stream_session(t.spark, STATE_PARTITIONS)
    return update(S.wc_update(files.load_stream(session, t.folder, "conversations"), "text"), "word")


def _grouped(report: str, length: int, slide: int | None, keys: str, where: str = "true", having: str = "true") -> str:
    return (
        f"SELECT '{report}' AS report, count(*) AS groups, CAST(sum(n) AS BIGINT) AS bookings FROM (SELECT count(*) AS n FROM "
        f"{windows('enriched', 'event_time', length, slide)} WHERE {where} GROUP BY window_start, {keys} HAVING {having})"
    )


@query(
    "rt_multi",
    " UNION ALL ".join(
        (
            "SELECT 'enriched_bookings' AS report, count(*) AS groups, count(*) AS bookings FROM enriched",
            _grouped("operational_metrics", 300, 60, "pickup_district, requested_taxi_type"),
            _grouped("customer_metrics", 600, None, "membership_status, time_category"),
            _grouped("surge_metrics", 300, None, "pickup_district, route_type", "surge_multiplier > 1"),
            _grouped("route_analytics", 900, None, "pickup_district, dropoff_district, distance_category", having="count(*) > 2"),
        )
    ),
    ("enriched",),
)
def _(t):
    """All five booking queries at once, each into files below its own name."""
    streaming = stream_tables(t)
    enriched = E.enrich_bookings(streaming.bookings, streaming.passengers)
    path = scratch_path(t.spark, "multi")
    frames = booking_reports(enriched)
    counts = {"operational_metrics": "booking_count", "customer_metrics": "bookings", "surge_metrics": "surge_bookings",
              "route_analytics": "trip_count"}
    slim = {name: frames[name].select(F.col(count).cast("long").alias("n")) for name, count in counts.items()}
    slim["enriched_bookings"] = E.booking_summary(enriched).select(F.lit(1).cast("long").alias("n"))
    specs = [
        StreamSpec(
            name,
            df,
            sinks.to_snapshots,
            {
                "path": f"{path}/{name}",
                "checkpoint": f"{path}/checkpoint-{name}",
                "mode": "append" if name == "enriched_bookings" else "complete",
                "trigger": NOW,
            },
        )
        for name, df in slim.items()
    ]
    finish_all(start_all(specs))
    parts = []
    for name in slim:
        batches = sinks.read_batches(t.spark, f"{path}/{name}", "n long, batch_id long")
        rows = batches if name == "enriched_bookings" else sinks.latest_snapshot(batches)
        counted = rows.agg(F.count(F.lit(1)).alias("groups"), F.sum("n").alias("bookings"))
        parts.append(counted.select(F.lit(name).alias("report"), "*"))
    return reduce(DataFrame.unionByName, parts)


@query(
    "snk_foreachbatch",
    "SELECT 'good' AS output, count(*) AS n FROM tweets WHERE CAST(tweet_id AS BIGINT) % 17 <> 0 UNION ALL "
    "SELECT 'bad', count(*) FROM tweets WHERE CAST(tweet_id AS BIGINT) % 17 = 0",
    ("tweets",),
)
def _(t):
    from kerbside.streaming.jobs import tweet_job_with_rejects

    path = scratch_path(t.spark, "many")
    messages = _tweet_stream(t, path)
    good, bad = sinks.batch_files(f"{path}/good"), sinks.batch_files(f"{path}/bad")
    tweet_job_with_rejects(messages, good, bad, f"{path}/checkpoint", NOW).awaitTermination()
    counts = [
        t.spark.read.parquet(f"{path}/{name}").agg(F.lit(name).alias("output"), F.count(F.lit(1)).alias("n"))
        for name in ("good", "bad")
    ]
    return counts[0].unionByName(counts[1])


def _tweet_stream(t: Tables, path: str) -> DataFrame:
    tweet_messages(t).write.parquet(f"{path}/messages")
    return stream_session(t.spark, STATE_PARTITIONS).readStream.schema("value binary").parquet(f"{path}/messages")


@query(
    "tx_job",
    "SELECT tweet_id AS key, ltrim(user_handle, '@') AS user_handle, coalesce(like_count, 0) AS like_count FROM tweets "
    "WHERE CAST(tweet_id AS BIGINT) % 17 <> 0",
    ("tweets",),
)
def _(t):
    path = scratch_path(t.spark, "tweets")

    def to_parquet(df: DataFrame):
        return sinks.to_files(df, "parquet", f"{path}/out", f"{path}/checkpoint", NOW)

    tweet_job(_tweet_stream(t, path), to_parquet).awaitTermination()
    sent = t.spark.read.parquet(f"{path}/out").withColumn("sent", F.from_json("value", "user_handle string, like_count int"))
    return sent.select("key", "sent.*")


# --- files in and out ------------------------------------------------------------------------

_CLIENTS = "SELECT event_id, ts AS bookingtime, user_id AS clientid, event_type AS clientname, value AS price FROM events"
CLIENT_BOOKING = "event_id long, bookingtime timestamp_ntz, clientid long, clientname string, price double"


def _client_bookings(t: Tables) -> DataFrame:
    return t.table("events").selectExpr(
        "event_id", "ts AS bookingtime", "user_id AS clientid", "event_type AS clientname", "value AS price"
    )


def _written(t: Tables, kind: str, **options: object) -> str:
    path = scratch_path(t.spark, kind)
    writer = _client_bookings(t).write.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    writer.options(**options).format(kind).save(path)
    return path


@query("src_csv", _CLIENTS)
def _(t):
    return files.read_csv(t.spark, _written(t, "csv", header=True), CLIENT_BOOKING)


@query("src_json", _CLIENTS)
def _(t):
    return files.read_json(t.spark, _written(t, "json"), multiline=False, schema=CLIENT_BOOKING)


@query(
    "src_jsonl_skip",
    "SELECT count(*) FILTER (event_id % 9 <> 0) AS good, count(*) FILTER (event_id % 9 = 0) AS bad FROM events",
)
def _(t):
    path = scratch_path(t.spark, "lines")
    body = F.to_json(F.struct(*[name for name in _client_bookings(t).columns]))
    line = F.when(F.col("event_id") % 9 == 0, F.substring(body, 1, 20)).otherwise(body)
    _client_bookings(t).select(line.alias("value")).write.text(path)
    good, bad = files.read_jsonl(t.spark, path, CLIENT_BOOKING, bad="quarantine")
    sides = good.select(F.lit(1).alias("good"), F.lit(0).alias("bad")).unionByName(
        bad.select(F.lit(0).alias("good"), F.lit(1).alias("bad"))
    )
    return sides.agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))


def _through_stream(t: Tables, kind: str, reader: Callable[..., DataFrame], **options: object) -> str:
    """Files -> stream -> files of the same kind; the folder of the copy."""
    source, path = _written(t, kind), scratch_path(t.spark, f"{kind}-copy")
    rows = reader(stream_session(t.spark, STATE_PARTITIONS), source, CLIENT_BOOKING, max_files=4, **options)
    settings = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    sinks.to_files(rows, kind, f"{path}/out", f"{path}/checkpoint", NOW, options=settings).awaitTermination()
    return f"{path}/out"


@query("src_csv_stream", _CLIENTS)
def _(t):
    copy = _through_stream(t, "csv", files.read_csv_stream)
    return t.spark.read.schema(CLIENT_BOOKING).csv(copy)


@query("snk_csv", "SELECT event_type AS clientname, count(*) AS n FROM events GROUP BY ALL")
def _(t):
    copy = _through_stream(t, "csv", files.read_csv_stream)
    return t.spark.read.schema(CLIENT_BOOKING).csv(copy).groupBy("clientname").agg(F.count(F.lit(1)).alias("n"))


@query("src_json_stream", _CLIENTS)
def _(t):
    copy = _through_stream(t, "json", files.read_json_stream, multiline=False)
    return t.spark.read.schema(CLIENT_BOOKING).json(copy)


@query("snk_json", "SELECT event_type AS clientname, count(*) AS n FROM events GROUP BY ALL")
def _(t):
    copy = _through_stream(t, "json", files.read_json_stream, multiline=False)
    return t.spark.read.schema(CLIENT_BOOKING).json(copy).groupBy("clientname").agg(F.count(F.lit(1)).alias("n"))


# --- restart and state -----------------------------------------------------------------------

@query(
    "rt_checkpoint",
    "SELECT Type, CAST(sum(Amount) AS BIGINT) AS total FROM trades GROUP BY Type",
    ("trades",),
)
def _(t):
    """Half of the files before a restart on the same checkpoint, half after it."""
    path = scratch_path(t.spark, "restart")
    keep = t.trades.select("CreatedTime", "Type", "Amount")
    halves = [F.col("Type") == "BUY", F.col("Type") == "SELL"]
    session = stream_session(t.spark, STATE_PARTITIONS)
    for part in halves:
        keep.filter(part).write.mode("append").parquet(f"{path}/in")
        rows = session.readStream.schema(keep.schema).parquet(f"{path}/in")
        totals = rows.groupBy("Type").agg(F.sum("Amount").alias("total"))
        sinks.to_snapshots(totals, f"{path}/out", f"{path}/checkpoint", "complete", NOW).awaitTermination()
    return sinks.latest_snapshot(sinks.read_batches(t.spark, f"{path}/out", "Type string, total long, batch_id long"))


@query(
    "ud_state",
    f"SELECT pickup_district, count(*) AS trips, sum(fare_amount) AS revenue FROM trips_events GROUP BY ALL",
    ("trips_events",),
    digits={"revenue": 4},
)
def _(t):
    trips = stream_tables(t).trips_events
    on_rocksdb(trips.sparkSession)
    return update(district_state(trips), "pickup_district")


# --- triggers, late rows and kept state ------------------------------------------------------

_PLACES = "SELECT pickup_district AS pickup_location, count(*) AS count FROM bookings GROUP BY ALL"


def _by_trigger(t: Tables, trigger: str | None) -> DataFrame:
    """A query without an end, stopped once it has taken all rows."""
    places = B.bw_location(stream_tables(t).bookings.withColumnRenamed("pickup_district", "pickup_location"))
    path = scratch_path(t.spark, "trigger")
    running = sinks.to_snapshots(places, f"{path}/out", f"{path}/checkpoint", "complete", trigger)
    try:
        running.processAllAvailable()
    finally:
        stop_all([running])
    return sinks.latest_snapshot(sinks.read_batches(t.spark, f"{path}/out", places.schema.add(sinks.BATCH, "long")))


@query("rt_trig_proc", _PLACES, ("bookings",))
def _(t):
    return _by_trigger(t, "1 second")


@query("rt_trig_default", _PLACES, ("bookings",))
def _(t):
    return _by_trigger(t, None)


@query("snk_memory", _PLACES, ("bookings",))
def _(t):
    """One row per district, so a table in the driver's memory is fine."""
    streaming = stream_tables(t)
    places = B.bw_location(streaming.bookings.withColumnRenamed("pickup_district", "pickup_location"))
    checkpoint = scratch_path(t.spark, "memory")
    sinks.to_memory(places, "kerbside_places", "complete", NOW, checkpoint).awaitTermination()
    return streaming.spark.table("kerbside_places")


@query(
    "rt_progress",
    "SELECT 'trades' AS name, false AS active, true AS counted, count(DISTINCT window_start) AS state_rows "
    f"FROM {windows('trades', 'CreatedTime', 600)}",
    ("trades",),
)
def _(t):
    report = S.st_tumble(stream_tables(t).trades)
    path = scratch_path(t.spark, "progress")
    finished = sinks.to_snapshots(report, f"{path}/out", f"{path}/checkpoint", "complete", NOW, "trades")
    finished.awaitTermination()
    status = query_status(t.spark, [finished])
    return status.select("name", "active", (F.col("batch") >= 0).alias("counted"), "state_rows")


@query("rt_stop", _PLACES, ("bookings",))
def _(t):
    """A query without an end, stopped from outside; what it had taken is there."""
    return _by_trigger(t, None)


_ON_TIME = "is_late_data IS NULL"
_FIRST_MARK = (
    "(SELECT make_timestamp(epoch_us(max(event_timestamp)) // 1000 * 1000) - to_seconds(7200) FROM trips_events "
    f"WHERE {_ON_TIME})"
)


@query(
    "tm_late_drop",
    f"SELECT window_start, window_end, pickup_district, count(trip_id) AS n FROM "
    f"{windows('trips_events', 'event_timestamp', 3600)} WHERE {closed('trips_events', 'event_timestamp', 7200)} "
    f"AND ({_ON_TIME} OR window_end > {_FIRST_MARK}) GROUP BY ALL",
    ("trips_events",),
)
def _(t):
    """Late trips arrive after all others: those of windows behind the two-hour watermark are dropped."""
    path = scratch_path(t.spark, "late")
    trips = t.trips_events.select("trip_id", "event_timestamp", "pickup_district", "is_late_data")
    session = stream_session(t.spark, STATE_PARTITIONS)
    late = F.col("is_late_data").isNotNull()
    for part in (~late, late):
        trips.filter(part).write.mode("append").parquet(f"{path}/in")
        arriving = session.readStream.schema(trips.schema).parquet(f"{path}/in")
        report = windowed(
            arriving, "event_timestamp", "1 hour", [M.count_of("n", "trip_id")], ["pickup_district"], delay="2 hours"
        )
        sinks.to_snapshots(report, f"{path}/out", f"{path}/checkpoint", "append", NOW).awaitTermination()
    return sinks.read_batches(session, f"{path}/out", report.schema.add(sinks.BATCH, "long")).drop(sinks.BATCH)


@query(
    "tm_late_rows",
    f"SELECT trip_id, event_timestamp, pickup_district FROM {windows('trips_events', 'event_timestamp', 3600)} "
    f"WHERE NOT ({_ON_TIME}) AND window_end <= {_FIRST_MARK}",
    ("trips_events",),
)
def _(t):
    """The trips that ``tm_late_drop`` does not count, row by row."""
    path = scratch_path(t.spark, "late-rows")
    trips = t.trips_events.select("trip_id", "event_timestamp", "pickup_district", "is_late_data")
    session = on_rocksdb(stream_session(t.spark, STATE_PARTITIONS))
    late = F.col("is_late_data").isNotNull()
    for part in (~late, late):
        trips.filter(part).write.mode("append").parquet(f"{path}/in")
        arriving = session.readStream.schema(trips.schema).parquet(f"{path}/in")
        found = late_rows(arriving, "event_timestamp", "2 hours", "1 hour", spread_by=["trip_id"], parts=STATE_PARTITIONS)
        sinks.to_files(found, "parquet", f"{path}/out", f"{path}/checkpoint", NOW).awaitTermination()
    return session.read.schema(found.schema).parquet(f"{path}/out").select("trip_id", "event_timestamp", "pickup_district")


@query(
    "tm_state_keep",
    "SELECT 'kept' AS state, count(*) AS rows FROM (SELECT 1 FROM "
    f"{windows('trips_events', 'event_timestamp', 120)} GROUP BY window_start, pickup_district) UNION ALL "
    "SELECT 'evicted', count(*) FROM (SELECT 1 FROM "
    f"{windows('trips_events', 'event_timestamp', 180)} WHERE NOT ({closed('trips_events', 'event_timestamp', 120)}) "
    "GROUP BY window_start, pickup_district)",
    ("trips_events",),
)
def _(t):
    trips = stream_tables(t).trips_events
    held = []
    for name, report, mode in (("kept", T.wm_none(trips), "complete"), ("evicted", T.tw_districts(trips), "append")):
        path = scratch_path(t.spark, "state")
        finished = sinks.to_snapshots(report, f"{path}/out", f"{path}/checkpoint", mode, NOW)
        finished.awaitTermination()
        held.append((name, state_rows(finished)))
    return t.spark.createDataFrame(held, "state string, rows long")


# --- reports, models and datasets on disk ----------------------------------------------------

@query(
    "src_datasets",
    "SELECT 'drivers' AS dataset, count(*) AS n, round(sum(Rating), 4) AS total FROM drivers UNION ALL "
    "SELECT 'passengers', count(*), round(sum(AmountSpent), 4) FROM all_passengers",
    ("drivers", "all_passengers"),
)
def _(t):
    path = scratch_path(t.spark, "datasets")
    numbers = {"drivers": (t.drivers, "Rating"), "passengers": (t.all_passengers, "AmountSpent")}
    for name, (df, _) in numbers.items():
        df.write.option("header", True).csv(f"{path}/{name}")
    found = load_datasets(t.spark, {name: f"{path}/{name}" for name in (*numbers, "trips")})
    parts = [
        df.agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(numbers[name][1]), 4).alias("total")).select(
            F.lit(name).alias("dataset"), "*"
        )
        for name, df in found.items()
    ]
    return parts[0].unionByName(parts[1])


@query(
    "snk_report",
    _rule_sql("driver_ratings", "drivers", "NOT Rating BETWEEN 1 AND 5"),
    ("drivers",),
)
def _(t):
    path = scratch_path(t.spark, "report")
    sinks.write_report(rule_driver_rating(t.drivers), path)
    return t.spark.read.schema("rule string, description string, violations long, status string").json(path)


@query(
    "snk_model",
    "SELECT trip_id, pickup_district FROM ml_bookings",
    ("ml_bookings",),
)
def _(t):
    """A fitted pipeline is saved, loaded and turns districts into numbers and back."""
    path = scratch_path(t.spark, "model")
    places = t.ml_bookings.select("trip_id", "pickup_district")
    indexer = StringIndexer(inputCol="pickup_district", outputCol="place").fit(places)
    back = IndexToString(inputCol="place", outputCol="name", labels=indexer.labels)
    sinks.save_model(PipelineModel([indexer, back]), path)
    named = PipelineModel.load(path).transform(places)
    return named.select("trip_id", F.col("name").alias("pickup_district"))
