"""Trip, trade, sensor and word reports, and aggregate functions over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from kerbside.functions.scalars import count_where, ratio
from kerbside.operators import aggregates as A
from kerbside.operators import series_windows as S
from kerbside.operators import trip_windows as T
from kerbside.operators import measures as M
from kerbside.operators.windows import sliding, tumbling
from kerbside.plans.catalog import query
from kerbside.plans.oracle_views import half_up, steady, windows

TRIPS = ("trips_events",)


def _trips(length: int, slide: int | None = None) -> str:
    return windows("trips_events", "event_timestamp", length, slide)


def _sum2(value: str) -> str:
    return half_up(steady(f"sum({value})"), 2)


def _avg(value: str, digits: int = 2) -> str:
    return half_up(steady(f"avg({value})"), digits)


_SPAN = "SELECT window_start, window_end,"


@query(
    "tw_trips",
    f"{_SPAN} count(trip_id) AS trip_count, {_sum2('fare_amount')} AS total_revenue, "
    f"{_avg('fare_amount')} AS avg_fare, max(distance_km) AS max_distance FROM {_trips(120)} GROUP BY ALL",
    TRIPS,
)
def _(t):
    return T.tw_trips(t.trips_events)


@query(
    "tw_districts",
    f"{_SPAN} pickup_district, count(trip_id) AS pickup_count, {_avg('fare_amount')} AS avg_fare "
    f"FROM {_trips(180)} GROUP BY ALL",
    TRIPS,
)
def _(t):
    return T.tw_districts(t.trips_events)


@query(
    "tw_taxi_types",
    f"{_SPAN} taxi_type, count(trip_id) AS trip_count, {_sum2('fare_amount')} AS revenue, "
    f"{_avg('distance_km')} AS avg_distance, {_avg('duration_seconds', 0)} AS avg_duration_sec "
    f"FROM {_trips(300)} GROUP BY ALL",
    TRIPS,
)
def _(t):
    return T.tw_taxi_types(t.trips_events)


@query(
    "sw_trends",
    f"{_SPAN} count(trip_id) AS trip_count, {_sum2('fare_amount')} AS total_revenue, {_avg('fare_amount')} AS avg_fare, "
    f"{_avg('distance_km')} AS avg_distance, count(DISTINCT pickup_district) AS unique_pickup_districts "
    f"FROM {_trips(300, 60)} GROUP BY ALL",
    TRIPS,
)
def _(t):
    return T.sw_trends(t.trips_events, exact=True)


@query(
    "sw_districts",
    f"{_SPAN} pickup_district, count(trip_id) AS pickup_count, {_sum2('fare_amount')} AS revenue, "
    f"{_avg('passenger_count', 1)} AS avg_passengers FROM {_trips(240, 30)} GROUP BY ALL HAVING count(trip_id) > 1",
    TRIPS,
)
def _(t):
    return T.sw_districts(t.trips_events)


@query(
    "sw_performance",
    f"{_SPAN} taxi_type, count(trip_id) AS trip_count, {_avg('fare_amount')} AS avg_fare, "
    f"{_sum2('distance_km')} AS total_distance, "
    f"{half_up(steady('avg(duration_seconds) / 60'), 1)} AS avg_duration_min, "
    f"CAST(sum(passenger_count) AS BIGINT) AS total_passengers FROM {_trips(180, 30)} GROUP BY ALL",
    TRIPS,
)
def _(t):
    return T.sw_performance(t.trips_events)


@query(
    "sw_rush",
    f"{_SPAN} count(trip_id) AS trip_count, CASE WHEN count(trip_id) > 15 THEN 'HIGH_DEMAND' ELSE 'NORMAL' END "
    f"AS is_rush_hour, {_avg('fare_amount')} AS avg_fare, count(DISTINCT pickup_district) AS active_districts, "
    f"count(*) FILTER (passenger_count > 2) AS group_trips, {_avg('distance_km')} AS avg_distance "
    f"FROM {_trips(360, 120)} GROUP BY ALL",
    TRIPS,
)
def _(t):
    return T.sw_rush(t.trips_events, exact=True)


def _late_sql(label: str, late_count: bool) -> str:
    """Late minutes as minute:events pairs in order."""
    counted = ", ".join(
        ["'" + label + "' AS watermark_type", "pickup_district", "CAST(sum(n) AS BIGINT) AS trip_count",
         f"{half_up('CAST(sum(cents) AS DOUBLE) / 1000000.0', 2)} AS total_revenue"]
        + (["CAST(coalesce(sum(n) FILTER (late IS NOT NULL), 0) AS BIGINT) AS late_events_count"] if late_count else [])
    )
    return (
        f"SELECT m.*, u.unique_trips FROM ({_SPAN} {counted}, "
        "coalesce(string_agg(late || ':' || n, ',' ORDER BY late) FILTER (late IS NOT NULL), '') AS late_data_minutes "
        f"FROM (SELECT window_start, window_end, pickup_district, "
        "CASE WHEN is_late_data THEN late_by_minutes END AS late, count(*) AS n, "
        "sum(CAST(round(fare_amount * 1000000.0) AS BIGINT)) AS cents "
        f"FROM {_trips(120)} GROUP BY ALL) GROUP BY ALL) m JOIN (SELECT window_start, pickup_district, "
        f"count(DISTINCT trip_id) AS unique_trips FROM {_trips(120)} GROUP BY ALL) u "
        "ON u.window_start = m.window_start AND u.pickup_district = m.pickup_district"
    )


def _pairs(df, column: str = "late_data_minutes"):
    """(minutes, events) pairs as text."""
    pair = F.transform(column, lambda at: F.concat_ws(":", at["minutes"].cast("string"), at["events"].cast("string")))
    return df.withColumn(column, F.array_join(pair, ","))


@query("wm_strict", _late_sql("STRICT_30s", False), TRIPS)
def _(t):
    return _pairs(T.wm_strict(t.trips_events, exact=True))


@query("wm_lenient", _late_sql("LENIENT_5m", True), TRIPS)
def _(t):
    return _pairs(T.wm_lenient(t.trips_events, exact=True))


@query(
    "wm_none",
    f"{_SPAN} 'NO_WATERMARK' AS watermark_type, pickup_district, count(trip_id) AS trip_count, "
    f"{_sum2('fare_amount')} AS total_revenue, count(*) FILTER (is_late_data) AS late_events_count, "
    f"max(late_by_minutes) AS max_lateness_minutes FROM {_trips(120)} GROUP BY ALL",
    TRIPS,
)
def _(t):
    return T.wm_none(t.trips_events)


_LATE = (
    "(SELECT *, epoch_us(processing_timestamp) // 1000000 - epoch_us(event_timestamp) // 1000000 AS late_s "
    f"FROM {_trips(60)})"
)
_LATE_CLASS = (
    "CASE WHEN late_s > 300 THEN 'VERY_LATE' WHEN late_s > 120 THEN 'MODERATELY_LATE' "
    "WHEN late_s > 30 THEN 'SLIGHTLY_LATE' ELSE 'ON_TIME' END"
)


@query(
    "wm_lateness",
    f"{_SPAN} {_LATE_CLASS} AS lateness_category, count(trip_id) AS event_count, "
    f"{_avg('late_s', 1)} AS avg_lateness_sec, max(late_s) AS max_lateness_sec FROM {_LATE} GROUP BY ALL",
    TRIPS,
)
def _(t):
    return T.wm_lateness(t.trips_events)


@query(
    "fx_lateness",
    f"SELECT trip_id, event_timestamp, late_s AS lateness_seconds, {_LATE_CLASS} AS lateness_category FROM {_LATE}",
    TRIPS,
)
def _(t):
    return T.lateness(t.trips_events).select(
        "trip_id", "event_timestamp", "lateness_seconds", "lateness_category"
    )


@query(
    "tm_tumbling",
    f"{_SPAN} event_type, count(*) AS n, sum(value) AS total FROM {windows('events', 'ts', 3600)} GROUP BY ALL",
    digits={"total": 6},
)
def _(t):
    events = t.table("events").withColumn("ts", F.col("ts").cast("timestamp"))
    return tumbling(events, "ts", "1 hour", [M.count_rows("n"), M.total("total", "value")], ["event_type"])


@query(
    "tm_sliding",
    f"{_SPAN} event_type, count(*) AS n, sum(value) AS total, max(value) AS highest "
    f"FROM {windows('events', 'ts', 3600, 900)} GROUP BY ALL",
    digits={"total": 6},
)
def _(t):
    events = t.table("events").withColumn("ts", F.col("ts").cast("timestamp"))
    measures = [M.count_rows("n"), M.total("total", "value"), M.largest("highest", "value")]
    return sliding(events, "ts", "1 hour", "15 minutes", measures, ["event_type"])


# --- trades, sensors, values, words ----------------------------------------------------------

_SIDES = (
    "CAST(coalesce(sum(Amount) FILTER (Type = 'BUY'), 0) AS BIGINT) AS TotalBuy, "
    "CAST(coalesce(sum(Amount) FILTER (Type = 'SELL'), 0) AS BIGINT) AS TotalSell"
)
_START_END = 'window_start AS "start", window_end AS "end"'


@query(
    "st_tumble",
    f"SELECT {_START_END}, {_SIDES} FROM {windows('trades', 'CreatedTime', 600)} GROUP BY window_start, window_end",
    ("trades",),
)
def _(t):
    return S.st_tumble(t.trades)


@query(
    "st_by_type",
    f"{_SPAN} Type, CAST(sum(Amount) AS BIGINT) AS total_amount FROM {windows('trades', 'CreatedTime', 900)} GROUP BY ALL",
    ("trades",),
)
def _(t):
    return S.st_by_type(t.trades)


@query(
    "st_watermark",
    f"SELECT {_START_END}, {_SIDES} FROM {windows('trades', 'CreatedTime', 900)} GROUP BY window_start, window_end",
    ("trades",),
)
def _(t):
    return S.st_watermark(t.trades)


@query(
    "se_slide_15",
    f"SELECT SensorID, {_START_END}, max(Reading) AS MaxReading FROM {windows('sensors', 'CreatedTime', 900, 300)} "
    "GROUP BY SensorID, window_start, window_end",
    ("sensors",),
)
def _(t):
    return S.se_slide_15(t.sensors)


@query(
    "se_slide_5",
    f"SELECT SensorID AS sensor_id, {_START_END}, max(Reading) AS MaxReading "
    f"FROM {windows('sensors', 'CreatedTime', 300, 60)} GROUP BY SensorID, window_start, window_end",
    ("sensors",),
)
def _(t):
    return S.se_slide_5(t.sensors.withColumnRenamed("SensorID", "sensor_id"))


@query(
    "ev_slide",
    f"{_SPAN} event_type AS value, count(*) AS count FROM {windows('ev', 'et', 60, 30)} GROUP BY ALL",
    ("ev",),
)
def _(t):
    return S.ev_slide(t.events.selectExpr("et AS event_time", "event_type AS value"))


_WORDS = "SELECT word, count(*) AS count FROM (SELECT unnest(string_split(text, ' ')) AS word FROM {}) GROUP BY word"


@query("wc_complete", _WORDS.format("documents"))
def _(t):
    return S.wc_complete(t.table("documents"), "text")


@query("wc_update", _WORDS.format("conversations"))
def _(t):
    return S.wc_update(t.table("conversations"), "text")


_RUNNING = (
    "SELECT *, CAST(sum(TotalBuy) OVER w AS BIGINT) AS RTotalBuy, CAST(sum(TotalSell) OVER w AS BIGINT) AS RTotalSell, "
    "CAST(sum(TotalBuy - TotalSell) OVER w AS BIGINT) AS NetValue FROM ({rows}) "
    'WINDOW w AS ({part} ORDER BY "end" ROWS UNBOUNDED PRECEDING)'
)


@query(
    "wf_running",
    _RUNNING.format(
        part="",
        rows=f"SELECT {_START_END}, {_SIDES} FROM {windows('trades', 'CreatedTime', 600)} GROUP BY window_start, window_end",
    ),
    ("trades",),
)
def _(t):
    return S.running_totals(S.st_tumble(t.trades))


@query(
    "wf_running_broker",
    _RUNNING.format(
        part="PARTITION BY BrokerCode",
        rows=f"SELECT BrokerCode, {_START_END}, {_SIDES} FROM {windows('trades', 'CreatedTime', 600)} "
        "GROUP BY BrokerCode, window_start, window_end",
    ),
    ("trades",),
)
def _(t):
    return S.running_totals(S.broker_totals(t.trades), by=["BrokerCode"])


@query(
    "wf_last_n",
    "SELECT user_id, ts, event_id, value FROM events "
    "QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) <= 50",
)
def _(t):
    points = t.table("events").select("user_id", "ts", "event_id", "value")
    return S.last_n(points, "user_id", "ts", 50, tie=["event_id"])


# --- aggregate functions ---------------------------------------------------------------------

@query(
    "ag_count",
    "SELECT l_returnflag, count(*) AS n, count(nullif(l_linenumber, 1)) AS later_lines FROM lineitem GROUP BY ALL",
)
def _(t):
    later = F.nullif(F.col("l_linenumber"), F.lit(1))
    return t.table("lineitem").groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.count(later).alias("later_lines")
    )


@query(
    "ag_basic",
    f"SELECT l_returnflag, l_linestatus, sum(l_extendedprice) AS total, avg(l_quantity) AS average, "
    "max(l_extendedprice) AS highest, min(l_extendedprice) AS lowest FROM lineitem GROUP BY ALL",
    digits={"total": 2, "average": 9},
)
def _(t):
    measures = [M.total("total", "l_extendedprice"), M.mean("average", "l_quantity")]
    return t.table("lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        *[m.direct.alias(m.name) for m in measures],
        F.max("l_extendedprice").alias("highest"),
        F.min("l_extendedprice").alias("lowest"),
    )


@query(
    "ag_cond",
    "SELECT pickup_district, count(*) FILTER (is_late_data) AS late, count(*) FILTER (passenger_count > 2) AS groups "
    "FROM trips_events GROUP BY ALL",
    TRIPS,
)
def _(t):
    late = F.coalesce(F.col("is_late_data"), F.lit(False))
    return t.trips_events.groupBy("pickup_district").agg(
        count_where(late).alias("late"), count_where(F.col("passenger_count") > 2).alias("groups")
    )


@query(
    "ag_approx_distinct",
    "SELECT l_returnflag, count(DISTINCT l_partkey) AS parts, true AS within FROM lineitem GROUP BY l_returnflag",
)
def _(t):
    rsd = 0.05
    counted = t.table("lineitem").groupBy("l_returnflag").agg(
        A.approx_distinct("l_partkey", rsd).alias("about"), F.count_distinct("l_partkey").alias("parts")
    )
    error = F.abs(F.col("about") - F.col("parts"))
    return counted.select("l_returnflag", "parts", (error <= 4 * rsd * F.col("parts")).alias("within"))


@query(
    "ag_collect",
    "SELECT pickup_district, string_agg(late_by_minutes || ':' || n, ',' ORDER BY late_by_minutes) AS histogram FROM "
    "(SELECT pickup_district, late_by_minutes, count(*) AS n FROM trips_events WHERE is_late_data GROUP BY ALL) "
    "GROUP BY pickup_district",
    TRIPS,
)
def _(t):
    marked = t.trips_events.select("pickup_district", T.late_minutes().alias("late_by_minutes"))
    return _pairs(A.value_histogram(marked, ["pickup_district"], "late_by_minutes"), "histogram")


@query(
    "ag_pctl",
    f"""SELECT window_start, window_end, max(n) AS total_events, count(DISTINCT trip_id) AS unique_trips,
  min(fare_amount) FILTER (place >= ceil(0.95 * n)) AS p95_fare FROM (
  SELECT *, count(*) OVER (PARTITION BY window_start) AS n,
    row_number() OVER (PARTITION BY window_start ORDER BY fare_amount) AS place FROM {_trips(120)})
  GROUP BY window_start, window_end""",
    TRIPS,
)
def _(t):
    return T.wm_collected(t.trips_events, exact=True)


_LINE_NUMBERS = (
    "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax".split()
)


@query(
    "ag_quantiles",
    " UNION ALL ".join(
        f"SELECT '{name}' AS \"column\", count({name}) AS n, true AS within FROM lineitem" for name in _LINE_NUMBERS
    ),
)
def _(t):
    """The quartiles of all numeric columns, held against their ranks among the rows."""
    rows, error = t.table("lineitem"), 0.01
    found = A.quartiles(rows, A.numeric_columns(rows), error)
    marks = found.select(F.map_from_entries(F.collect_list(F.struct("column", F.array("q1", "median", "q3"))))).scalar()
    whole = rows.withColumn("marks__", marks)
    facts = []
    for name in A.numeric_columns(rows):
        at = [F.col("marks__")[name][place] for place in range(3)]
        n = F.count(name)
        good = [
            (F.count_if(F.col(name) < mark) / n <= share + error) & (F.count_if(F.col(name) <= mark) / n >= share - error)
            for mark, share in zip(at, (0.25, 0.5, 0.75))
        ]
        facts.append(F.struct(F.lit(name).alias("column"), n.alias("n"), (good[0] & good[1] & good[2]).alias("within")))
    return whole.agg(F.array(*facts).alias("facts")).select(F.inline("facts"))


def _describe_sql(table: str, *columns: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS \"column\", count({name}) AS \"count\", round(avg({name}), 4) AS mean, "
        f"round(stddev_samp({name}), 4) AS stddev, CAST(min({name}) AS DOUBLE) AS \"min\", "
        f"CAST(max({name}) AS DOUBLE) AS \"max\" FROM {table}"
        for name in columns
    )


@query("ag_describe", _describe_sql("lineitem", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount"))
def _(t):
    facts = A.describe_numeric(t.table("lineitem"), ["l_linenumber", "l_quantity", "l_extendedprice", "l_discount"])
    return facts.withColumns({name: F.round(name, 4) for name in ("mean", "stddev")})


@query(
    "ag_ratio",
    "SELECT l_suppkey, count(*) FILTER (l_returnflag = 'R') * 1.0::DOUBLE / count(*) AS returned FROM lineitem GROUP BY ALL",
)
def _(t):
    returned = count_where(F.col("l_returnflag") == "R")
    return t.table("lineitem").groupBy("l_suppkey").agg(ratio(returned, F.count(F.lit(1))).alias("returned"))


@query("so_order", "SELECT p_partkey, p_brand, p_size FROM part ORDER BY p_size DESC, p_partkey")
def _(t):
    return t.table("part").select("p_partkey", "p_brand", "p_size").orderBy(F.col("p_size").desc(), "p_partkey")


@query(
    "so_limit",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10",
)
def _(t):
    return A.top(t.table("orders").select("o_orderkey", "o_totalprice"), 10, F.col("o_totalprice").desc(), "o_orderkey")
