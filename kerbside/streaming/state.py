"""User-defined state per key: running trips and revenue per district."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from kerbside.session import ROCKSDB

PARTIAL = "pickup_district string, trips long, revenue double, last long"
TOTAL = "pickup_district string, trips long, revenue double"
HELD = "trips long, revenue double"

_UNITS = {"second": 1000, "minute": 60_000, "hour": 3_600_000, "day": 86_400_000}


def milliseconds(duration: str) -> int:
    """``"30 seconds"``, ``"1 hour"`` and the like."""
    number, unit = duration.split()
    return round(float(number) * _UNITS[unit.rstrip("s")])


def on_rocksdb(spark: SparkSession) -> SparkSession:
    """The session with the state store that stateful processors need."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return spark


def _combine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per district and Arrow batch, so that a hot district is small before the shuffle."""
    for rows in batches:
        if len(rows):
            sums = rows.groupby("pickup_district", dropna=False, as_index=False)
            yield sums.agg(trips=("trips", "sum"), revenue=("revenue", "sum"), last=("last", "max"))


class DistrictTotals(StatefulProcessor):
    """The totals of one district, as typed value state.

    With ``ttl_ms`` the state expires so long after its last update by the clock. With ``idle_ms`` an event-time
    timer, moved on by every batch that brings later trips, clears it once the watermark is so far past the last trip.
    """

    def __init__(self, ttl_ms: int | None = None, idle_ms: int | None = None) -> None:
        self.ttl_ms, self.idle_ms = ttl_ms, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.total = handle.getValueState("total", HELD, self.ttl_ms)
        self.due = handle.getValueState("due", "at long") if self.idle_ms else None

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        trips, revenue = self.total.get() or (0, 0.0)
        last = 0
        for part in rows:
            trips += int(part["trips"].sum())
            revenue += float(part["revenue"].sum(skipna=False))
            last = max(last, int(part["last"].max()))
        self.total.update((trips, revenue))
        if self.due is not None:
            self._move_timer(last + self.idle_ms)
        yield pd.DataFrame({"pickup_district": [key[0]], "trips": [trips], "revenue": [revenue]})

    def _move_timer(self, at: int) -> None:
        before = self.due.get()
        if before is None or at > before[0]:
            if before is not None:
                self.handle.deleteTimer(before[0])
            self.handle.registerTimer(at)
            self.due.update((at,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.total.clear()
        self.due.clear()
        return iter(())

    def close(self) -> None:
        pass


def district_state(
    trips: DataFrame,
    idle: str | None = None,
    delay: str = "10 minutes",
    ttl: str | None = None,
    event_time: str = "event_timestamp",
) -> DataFrame:
    """Running totals per district; emits the new totals of the districts a batch touched.

    Run it in update mode, on RocksDB (``on_rocksdb``). The state is one row per district, whatever the number of
    trips. Districts leave the state ``idle`` after their last trip in event time (with a watermark of ``delay``), or
    ``ttl`` after their last update by the clock; a later trip starts them anew. Without either they stay for ever.
    """
    if idle and ttl:
        raise ValueError("choose idle (event time) or ttl (clock)")
    if idle:
        trips = trips.withWatermark(event_time, delay)
    last = F.unix_millis(F.col(event_time)) if idle else F.lit(0).cast("long")
    slim = trips.select(
        "pickup_district",
        F.lit(1).cast("long").alias("trips"),
        F.coalesce(F.col("fare_amount").cast("double"), F.lit(0.0)).alias("revenue"),
        F.coalesce(last, F.lit(0).cast("long")).alias("last"),
    )
    processor = DistrictTotals(milliseconds(ttl) if ttl else None, milliseconds(idle) if idle else None)
    partial = slim.mapInPandas(_combine, PARTIAL)
    return partial.groupBy("pickup_district").transformWithStateInPandas(
        processor, TOTAL, "Update", "EventTime" if idle else "ProcessingTime" if ttl else "None"
    )
