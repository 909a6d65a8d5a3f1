"""Small helpers shared by the tests."""

from __future__ import annotations

import os
import time


def rows(df, *columns):
    """Rows as sorted plain tuples."""
    return sorted((tuple(row) for row in (df.select(*columns) if columns else df).collect()), key=repr)


def write_ordered(folder, texts, suffix="json"):
    """One file per text, with modification times in order: a stream takes them one after another."""
    os.makedirs(folder, exist_ok=True)
    start = time.time() - 1000
    for place, text in enumerate(texts):
        path = f"{folder}/part-{place:04d}.{suffix}"
        with open(path, "w") as out:
            out.write(text + "\n")
        os.utime(path, (start + place, start + place))


# Eight trades in order of arrival and eight readings of one sensor.
TRADES = [
    ("2023-02-05 10:12:00", "BUY", 300, "SGX"),
    ("2023-02-05 10:05:00", "BUY", 500, "SGX"),
    ("2023-02-05 10:20:00", "BUY", 800, "SGX"),
    ("2023-02-05 10:40:00", "BUY", 900, "SGX"),
    ("2023-02-05 10:25:00", "SELL", 400, "SGX"),
    ("2023-02-05 10:48:00", "SELL", 600, "SGX"),
    ("2023-02-05 11:05:00", "SELL", 200, "SGX"),
    ("2023-02-05 10:12:00", "SELL", 200, "SGX"),
]
READINGS = [("09:54", 36.2), ("09:59", 36.5), ("10:04", 36.8), ("10:09", 36.2), ("10:14", 36.5), ("10:19", 36.3),
            ("10:24", 37.7), ("10:29", 37.2)]


def trade_lines():
    import json

    names = ("CreatedTime", "Type", "Amount", "BrokerCode")
    return [json.dumps(dict(zip(names, trade))) for trade in TRADES]


def trades(spark):
    from kerbside import schemas
    from kerbside.operators.decode import SECONDS, event_time

    return event_time(spark.createDataFrame(TRADES, schemas.TRADE), "CreatedTime", SECONDS)


def sensors(spark):
    from kerbside.operators.decode import SECONDS, event_time

    given = [("SET41", f"2023-02-05 {clock}:00", reading) for clock, reading in READINGS]
    return event_time(spark.createDataFrame(given, "SensorID string, CreatedTime string, Reading double"), "CreatedTime", SECONDS)


def clock(value):
    return value.strftime("%H:%M")
