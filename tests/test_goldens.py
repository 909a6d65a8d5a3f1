"""Known results on small fixed inputs."""

import datetime as dt
import struct

import pytest
from pyspark.sql import functions as F

from kerbside import schemas
from kerbside.operators import decode as D
from kerbside.operators import series_windows as S
from kerbside.operators import tweets as W
from kerbside.operators import validate as V
from tests.helpers import clock, rows, sensors, trades


def test_trades_by_ten_minutes_with_running_totals(spark):
    found = S.running_totals(S.st_tumble(trades(spark))).orderBy("start").collect()
    assert [(clock(r.start), r.TotalBuy, r.TotalSell, r.RTotalBuy, r.RTotalSell, r.NetValue) for r in found] == [
        ("10:00", 500, 0, 500, 0, 500),
        ("10:10", 300, 200, 800, 200, 600),
        ("10:20", 800, 400, 1600, 600, 1000),
        ("10:40", 900, 600, 2500, 1200, 1300),
        ("11:00", 0, 200, 2500, 1400, 1100),
    ]


def test_trades_by_quarter_hour(spark):
    found = S.st_watermark(trades(spark)).orderBy("start").collect()
    assert [(clock(r.start), r.TotalBuy, r.TotalSell) for r in found] == [
        ("10:00", 800, 200), ("10:15", 800, 400), ("10:30", 900, 0), ("10:45", 0, 600), ("11:00", 0, 200)
    ]


def test_trades_by_type(spark):
    found = S.st_by_type(trades(spark)).select("window.start", "Type", "total_amount").orderBy("start", "Type").collect()
    assert [(clock(r.start), r.Type, r.total_amount) for r in found] == [
        ("10:00", "BUY", 800), ("10:00", "SELL", 200), ("10:15", "BUY", 800), ("10:15", "SELL", 400),
        ("10:30", "BUY", 900), ("10:45", "SELL", 600), ("11:00", "SELL", 200),
    ]


def test_other_trade_types_count_nothing(spark):
    from kerbside.functions.trip_model import buy_sell

    odd = spark.createDataFrame([("HOLD", 5), (None, 7)], "Type string, Amount int")
    assert rows(buy_sell(odd), "Buy", "Sell") == [(0, 0), (0, 0)]


def test_sensor_quarter_hours(spark):
    found = S.se_slide_15(sensors(spark)).orderBy("start").collect()
    assert [(clock(r.start), r.MaxReading) for r in found] == [
        ("09:40", 36.2), ("09:45", 36.5), ("09:50", 36.8), ("09:55", 36.8), ("10:00", 36.8),
        ("10:05", 36.5), ("10:10", 37.7), ("10:15", 37.7), ("10:20", 37.7), ("10:25", 37.2),
    ]


def test_sensor_minutes(spark):
    found = S.se_slide_5(sensors(spark).withColumnRenamed("SensorID", "sensor_id")).orderBy("start").collect()
    assert len(found) == 40
    assert [r.MaxReading for r in found[:11]] == [36.2] * 5 + [36.5] * 5 + [36.8]


# Eight sample tweets.
TWEETS = [
    ("@alice", "Just tried Kafka 8.2 + #Confluent — amazing KRaft performance! 🚀 https://confluent.io", 12, 47),
    ("@bob_dev", "Running @Podman containers is great for local Kafka dev. @alice agree?", 3, 21),
    ("@charlie", "Terrible flaky tests today. Nothing is working. #devlife", 5, 8),
    ("@diana_ml", "Attending #KafkaSummit next week! @bob_dev @alice will you be there?", 2, 15),
    ("@eve", "The new #Pydantic v2 is the best — love the performance gains over v1!", 8, 60),
    ("@frank", "Worst deployment ever. Bad config, broken pipelines. Everything is sad.", 0, 3),
    ("@grace_ai", "Fascinating paper on LLMs dropping today! Check it out https://arxiv.org #AI #ML", 34, 120),
    ("@henry", "#Podman 5.x + cp-kafka:8.2.0 — smooth setup with no ZooKeeper needed. Excellent work!", 7, 33),
]


def _tweets(spark):
    given = [(str(i), *tweet[:2], None, None, *tweet[2:]) for i, tweet in enumerate(TWEETS)]
    return spark.createDataFrame(given, schemas.TWEET)


def test_tweets(spark):
    found = W.enrich_tweets(V.normalise_tweet(_tweets(spark))).orderBy("tweet_id").collect()
    assert [(r.hashtags, r.mentions, r.url_count, r.sentiment_label, r.word_count) for r in found] == [
        (["Confluent"], [], 1, "positive", 12),
        ([], ["Podman", "alice"], 0, "positive", 11),
        (["devlife"], [], 0, "negative", 8),
        (["KafkaSummit"], ["bob_dev", "alice"], 0, "neutral", 10),
        (["Pydantic"], [], 0, "positive", 14),
        ([], [], 0, "negative", 10),
        (["AI", "ML"], [], 1, "neutral", 12),
        (["Podman"], [], 0, "positive", 13),
    ]
    assert len(found[0]) == 13
    assert [r.user_handle for r in found][:2] == ["alice", "bob_dev"]
    assert {r.language for r in found} == {"en"}
    assert all(r.created_at > 0 and r.processed_at > 0 for r in found)


def test_tweet_stats_and_rejects(spark):
    messages = D.to_message(_tweets(spark), "tweet_id").select(F.col("value").cast("binary"))
    broken = spark.createDataFrame([("{bad",), ('{"user_handle": "@x"}',), (None,)], "value string")
    messages = messages.unionByName(broken.select(F.col("value").cast("binary")))
    bad = W.read_tweets(messages)[1]
    assert rows(W.tweet_stats(messages)) == [(8, 3, 4, 2, 2)]
    assert sorted(r.reject_reason for r in bad.collect()) == ["missing text", "missing user_handle", "not JSON"]


def test_words_of_other_scripts(spark):
    from kerbside.functions import text as X

    df = spark.createDataFrame([("#été_1 @žluť über gut #日本 http://a.b/ç?x=1",)], "text string")
    found = df.select(X.hashtags("text"), X.mentions("text"), X.url_count("text"), X.word_count("text")).first()
    assert tuple(found) == (["été_1", "日本"], ["žluť"], 1, 6)


def test_sensor_readings(spark):
    given = [
        (f"r{i}", f"sensor-{i:03d}", f"zone-{'ABCD'[i % 4]}", round(18 + 1.8 * i, 1), round(40 + 1.2 * i, 1), i)
        for i in range(10)
    ]
    odd = [("r", "s", "z", 101.0, 50.0, 1), ("r", "s", "z", 20.0, -1.0, 1), ("r", "s", None, 20.0, 1.0, 1)]
    good, bad = V.validate_sensor(spark.createDataFrame(given + odd, schemas.SENSOR_READING))
    kept = good.orderBy("reading_id").collect()
    assert [(r.sensor_id, r.temperature, r.humidity) for r in kept[:2]] == [
        ("sensor-000", 18.0, 40.0), ("sensor-001", 19.8, 41.2)
    ]
    assert V.high_temp(good).count() == 0  # the hottest is 34.2
    assert sorted(r.reject_reason for r in bad.collect()) == [
        "humidity out of range", "missing location", "temperature out of range"
    ]


def _zigzag(number):
    number, out = (number << 1) ^ (number >> 63), b""
    while number > 0x7F:
        out += bytes([number & 0x7F | 0x80])
        number >>= 7
    return out + bytes([number])


def test_avro_messages(spark):
    def text(value):
        return _zigzag(len(value.encode())) + value.encode()

    messages = [
        b"\x00" + struct.pack(">I", 300)
        + text(f"evt-{i:04d}") + text(f"device-{i % 5:03d}") + text("cpu_usage")
        + struct.pack("<d", 20 + 1.5 * i) + _zigzag(1_700_000_000_000 + i)
        for i in range(8)
    ]
    df = spark.createDataFrame([(bytearray(m),) for m in messages] + [(bytearray(b"\x01abcdef"),)], "value binary")
    ids = sorted(str(r.schema_id) for r in D.split_confluent(df).collect())
    assert ids == ["300"] * 8 + ["None"]
    with pytest.raises(RuntimeError, match="spark-avro"):
        D.parse_confluent_avro(df, {300: schemas.TELEMETRY_AVRO})
    decoded, unknown = D.parse_confluent_avro(df, {})
    assert decoded == {} and unknown.count() == 9
    known = D.split_confluent(df).select("schema_id", D.known_schema([300, 301]).alias("known"))
    assert rows(known) == [(300, True)] * 8 + [(None, False)]


def test_timestamps_that_are_not(spark):
    df = spark.createDataFrame([("2024-01-05T10:00:00.000001",), ("2024-01-05T10:00:00",), ("soon",), (None,)], "t string")
    found = D.event_time(df, "t", D.MICROS).collect()
    assert [r.t for r in found] == [
        dt.datetime(2024, 1, 5, 10, 0, 0, 1), dt.datetime(2024, 1, 5, 10), None, None
    ]


def test_broken_payloads_keep_their_row(spark):
    df = spark.createDataFrame([("{bad",), ('{"a": 1}',)], "value string")
    assert rows(D.parse_json(df, "a int")) == [(1,), (None,)]
    marked = D.parse_json_marked(df, "a int")
    assert rows(marked) == [(1, None), (None, "{bad")]


def test_event_view_of_bad_payload(spark):
    given = [(0, 1, '{"event_id": "0123456789", "event_type": "click", "page": null}'), (1, 2, "nonsense")]
    df = spark.createDataFrame(given, "partition int, offset long, value string")
    assert rows(D.event_view(df, schemas.APP_EVENT)) == [
        (0, 1, "01234567", "click", "?", "?", "", None),
        (1, 2, "?", "unknown", "?", "?", "", "nonsense"),
    ]


def test_numbers_among_messages(spark):
    df = spark.createDataFrame([(" 36.5 ",), ("abc",), ("",), (None,), ("1e2",)], "value string")
    assert rows(V.numeric_only(df), "number") == [(100.0,), (36.5,)]


def test_nested_taxis(spark):
    from kerbside.operators.joins import taxi_drivers

    given = [
        (1, "SHZ", "Standard", ("Toyota", 4, "Yellow"), "T1", [("Albert", 1), ("Betty", 2)]),
        (2, "SHY", "Mini Cab", ("Suzuki", 4, "Green"), "T2", []),
    ]
    found = taxi_drivers(spark.createDataFrame(given, schemas.NESTED_TAXI))
    assert rows(found, "Sno", "TaxiMakeModel", "DriverName") == [
        (1, "Toyota", "Albert"), (1, "Toyota", "Betty"), (2, "Suzuki", None)
    ]


def test_log_lines(spark):
    from kerbside.functions import scalars as C

    df = spark.createDataFrame([("an error and warn 12",), ("warn",), ("ERROR",)], "value string")
    found = df.select(C.log_level("value"), C.first_number("value"), C.message_type("value"), C.message_length("value"))
    assert rows(found) == [
        ("ERROR", "12", "contains_number", 20), ("INFO", "", "text_only", 5), ("WARNING", "", "text_only", 4)
    ]


@pytest.mark.parametrize("text, expected", [("a  b", ["", "a", "b"]), ("", [""])])
def test_words_split_on_single_spaces(spark, text, expected):
    from kerbside.functions.scalars import words

    assert sorted(r.word for r in words(spark.createDataFrame([(text,)], "value string"), "value").collect()) == expected
