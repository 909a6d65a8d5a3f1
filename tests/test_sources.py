"""File, message and dimension sources."""

import json
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from kerbside import schemas
from kerbside.operators.decode import kafka_metadata
from kerbside.plans.tables import Tables
from kerbside.session import shared_folder, stream_session
from kerbside.sources import dimensions, files, messages
from kerbside.streaming import sinks
from tests.helpers import rows, write_ordered

HEADER = "bookingtime,clientid,clientname,price"


def csv_folder(tmp_path):
    write_ordered(
        f"{tmp_path}/in", [f'{HEADER}\n"2023-02-05 10:05:00",1001,"Ann",23.45', f'{HEADER}\n"2023-02-05 10:12:00",1002,"Bo",34.72'], "csv"
    )
    return f"{tmp_path}/in"


def stream_rows(df, tmp_path, kind="parquet"):
    query = sinks.to_files(df, kind, f"{tmp_path}/out", f"{tmp_path}/checkpoint", "available_now")
    query.awaitTermination()
    return df.sparkSession.read.parquet(f"{tmp_path}/out"), query


def test_csv_stream_takes_the_header_line_as_a_row(spark, tmp_path):
    df = files.read_csv_stream(stream_session(spark), csv_folder(tmp_path))
    assert df.columns == ["_c0", "_c1", "_c2", "_c3"]
    found, query = stream_rows(df, tmp_path)
    assert found.count() == 4 and found.filter("_c1 = 'clientid'").count() == 2
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 2  # one file per batch


def test_csv_stream_with_header_and_schema(spark, tmp_path):
    layout = "bookingtime timestamp, clientid int, clientname string, price double"
    df = files.read_csv_stream(stream_session(spark), csv_folder(tmp_path), layout, header=True)
    assert rows(stream_rows(df, tmp_path)[0], "clientid", "price") == [(1001, 23.45), (1002, 34.72)]


def test_json_arrays(spark, tmp_path):
    taxis = [{"TaxiID": 1, "TaxiNumber": "A"}, {"TaxiID": 2, "TaxiNumber": "B"}]
    write_ordered(f"{tmp_path}/in", [json.dumps(taxis, indent=2), json.dumps(taxis[:1], indent=2)])
    assert files.read_json(spark, f"{tmp_path}/in").count() == 3
    df = files.read_json_stream(stream_session(spark), f"{tmp_path}/in")
    assert rows(stream_rows(df, tmp_path)[0]) == [(1, "A"), (1, "A"), (2, "B")]


def test_json_lines_with_bad_ones(spark, tmp_path):
    write_ordered(f"{tmp_path}/in", ['{"a": 1}\n{oops\n{"a": 2}'])
    assert rows(files.read_jsonl(spark, f"{tmp_path}/in", "a int")) == [(1,), (2,)]
    Path(f"{tmp_path}/two").write_text('{"a": 1, "b": 2}\n{"a": 3, "b": "x"}\n{"a"\n')
    good = files.read_jsonl(spark, f"{tmp_path}/two", "a int, b int")
    # The line whose other column is bad is bad for every choice of columns.
    assert rows(good) == [(1, 2)] and good.count() == 1 and rows(good.select("a")) == [(1,)]
    good, bad = files.read_jsonl(spark, f"{tmp_path}/in", "a int", bad="quarantine")
    assert rows(good) == [(1,), (2,)] and rows(bad) == [("{oops",)]
    with pytest.raises(ValueError):
        files.read_jsonl(spark, f"{tmp_path}/in", "a int", bad="ignore")


def test_csv_with_inferred_types(spark, tmp_path):
    df = files.read_csv(spark, csv_folder(tmp_path))
    assert dict(df.dtypes) == {"bookingtime": "timestamp", "clientid": "int", "clientname": "string", "price": "double"}


def test_fallback_rows(spark, tmp_path):
    for name, (_, given) in dimensions.FALLBACKS.items():
        found = dimensions.load_dim(spark, name, f"{tmp_path}/none")
        assert found.count() == len(given)
    write_ordered(f"{tmp_path}/drivers", ["DriverID,DriverName\n1,Ann"], "csv")
    assert rows(dimensions.load_dim(spark, "drivers", f"{tmp_path}/drivers")) == [(1, "Ann")]
    assert schemas.TIER_COLUMN in dimensions.load_dim(spark, "passengers", f"{tmp_path}/none").columns


def test_datasets_that_exist(spark, tmp_path):
    write_ordered(f"{tmp_path}/drivers", ["DriverID,Rating\n1,4.5"], "csv")
    found = dimensions.load_datasets(spark, {"drivers": f"{tmp_path}/drivers", "trips": f"{tmp_path}/none"})
    assert list(found) == ["drivers"] and found["drivers"].count() == 1


def test_views(spark):
    dimensions.register_views(spark, {"some_taxis": spark.range(3)})
    assert spark.sql("SELECT count(*) FROM some_taxis").first()[0] == 3


def test_parquet_stream_picks_one_table(spark, tmp_path):
    df = files.load_stream(stream_session(spark), "/root/testdata/sf0.001", "nation", max_files=1)
    assert df.isStreaming and stream_rows(df, tmp_path)[0].count() == 25


@pytest.mark.parametrize("partitions", [(), ("k",)])
def test_parquet_stream_of_a_folder_of_files(spark, tmp_path, partitions):
    rows = spark.range(20).selectExpr("id", "cast(id % 2 as int) AS k").repartition(3)
    rows.write.partitionBy(*partitions).parquet(f"{tmp_path}/tables/some.parquet")
    rows.limit(1).write.parquet(f"{tmp_path}/tables/some.parquet2")
    df = files.load_stream(stream_session(spark), f"{tmp_path}/tables", "some")
    found = stream_rows(df, tmp_path)[0]
    assert sorted(map(tuple, found.select("id", "k").collect())) == [(n, n % 2) for n in range(20)]


def test_kafka_source_options(spark):
    assert messages.kafka_options("booking", "broker:9092", "earliest", {"maxOffsetsPerTrigger": 1000}) == {
        "kafka.bootstrap.servers": "broker:9092", "subscribe": "booking", "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "1000",
    }
    assert "startingOffsets" not in messages.kafka_options("booking", "broker:9092")
    with pytest.raises(AnalysisException):  # the connector is not on the class path here
        messages.read_kafka(spark, "booking", "broker:9092")


def test_kafka_shaped_rows(spark):
    shown = kafka_metadata(Tables(spark, "/root/testdata/sf0.001").messages)
    assert shown.columns == ["key", "message", "topic", "partition", "offset", "timestamp", "processing_time"]
    assert shown.filter(F.col("processing_time") < F.col("timestamp")).count() == 0


def test_socket_sources_are_built_without_connecting(spark):
    session = stream_session(spark)
    assert messages.read_socket(session, "localhost", 9999).columns == ["value"]
    assert messages.read_socket(session, "localhost", 9999, include_timestamp=True).columns == ["value", "timestamp"]


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark).startswith(spark.conf.get("spark.checkpoint.dir"))
