"""The command line and the trip jobs on finite input."""

import pytest
from pyspark.sql import functions as F

from kerbside import __main__ as cli
from kerbside.operators import trip_windows as T
from kerbside.operators.decode import MICROS, parse_trips
from kerbside import schemas
from kerbside.plans.tables import Tables
from kerbside.session import stream_session
from kerbside.streaming import runtime as R
from tests.helpers import rows

SMALL = "/root/testdata/sf0.001"


def trip_messages(spark, folder):
    trips = Tables(spark, SMALL).trips_events.withColumns(
        {"event_time": F.date_format("event_timestamp", MICROS), "processing_time": F.date_format("processing_timestamp", MICROS)}
    ).drop("event_timestamp", "processing_timestamp")
    trips.select(F.to_json(F.struct("*")).alias("value")).write.parquet(folder)


def test_parsed_trip_messages_give_the_same_report(spark, tmp_path):
    trip_messages(spark, f"{tmp_path}/in")
    parsed = parse_trips(spark.read.parquet(f"{tmp_path}/in"), schemas.TAXI_TRIP)
    direct = Tables(spark, SMALL).trips_events
    assert rows(T.tw_taxi_types(parsed)) == rows(T.tw_taxi_types(direct))
    assert rows(T.wm_lateness(parsed)) == rows(T.wm_lateness(direct))


@pytest.mark.parametrize("job", sorted(cli.TRIP_JOBS))
def test_trip_jobs_run_to_the_end(spark, tmp_path, job):
    trip_messages(spark, f"{tmp_path}/in")
    messages = stream_session(spark).readStream.schema("value string").parquet(f"{tmp_path}/in")
    running = R.start_all(cli.trip_specs(messages, job, f"{tmp_path}/checkpoint", "available_now"))
    R.finish_all(running)
    assert [query.name for query in running] == list(cli.TRIP_JOBS[job])
    assert all(query.exception() is None for query in running)


def test_quality_job(spark, tmp_path, capsys):
    t = Tables(spark, SMALL)
    t.drivers.write.option("header", True).csv(f"{tmp_path}/drivers")
    paths = {"drivers": f"{tmp_path}/drivers", "trips": f"{tmp_path}/none"}
    verdict = cli.quality(spark, paths, f"{tmp_path}/report").first()
    assert verdict.total_checks == 4 + 1 + 1 + 1 and verdict.failed_checks >= 1
    figures = dict(rows(cli.quality(spark, paths, None)))
    assert figures["total_checks"] == verdict.total_checks and figures["drivers_column_count"] == 4.0


def test_arguments():
    given = cli._parser().parse_args(["ml", "--action", "tune", "--data", "x.csv"])
    assert given.models == list(cli.MODEL_NAMES)
    with pytest.raises(SystemExit):
        cli._parser().parse_args(["nothing"])
